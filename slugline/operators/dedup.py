"""Telling deliveries that arrive more than once, within a batch, against the stored tables, or in a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slugline.functions.days import business_day
from slugline.operators.sink import events_root, quarantine_root
from slugline.sources.events import scan_events, scan_quarantine

DIGEST = "delivery_digest"
# A delivery is the same body received at the same instant: equal bodies may come from two real changes.
DELIVERY_KEY = (DIGEST, "received_at")


def delivery_digest(body: Column) -> Column:
    """SHA-256 of a body; a missing one counts as empty."""
    return F.sha2(F.coalesce(body.cast("binary"), F.lit(bytearray())), 256)


def with_digest(raw: DataFrame) -> DataFrame:
    return raw.withColumn(DIGEST, delivery_digest(F.col("body")))


def business_days(raw: DataFrame) -> list:
    """The business days of a batch, by its receive times alone; one row for each reaches the driver."""
    days = raw.select(business_day(F.col("received_at")).alias("dt")).where("dt IS NOT NULL").distinct()
    return sorted(row["dt"] for row in days.collect())


def stored_keys(spark: SparkSession, root: str, days: list) -> DataFrame:
    """DELIVERY_KEY of what the event and quarantine tables below `root` hold of some days.

    Other days' folders are pruned. A stored event's text is its body, so its digest is the delivery's.
    """
    wanted = F.col("dt").isin(days)
    parts = []
    for scan, table, body in ((scan_events, events_root(root), "raw_payload"), (scan_quarantine, quarantine_root(root), "body")):
        try:
            parts.append(scan(spark, table).where(wanted).select("received_at", delivery_digest(F.col(body)).alias(DIGEST)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not parts:
        return spark.createDataFrame([], f"received_at timestamp, {DIGEST} string")
    return parts[0].union(parts[1]) if len(parts) == 2 else parts[0]


def new_deliveries(raw: DataFrame, root: str) -> DataFrame:
    """The deliveries of a batch that the tables below `root` do not hold, each once.

    Stored rows are pruned to the batch's days and then to its receive times, which is a semi-join
    on one narrow column that Spark's runtime Bloom filter can serve; only what is left has its body
    hashed. The anti-join and the distinct step share one shuffle by DELIVERY_KEY. Copies of
    a hot delivery meet in the map tasks first. Without a receive time a delivery is new.
    """
    spark = raw.sparkSession
    keyed = with_digest(raw)
    stored = stored_keys(spark, root, business_days(raw))
    times = raw.select(F.col("received_at")).where("received_at IS NOT NULL")
    known = stored.join(times, "received_at", "left_semi").select(*DELIVERY_KEY)
    return keyed.dropDuplicates(list(DELIVERY_KEY)).join(known, list(DELIVERY_KEY), "left_anti").select(*keyed.columns).drop(DIGEST)


def first_deliveries(raw_stream: DataFrame, within: str) -> DataFrame:
    """A stream without deliveries that came before, as far back as `within`.

    Each digest and receive time is kept in the state store, until `within` has passed since it
    arrived. The clock is the time of the micro-batch, fixed in its log, not the receive time: a
    delivery that was held up for weeks is late by its receive time, and Spark would drop it unseen.
    """
    arrived = with_digest(raw_stream).withColumn("_arrived_at", F.current_timestamp()).withWatermark("_arrived_at", within)
    return arrived.dropDuplicatesWithinWatermark(list(DELIVERY_KEY)).drop(DIGEST, "_arrived_at")
