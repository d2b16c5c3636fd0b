"""Batch ingest: landed webhooks to the event and quarantine tables, once each, and day by day again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from slugline.functions.days import business_day
from slugline.operators.dedup import new_deliveries
from slugline.operators.ingest import classify_deliveries
from slugline.operators.sink import EVENTS, QUARANTINE, TABLE_COLUMN, write_deliveries
from slugline.sources.files import delete_folder, listed_files, partition_files
from slugline.sources.webhooks import as_raw_webhooks

LEDGER_SCHEMA = "path string, bytes long, modified timestamp"


def ingest_batch(
    raw: DataFrame, secret: bytes, root: str, *, mode: str = "append", rows_per_file: int | None = None
) -> None:
    """Verify, normalise and store raw webhooks in one pass."""
    deliveries = classify_deliveries(raw, secret)
    write_deliveries(deliveries, root, mode=mode, rows_per_file=rows_per_file)


def ingest_new(raw: DataFrame, secret: bytes, root: str) -> None:
    """`ingest_batch` of the deliveries that the tables do not hold yet: running it again adds nothing.

    Deliveries need a receive time of their own. Two runs over the same root must not overlap.
    """
    ingest_batch(new_deliveries(raw, root), secret, root)


def unprocessed_files(spark: SparkSession, landing: str, ledger: str) -> DataFrame:
    """(path, bytes, modified) of the landed files that `ledger` does not name, or names in another version."""
    try:
        known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], LEDGER_SCHEMA)
    return listed_files(spark, landing).join(known, ["path", "bytes", "modified"], "left_anti").select("path", "bytes", "modified")


def backfill_days(
    spark: SparkSession,
    landing: str,
    secret: bytes,
    root: str,
    ledger: str,
    *,
    schema: StructType,
    signature_header: str | None = None,
) -> list:
    """Rebuild the days that new or changed landed files concern, from all landed files; returns the days.

    Files that `ledger` knows are skipped; the receive times of the others name the days. Those days'
    partitions of both tables are replaced, all others keep their very files. The ledger is
    written last, so a run that fails is done again by the next one, and a run with nothing new does
    nothing. A delivery without a receive time belongs to the time of its file. Days that another writer
    adds to, such as a stream, must not be backfilled at the same time.
    """
    fresh = unprocessed_files(spark, landing, ledger).collect()
    if not fresh:
        return []
    landed = spark.read.schema(schema).parquet(landing)
    received = F.coalesce(F.col("received_at").cast("timestamp"), F.col("_metadata.file_modification_time"))
    placed = landed.withColumns({"received_at": received, "_dt": business_day(received)})
    of_files = spark.read.schema(schema).parquet(*[row["path"] for row in fresh])
    days = sorted(row["dt"] for row in of_files.select(business_day(received).alias("dt")).distinct().collect())
    before = _files_of_days(spark, root, days)
    raw = as_raw_webhooks(placed.where(F.col("_dt").isin(days)).drop("_dt"), signature_header)
    write_deliveries(classify_deliveries(raw, secret), root, mode="overwrite_partitions")
    after = _files_of_days(spark, root, days)
    for folder, files in before.items():
        # What got no row this time has kept its files; it holds nothing that is landed still.
        if after.get(folder) == files:
            delete_folder(spark, folder)
    spark.createDataFrame(fresh, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)
    return days


def _files_of_days(spark: SparkSession, root: str, days: list) -> dict[str, list[str]]:
    """The files of each partition folder of some days, in both tables: as many rows as those days have folders."""
    found: dict[str, list[str]] = {}
    for table in (EVENTS, QUARANTINE):
        try:
            files = partition_files(spark, f"{root}/{TABLE_COLUMN}={table}").where(F.col("dt").isin(days))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        folder = F.regexp_extract("path", r"^(.*/dt=[^/]+)/", 1)
        grouped = files.groupBy(folder.alias("folder")).agg(F.sort_array(F.collect_set("path")).alias("paths"))
        found |= {row["folder"]: row["paths"] for row in grouped.collect()}
    return found
