"""What becomes of the payload text of events: dropped, masked, kept apart, or columns left out."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from slugline.functions.payload import PARSER
from slugline.functions.signature import hmac_sha256_hex
from slugline.operators.sink import TABLE_COLUMN, spread_rows, stored_values
from slugline.schema import EVENT_COLUMNS, EVENT_SCHEMA, PARTITION_COLUMNS, REQUIRED_COLUMNS
from slugline.sources.events import with_path_values

PAYLOAD, DIGEST = "raw_payload", "payload_digest"
EVENTS, PAYLOADS = "events", "payloads"

KEPT = None  # a rule: texts and lists of texts stay
_TIMES = {"createdAt": KEPT, "publishedAt": KEPT, "updatedAt": KEPT, "updated_at": KEPT}
_SIDE = {"status": KEPT, **_TIMES, "draftValue": _TIMES, "publishValue": _TIMES}
# What ingest reads of a payload; every other value is the sender's own.
READ_BY_INGEST = {
    "service": KEPT, "api": KEPT, "id": KEPT, "type": KEPT, "contents": {"old": _SIDE, "new": _SIDE},
}


def drop_payload(events: DataFrame) -> DataFrame:
    """Events with an empty text in place of the payload."""
    return events.withColumn(PAYLOAD, F.lit(""))


def only_columns(events: DataFrame, allowed: Collection[str]) -> DataFrame:
    """Events with the allowed columns; the others are NULL, the payload is empty.

    Columns that place or date an event always stay, since no table can be written without them.
    """
    always = {*PARTITION_COLUMNS, *REQUIRED_COLUMNS} - {PAYLOAD}
    unknown = set(allowed) - set(EVENT_COLUMNS)
    if unknown:
        raise ValueError(f"no event columns: {sorted(unknown)}")
    gone = [f for f in EVENT_SCHEMA if f.name not in {*allowed, *always}]
    blank = {f.name: F.lit("" if f.name == PAYLOAD else None).cast(f.dataType) for f in gone}
    return events.select(*EVENT_COLUMNS).withColumns(blank) if blank else events.select(*EVENT_COLUMNS)


def _hashed(value: Column, secret: bytes) -> Column:
    """A keyed digest of any JSON value, itself a JSON text; equal values have equal digests, null stays null."""
    digest = hmac_sha256_hex(F.to_json(value).cast("binary"), secret).cast("variant")
    return F.when(value.isNull() | F.is_variant_null(value), value).otherwise(digest)


def _masked(value: Column, rules: Mapping | None, secret: bytes) -> Column:
    if rules is KEPT:
        plain = F.schema_of_variant(value).isin("STRING", "ARRAY<STRING>")
        return F.when(plain, value).otherwise(_hashed(value, secret))

    def field(key: Column, inside: Column) -> Column:
        masked = _hashed(inside, secret)
        for name, rule in rules.items():
            masked = F.when(key == name, _masked(inside, rule, secret)).otherwise(masked)
        return masked

    fields = F.try_variant_get(value, "$", "map<string,variant>")
    return F.when(fields.isNotNull(), F.to_variant_object(F.transform_values(fields, field))).otherwise(_hashed(value, secret))


def masked_payload(text: Column, secret: bytes, rules: Mapping = READ_BY_INGEST) -> Column:
    """A payload text with every value that `rules` do not name replaced by its keyed digest.

    Keys and structure of what is named stay, so ingest reads the same event out of it, and two
    payloads with equal free values can still be told equal. A named field that holds anything but a
    text or a list of texts is replaced as well, an unnamed object as a whole. Keys come out sorted.
    A text that is no JSON becomes the digest of NULL, which is NULL.
    """
    return F.to_json(_masked(F.from_json(text, "variant", PARSER), rules, secret))


def mask_payload(events: DataFrame, secret: bytes, rules: Mapping = READ_BY_INGEST) -> DataFrame:
    """Events with `masked_payload` in place of the payload."""
    return events.withColumn(PAYLOAD, F.coalesce(masked_payload(F.col(PAYLOAD), secret, rules), F.lit("")))


def write_split_events(events: DataFrame, root: str, *, mode: str = "append") -> None:
    """Events and their payloads as sibling tables below `root`, written by one job.

    The events' folder holds no payload, only its SHA-256; the payloads' folder holds digest and text. Each has its own
    prefix, so access can be granted to one alone. Both are partitioned by service, api and day.
    """
    fields = [*EVENT_COLUMNS, DIGEST]
    whole = events.select(*EVENT_COLUMNS).withColumns(stored_values()).withColumn(DIGEST, F.sha2(F.col(PAYLOAD).cast("binary"), 256))

    def row(table: str, kept: Collection[str]) -> Column:
        columns = [(F.col(c) if c in kept else F.lit(None).cast(whole.schema[c].dataType)).alias(c) for c in fields]
        return F.struct(F.lit(table).alias(TABLE_COLUMN), *columns)

    event = row(EVENTS, set(fields) - {PAYLOAD})
    payload = row(PAYLOADS, {PAYLOAD, DIGEST, *PARTITION_COLUMNS})
    rows = whole.select(F.explode(F.array(event, payload)).alias("row")).select("row.*")
    keys = (TABLE_COLUMN, *PARTITION_COLUMNS)
    spread_rows(rows, *keys).write.mode(mode).partitionBy(*keys).parquet(root)


def scan_split_events(spark: SparkSession, root: str) -> DataFrame:
    """The events that `write_split_events` stored, `raw_payload` NULL, with `payload_digest`."""
    return _scan_split(spark, f"{root}/{TABLE_COLUMN}={EVENTS}")


def scan_payloads(spark: SparkSession, root: str) -> DataFrame:
    """(service, api, dt, payload_digest, raw_payload) of the payloads' folder."""
    return _scan_split(spark, f"{root}/{TABLE_COLUMN}={PAYLOADS}").select(*PARTITION_COLUMNS, DIGEST, PAYLOAD)


def _scan_split(spark: SparkSession, root: str) -> DataFrame:
    return with_path_values(spark.read.schema(StructType([*EVENT_SCHEMA, StructField(DIGEST, StringType())])).parquet(root), DIGEST)


def join_payloads(events: DataFrame, payloads: DataFrame) -> DataFrame:
    """Events with their payloads again, for those who may read both. Equal payloads of a partition are one."""
    keys = [*PARTITION_COLUMNS, DIGEST]
    texts = payloads.groupBy(*keys).agg(F.any_value(PAYLOAD).alias(PAYLOAD))
    return events.drop(PAYLOAD).join(texts, keys, "left").select(*EVENT_COLUMNS)
