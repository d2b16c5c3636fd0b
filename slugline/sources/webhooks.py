"""Landed webhooks, as a batch or as a stream of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from slugline.schema import RAW_SCHEMA


def header_value(headers: Column, name: str) -> Column:
    """A header out of a MAP<STRING, STRING>, whatever the case of its name."""
    matching = F.map_filter(headers, lambda key, _: F.lower(key) == name.lower())
    return F.get(F.map_values(matching), F.lit(0))


def as_raw_webhooks(landed: DataFrame, signature_header: str | None = None) -> DataFrame:
    """Bring landed records to (body BINARY, signature, received_at); other columns stay.

    The body may be text, binary or NULL (an empty request). The signature is a column of its own
    or, given `signature_header`, an entry of a `headers` map. A record without a receive time
    gets the time of the run, or of the micro-batch.
    """
    columns = {"body": F.coalesce(F.col("body").cast("binary"), F.lit(bytearray()))}
    if signature_header is not None:
        columns["signature"] = header_value(F.col("headers"), signature_header)
    if "received_at" in landed.columns:
        columns["received_at"] = F.coalesce(F.col("received_at").cast("timestamp"), F.current_timestamp())
    else:
        columns["received_at"] = F.current_timestamp()
    return landed.withColumns(columns)


def raw_webhooks(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "parquet",
    schema: StructType = RAW_SCHEMA,
    signature_header: str | None = None,
) -> DataFrame:
    landed = spark.read.format(file_format).schema(schema).load(path)
    return as_raw_webhooks(landed, signature_header)


def raw_webhook_stream(
    spark: SparkSession,
    path: str,
    *,
    file_format: str = "parquet",
    schema: StructType = RAW_SCHEMA,
    signature_header: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return as_raw_webhooks(reader.load(path), signature_header)
