"""What the event table holds, from its listing and file footers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from glob import escape, iglob

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from slugline.schema import EVENT_SCHEMA, PARTITION_COLUMNS
from slugline.sources.files import local_path

# What Spark's listing of a table's files gives: its own columns, then those of the folders.
_LISTED = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType()),
        *[EVENT_SCHEMA[name] for name in PARTITION_COLUMNS],
    ]
)
_COUNTED = T.StructType(
    [
        *[EVENT_SCHEMA[name] for name in PARTITION_COLUMNS],
        T.StructField("file_path", T.StringType()),
        T.StructField("event_count", T.LongType(), False),
    ]
)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per data file: its partition, its path and how many events it holds.

    No event column is decoded. A local table may hold files of a few rows, which a scan takes far longer to open
    than to read: their footers are read by a few tasks. Elsewhere, and where the folders do not name
    the partitions, a scan selects only partition values and file metadata.
    """
    folder = local_path(spark, root)
    levels = "/".join(f"{name}=*" for name in PARTITION_COLUMNS)
    if folder is not None and next(iglob(f"{escape(folder)}/{levels}/**/*.parquet", recursive=True), None):
        return _counted_by_footers(spark, root)
    scanned = spark.read.schema(EVENT_SCHEMA).parquet(root)
    return (
        scanned.select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file_path"))
        .groupBy(*PARTITION_COLUMNS, "file_path")
        .agg(F.count("*").alias("event_count"))
    )


def _counted_by_footers(spark: SparkSession, root: str) -> DataFrame:
    """`file_inventory` of a local table whose folders name the partitions."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            counts = [pq.read_metadata(path.removeprefix("file:")).num_rows for path in paths]
            kept = [batch.column(name) for name in _COUNTED.names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], names=_COUNTED.names)

    listed = spark.read.schema(_LISTED).format("binaryFile").load(root)
    files = listed.select(*PARTITION_COLUMNS, F.col("_metadata.file_path").alias("file_path"), "path")
    # Spark plans a task for every 32 small files; the few that remain share all of them evenly.
    few = files.coalesce(4 * spark.sparkContext.defaultParallelism)
    return few.mapInArrow(count, _COUNTED).where("event_count > 0")


def partition_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per partition: files, events, and the size of its largest file in events."""
    return (
        file_inventory(spark, root)
        .groupBy(*PARTITION_COLUMNS)
        .agg(
            F.count("*").alias("file_count"),
            F.sum("event_count").alias("event_count"),
            F.max("event_count").alias("largest_file_events"),
        )
    )


def table_summary(spark: SparkSession, root: str) -> DataFrame:
    """One row: events, files, partitions, first and last day.

    Counting upwards, file by file and then partition by partition, needs no distinct aggregate.
    """
    return partition_inventory(spark, root).agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"),
        F.coalesce(F.sum("file_count"), F.lit(0)).alias("file_count"),
        F.count("*").alias("partition_count"),
        F.min("dt").alias("first_day"),
        F.max("dt").alias("last_day"),
    )
