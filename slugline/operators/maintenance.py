"""Looking after a stored event table: compaction of small files, and what retention would remove."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from slugline.operators.sink import spread_rows, stored_values
from slugline.schema import PARTITION_COLUMNS
from slugline.sources.events import scan_events
from slugline.sources.files import partition_files

# A file of this size is not worth merging with another.
FULL_FILE_BYTES = 128 * 1024 * 1024


def partition_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(service, api, dt, file_count, bytes, last_modified) by listing alone; empty where `root` does not exist."""
    try:
        files = partition_files(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "service string, api string, dt date, path string, bytes long, modified timestamp")
    return files.groupBy(*PARTITION_COLUMNS).agg(
        F.count("*").alias("file_count"), F.sum("bytes").alias("bytes"), F.max("modified").alias("last_modified")
    )


def compaction_plan(spark: SparkSession, source: str, target: str, file_bytes: int = FULL_FILE_BYTES) -> DataFrame:
    """Partitions of `source` with `due`: whether `target` lacks what they hold by now.

    A partition is due if the target has none, or an older one. `fragmented` tells those
    with more files than their bytes need. Both sides are listed, no file is opened.
    """
    mine = partition_sizes(spark, source)
    theirs = partition_sizes(spark, target).select(*PARTITION_COLUMNS, F.col("last_modified").alias("copied_at"))
    needed = F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes))
    return mine.join(theirs, [*PARTITION_COLUMNS], "left").select(
        *PARTITION_COLUMNS,
        "file_count",
        "bytes",
        (F.col("file_count") > needed).alias("fragmented"),
        (F.col("copied_at").isNull() | (F.col("copied_at") < F.col("last_modified"))).alias("due"),
    )


def compact_events(spark: SparkSession, source: str, target: str, before: date | None = None) -> int:
    """Bring the compacted copy of `source` below `target` up to date; returns how many partitions were due.

    The copy is another table with the same columns and partitions, one file for each small partition and
    as many as its size needs for a large one; the batch level of streams is gone. Only partitions that changed since
    they were copied are read and replaced, each as a whole, so it can run after every ingest and
    again after a failure. With `before`, days from that one on, which still grow, are left out.
    """
    due = compaction_plan(spark, source, target).where("due")
    if before is not None:
        due = due.where(F.col("dt") < F.lit(before))
    # One row per due partition of the listing that the driver holds anyway; the days prune the scan.
    listed = due.select(*PARTITION_COLUMNS).collect()
    if not listed:
        return 0
    days = sorted({row["dt"] for row in listed})
    # Spark does not know how few these are, and would shuffle all events to meet them.
    wanted = F.broadcast(spark.createDataFrame(listed, "service string, api string, dt date"))
    events = scan_events(spark, source).where(F.col("dt").isin(days))
    rows = events.join(wanted, [*PARTITION_COLUMNS], "left_semi").select(*events.columns)
    spread_rows(rows.withColumns(stored_values()), *PARTITION_COLUMNS).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITION_COLUMNS).parquet(target)
    return len(listed)


def expired_partitions(spark: SparkSession, root: str, cutoff: date) -> DataFrame:
    """(service, api, dt, file_count, bytes): the partitions of days before `cutoff`, for an operator to remove.

    Nothing is removed here and no file is opened: paths and sizes come from the listing.
    """
    sizes = partition_sizes(spark, root)
    return sizes.where(F.col("dt") < F.lit(cutoff)).select(*PARTITION_COLUMNS, "file_count", "bytes")
