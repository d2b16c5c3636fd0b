"""The files of a partitioned table, by listing alone, and moving or deleting whole folders."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, functions as F

from slugline.functions.partitions import restored_value
from slugline.schema import PARTITION_COLUMNS

# Fixed value: the folder name that stands for an empty partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes, modified) of every Parquet file below `root`.

    The content column of the listing is never selected, so no file is opened, not even its footer.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _path_value(name: str):
    """The value of a partition level in a path, unescaped; NULL where the path has no such level."""
    value = F.regexp_extract("path", rf"/{name}=([^/]*)/", 1)
    decoded = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains("path", F.lit(f"/{name}=")), F.when(value == NO_VALUE, F.lit(None)).otherwise(decoded))


def partition_files(spark: SparkSession, root: str) -> DataFrame:
    """`listed_files` with the values of service, api and dt that the paths give."""
    service, api, day = (_path_value(name) for name in PARTITION_COLUMNS)
    values = [restored_value(service).alias("service"), restored_value(api).alias("api"), day.try_cast("date").alias("dt")]
    return listed_files(spark, root).select(*values, "path", "bytes", "modified")


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path without its scheme where it lies in a local folder, else None."""
    system, located = _path(spark, path)
    if system.getUri().getScheme() != "file":
        return None
    return system.makeQualified(located).toUri().getPath()


def exists(spark: SparkSession, path: str) -> bool:
    system, located = _path(spark, path)
    return system.exists(located)


def make_folder(spark: SparkSession, path: str) -> None:
    system, located = _path(spark, path)
    if not system.mkdirs(located):
        raise OSError(f"cannot make {path}")


def delete_folder(spark: SparkSession, path: str) -> None:
    system, located = _path(spark, path)
    system.delete(located, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the parent of `target` is made, `target` itself must not exist."""
    system, located = _path(spark, source)
    _, destination = _path(spark, target)
    system.mkdirs(destination.getParent())
    if not system.rename(located, destination):
        raise OSError(f"cannot move {source} to {target}")
