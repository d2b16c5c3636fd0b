"""Scans of the partitioned event table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from datetime import timedelta
from urllib.parse import quote

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from slugline.functions.partitions import restored_value
from slugline.plans.params import TimeRange
from slugline.schema import EVENT_COLUMNS, EVENT_FIELDS, EVENT_SCHEMA, QUARANTINE_SCHEMA
from slugline.sources.files import exists, listed_files


def with_path_values(scanned: DataFrame, *more: str) -> DataFrame:
    """The event columns, service and api as their folders name them, and any further ones."""
    return scanned.withColumns(
        {name: restored_value(F.col(name)) for name in ("service", "api")}
    ).select(*EVENT_COLUMNS, *more)


def scan_events(spark: SparkSession, root: str, span: TimeRange | None = None) -> DataFrame:
    """The event table under `root`, or only the folders of a range's days.

    The declared schema, partition columns included, replaces inference: no footers are read for
    it, an all-digit `api` stays text, and a column a file lacks reads as NULL. Deeper partition
    levels, such as the batch number a stream adds, are pruned away here.

    A filter on `dt` prunes what is read, but only after every folder of the table was listed.
    Where the range is a small part of a long history, give it here too: other days are then not
    even listed. It must not be given for `average_draft_to_publish`, which looks at drafts of
    any age.
    """
    reader = spark.read.schema(EVENT_SCHEMA)
    if span is not None:
        days = ",".join(str(span.first_day + timedelta(days=offset)) for offset in range(span.day_count))
        try:
            listed = reader.option("basePath", root).parquet(f"{root}/service=*/api=*/dt={{{days}}}")
            return with_path_values(listed)
        except AnalysisException as error:
            # None of the days has a folder; the plain scan below then has no row of them either.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return with_path_values(reader.parquet(root))


def scan_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """The quarantine table under `root`: rejected records as they arrived, and why."""
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(root).select(*QUARANTINE_SCHEMA.names)


def stored_types(path: str) -> dict[str, str]:
    """Name and type of each column in a Parquet file's footer, through the file systems Arrow knows."""
    scheme, separator, rest = path.partition(":")
    local = not separator or scheme == "file"
    location = (rest or path) if local else f"{'s3' if scheme == 's3a' else scheme}:{quote(rest)}"
    filesystem, name = fs.FileSystem.from_uri(location)
    stored = from_arrow_schema(pq.read_schema(name, filesystem=filesystem))
    return {field.name: field.dataType.simpleString() for field in stored}


def _footers(files: DataFrame, read_types: Callable[[str], dict[str, str]]) -> DataFrame:
    """`files` (path, ..) with `drift`, out of the footers that their tasks read."""
    expected = {field.name: field.dataType.simpleString() for field in EVENT_FIELDS}

    def drift_of(path: str) -> str:
        types = read_types(path)
        # A value that the path gives counts, whatever the file says of it.
        inside = [column for column in expected if f"/{column}=" not in path]
        return ", ".join(
            f"`{column}` {types[column]}"
            for column in inside
            if types.get(column, expected[column]) != expected[column]
        )

    def footers(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(drift=[drift_of(path) for path in batch["path"]])

    return files.mapInPandas(footers, StructType([*files.schema.fields, StructField("drift", StringType())]))


def drifted_columns(
    spark: SparkSession,
    root: str,
    stored: str | None = None,
    read_types: Callable[[str], dict[str, str]] = stored_types,
) -> DataFrame:
    """(path, drift) per file: its event columns stored under a type the event table cannot read.

    `drift` is a DDL fragment, empty for a conforming file. Paths come from a listing whose
    content column is never touched, and footers are read by the tasks, not by the driver. `read_types`
    says how, for file systems that Arrow does not know; it must be importable on the workers.

    `stored` names a table, made on first use, that keeps what footers said, by path, size and time of
    change: each call then reads the footers of new and changed files only and adds them.
    """
    files = listed_files(spark, root)
    if stored is None:
        return _footers(files.select("path"), read_types)
    key = ["path", "bytes", "modified"]
    known = spark.createDataFrame([], StructType([*files.schema.fields, StructField("drift", StringType())]))
    if exists(spark, stored):
        known = spark.read.schema(known.schema).parquet(stored)
    fresh = files.join(known, key, "left_anti").select(*key)
    if not fresh.isEmpty():
        _footers(fresh, read_types).write.mode("append").parquet(stored)
        known = spark.read.schema(known.schema).parquet(stored)
    # A file that two calls have added at once is there twice.
    return known.join(files, key, "left_semi").select("path", "drift").distinct()


def uniform_paths(files: DataFrame, root: str) -> dict[str, list[str]]:
    """The fewest folders and files below `root` that together cover each kind of drift.

    `files` is what `drifted_columns` returns. A folder stands for everything in it if all of it
    drifts alike, so the driver receives as many paths as the drift is irregular, and `root`
    alone for a table without any.
    """
    base = root.rstrip("/").split("://")[-1] + "/"
    below = F.substr("path", F.instr("path", base) + F.lit(len(base)))
    segments = F.split(below, "/")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(segments)), lambda depth: F.array_join(F.slice(segments, 1, depth), "/")
    )
    uniform = (
        files.select("drift", F.explode(prefixes).alias("prefix"))
        .groupBy("prefix")
        .agg(F.min("drift").alias("drift"), F.max("drift").alias("other"))
        .where("drift = other")
        .select("prefix", "drift")
        .persist()
    )
    parent = F.when(F.col("prefix") != "", F.regexp_replace("prefix", "/?[^/]+$", ""))
    inside_another = uniform.select(F.col("prefix").alias("parent"))
    widest = uniform.withColumn("parent", parent).join(inside_another, "parent", "left_anti")
    cover: dict[str, list[str]] = defaultdict(list)
    for row in widest.toLocalIterator():
        cover[row.drift].append(f"{root.rstrip('/')}/{row.prefix}".rstrip("/"))
    uniform.unpersist()
    return cover


def union_by_name_scan(
    spark: SparkSession, root: str, cover: dict[str, list[str]] | None = None, stored: str | None = None
) -> DataFrame:
    """The event table where writers disagreed on types, such as all-NULL columns stored as INT.

    Files are grouped by how they drift; each group is read under its own types, cast, and united
    by name. `cover`, as `uniform_paths` returns it, spares looking at all; `stored`, the table of
    `drifted_columns`, spares reading the footer of a file more than once.
    """
    parts = []
    for drift, paths in sorted((cover or uniform_paths(drifted_columns(spark, root, stored), root)).items()):
        stored = {field.name: field for field in StructType.fromDDL(drift)} if drift else {}
        schema = StructType([stored.get(field.name, field) for field in EVENT_SCHEMA])
        part = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        parts.append(
            part.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA])
        )
    if not parts:
        return scan_events(spark, root)
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return with_path_values(united)
