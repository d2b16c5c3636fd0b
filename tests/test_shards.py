"""Tables of many small files: how they are written, and how their events are counted."""

from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from builders import day, events, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slugline.operators import inventory as N
from slugline.operators import sink as S
from slugline.operators.shards import MOST_ROWS, cut_shards
from slugline.schema import EVENT_COLUMNS, EVENT_SCHEMA
from slugline.sources import events as E


def many(spark, n_rows, service="s", when=datetime(2026, 6, 29, 1, 2, 3, 456789)):
    wide = spark.range(n_rows).select(
        F.lit(service).alias("service"),
        F.when(F.col("id") % 3 > 0, "a").otherwise(F.concat(F.lit("a"), F.col("id") % 5)).alias("api"),
        F.lit(day("06-29")).alias("dt"),
        F.lit(when).alias("received_at"),
        F.concat(F.lit("c"), "id").alias("content_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("raw_payload"),
    )
    missing = {f.name: F.lit(None).cast(f.dataType) for f in EVENT_SCHEMA if f.name not in wide.columns}
    return wide.withColumns(missing)


def read_back(table):
    return sorted(map(repr, table.select(*EVENT_COLUMNS).collect()))


def folders(root):
    return {str(path.parent.relative_to(root)) for path in Path(root).rglob("*.parquet")}


def left_behind(root):
    """Whatever a write leaves in a table beside data files and the note of its success."""
    return {p.name for p in Path(root).rglob("*") if p.is_file() and p.suffix != ".parquet"} - {"_SUCCESS", "._SUCCESS.crc"}


def test_small_files_have_no_companions(spark, tmp_path):
    """A checksum file beside a file is one more process started, and so is the file itself where Hadoop makes it."""
    root = str(tmp_path / "events")
    table = many(spark, 500)
    assert S.write_events(table, root, rows_per_file=7) == 500
    assert left_behind(root) == set() and not list(Path(root).glob("_shards-*"))
    assert read_back(E.scan_events(spark, root)) == read_back(table)
    sizes = {}
    for row in N.file_inventory(spark, root).collect():
        sizes.setdefault((row.service, row.api, row.dt), []).append(row.event_count)
    for (_, api, _), counts in sizes.items():
        stored = table.where(F.col("api") == api).count()
        assert sum(counts) == stored and max(counts) <= 7
        # At most as many files below seven as tasks have written to the partition.
        assert len(counts) - counts.count(7) <= 8


def test_footers_of_many_small_files_take_few_tasks(spark, tmp_path):
    root = str(tmp_path / "events")
    S.write_events(many(spark, 1_500), root, rows_per_file=1)
    context = spark.sparkContext
    context.setJobGroup("footers", "footers")
    try:
        counted = rows(N.table_summary(spark, root))
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("footers") for s in tracker.getJobInfo(j).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * context.defaultParallelism
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert counted == [(1_500, 1_500, 6, day("06-29"), day("06-29"))]


@pytest.mark.parametrize("rows_per_file", [1, 3, MOST_ROWS, MOST_ROWS + 1])
def test_folders_are_named_as_spark_names_them(spark, tmp_path, rows_per_file):
    odd = ["", "7", "a+b%c", "ü:é", "x{y}^z", "a'b\"c", "1\\2*3", None, "\x01\x1f"]
    table = events(
        spark, *[{"service": service, "api": "007", "dt": dt} for service in odd for dt in (day("06-29"), None)]
    )
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    S.write_events(table, plain)
    S.write_events(table, small, rows_per_file=rows_per_file)
    assert folders(small) == folders(plain)
    assert read_back(E.scan_events(spark, small)) == read_back(E.scan_events(spark, plain))
    files = [N.file_inventory(spark, root).drop("file_path").collect() for root in (small, plain)]
    assert {(r.service, r.api, r.dt) for r in files[0]} == {(r.service, r.api, r.dt) for r in files[1]}
    assert [sum(r.event_count for r in each) for each in files] == [18, 18]


def test_shards_are_added_and_replaced(spark, tmp_path):
    root = str(tmp_path / "events")
    S.write_events(many(spark, 40), root, rows_per_file=4)
    kept = E.scan_events(spark, root).persist()
    assert kept.count() == 40
    S.write_events(many(spark, 60), root, rows_per_file=4)
    assert E.scan_events(spark, root).count() == 100
    kept.unpersist()
    assert S.write_events(many(spark, 9, service="t"), root, mode="overwrite", rows_per_file=4) == 9
    assert rows(N.table_summary(spark, root))[0][0] == 9 and {path.name for path in tmp_path.iterdir()} == {"events"}


def test_a_failed_write_of_shards_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "events")
    S.write_events(many(spark, 40), root, rows_per_file=4)
    broken = many(spark, 400).withColumn("raw_payload", F.when(F.col("content_id") != "c399", F.col("raw_payload")))
    with pytest.raises(PySparkException):
        S.write_events(broken, root, rows_per_file=4)
    with pytest.raises(ValueError):
        S.write_events(many(spark, 40).where("content_id = 'none'"), root, rows_per_file=4)
    assert rows(N.table_summary(spark, root))[0][0] == 40
    assert left_behind(root) == set()


def test_counting_where_folders_do_not_name_the_partitions(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert rows(N.table_summary(spark, str(tmp_path / "empty"))) == [(0, 0, 0, None, None)]
    flat = str(tmp_path / "flat")
    events(spark, {"service": "s", "api": "a", "dt": day("06-29")}).write.parquet(flat)
    assert [row.service for row in N.file_inventory(spark, flat).where("event_count = 1").collect()] == ["s"]


def test_shards_are_cut_across_batches():
    """Rows of one partition that arrive in several batches fill files together; a new partition starts a new file."""
    keys = ["a"] * 5 + [None] * 4 + ["b"] * 8
    table = pa.table({"k": pa.array(keys, pa.string()), "n": list(range(17))})
    for size in (1, 2, 4, 17):
        shards = list(cut_shards(table.to_batches(max_chunksize=size), ("k",), 3))
        assert [(values[0], shard["n"].to_pylist()) for values, shard in shards] == [
            ("a", [0, 1, 2]), ("a", [3, 4]), (None, [5, 6, 7]), (None, [8]),
            ("b", [9, 10, 11]), ("b", [12, 13, 14]), ("b", [15, 16]),
        ]
    assert list(cut_shards([], ("k",), 3)) == []
