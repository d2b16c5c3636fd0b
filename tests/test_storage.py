"""The event table on disk: layout, completeness, drift, inventory, and streams into it."""

import os
from datetime import datetime
from pathlib import Path

import pytest
from builders import SECRET, at, day, days, deliveries, events, payload, rows, signed
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slugline.functions.partitions import escape_segment
from slugline.operators import ingest as I
from slugline.operators import inventory as N
from slugline.operators import metrics as M
from slugline.operators import sink as S
from slugline.plans.ingest import ingest_batch
from slugline.plans.params import TimeRange
from slugline.schema import EVENT_COLUMNS, EVENT_SCHEMA
from slugline.session import scratch_path
from slugline.sources import events as E
from slugline.sources.webhooks import raw_webhook_stream, raw_webhooks
from slugline.streaming.ingest import start_ingest


def folders(root):
    return sorted({str(path.parent.relative_to(root)) for path in Path(root).rglob("*.parquet")})


def test_layout_and_escaping(spark, tmp_path):
    root = str(tmp_path / "events")
    table = events(
        spark,
        {"service": "news/room", "api": "long reads", "dt": day("06-29")},
        {"service": None, "api": None, "dt": day("06-30")},
        {"service": "a=b?c#d[e]f", "api": "123", "dt": day("06-30")},
        {"service": "", "api": "ünï%code'", "dt": day("06-30")},
    )
    S.write_events(table, root)
    stored = E.scan_events(spark, root)
    assert stored.columns == list(EVENT_COLUMNS)
    assert {(row.service, row.api, str(row.dt)) for row in stored.collect()} == {
        ("news_room", "long_reads", "2026-06-29"),
        ("unknown", "unknown", "2026-06-30"),
        ("a_b_c_d_e_f", "123", "2026-06-30"),
        ("", "ünï%code'", "2026-06-30"),
    }
    assert "service=news_room/api=long_reads/dt=2026-06-29" in folders(root)
    assert "service=unknown/api=unknown/dt=2026-06-30" in folders(root)


def test_slashes_around_a_prefix_do_not_matter():
    assert S.table_root("s3a://bucket/", "/content_events/") == "s3a://bucket/content_events"


def test_escaping_keeps_length(spark):
    escaped = spark.range(1).select(escape_segment(F.lit("/=?#[] x")).alias("v")).first().v
    assert escaped == "_______x"


def test_nothing_to_write_and_required_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="no events to write"):
        S.write_events(events(spark), str(tmp_path / "none"))
    loose = events(spark, {"dt": day("06-30")}).withColumn("raw_payload", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="raw_payload must not be null"):
        S.write_events(loose, str(tmp_path / "loose"))


def test_append_overwrite_and_inventory(spark, tmp_path):
    root = str(tmp_path / "events")
    first = events(spark, *[{"service": "s", "api": "a", "dt": day("06-29")}] * 3)
    second = events(spark, {"service": "s", "api": "b", "dt": day("06-30")})
    S.write_events(first, root)
    S.write_events(second, root)
    assert rows(N.table_summary(spark, root)) == [(4, 2, 2, day("06-29"), day("06-30"))]
    S.write_events(second, root, mode="overwrite")
    assert rows(N.table_summary(spark, root)) == [(1, 1, 1, day("06-30"), day("06-30"))]


def test_a_range_limits_what_is_listed(spark, tmp_path):
    root = str(tmp_path / "events")
    table = events(spark, *[{"service": "s", "api": "a", "dt": day(f"06-{n}")} for n in (10, 11, 12, 13)])
    S.write_events(table, root)
    listed = E.scan_events(spark, root, days("06-11", "06-20"))
    assert len(listed.inputFiles()) == 3
    span = days("06-11", "06-12")
    assert rows(M.calendar_heatmap(E.scan_events(spark, root, span), span)) == rows(M.calendar_heatmap(table, span))
    quiet = days("07-01", "07-02")
    assert [row[1] for row in rows(M.calendar_heatmap(E.scan_events(spark, root, quiet), quiet))] == [0, 0]
    decade = TimeRange.of(0, 3660 * 86_400_000)
    assert M.publish_action_summary(E.scan_events(spark, root, decade), decade).count() == 1
    with pytest.raises(PySparkException):
        E.scan_events(spark, str(tmp_path / "missing"), span)


def test_rows_per_file(spark, tmp_path):
    root = str(tmp_path / "events")
    S.write_events(
        events(spark, *[{"service": "s", "api": "a", "dt": day("06-29")}] * 600), root, rows_per_file=500
    )
    assert sorted(row.event_count for row in N.file_inventory(spark, root).collect()) == [100, 500]


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Most rows share one partition; it is split, and nothing is lost."""
    root = str(tmp_path / "events")
    wide = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("service"),
        F.lit("a").alias("api"),
        F.lit(day("06-30")).alias("dt"),
        F.lit(datetime(2026, 6, 30)).alias("received_at"),
        F.sha2(F.col("id").cast("string"), 512).alias("raw_payload"),
    )
    missing = {f.name: F.lit(None).cast(f.dataType) for f in EVENT_SCHEMA if f.name not in wide.columns}
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "512k")
    try:
        S.write_events(wide.withColumns(missing), root)
    finally:
        spark.conf.unset(setting)
    files = {row.service: row.file_count for row in N.partition_inventory(spark, root).collect()}
    assert files["hot"] > 3
    assert min(files.values()) == 1
    stored = E.scan_events(spark, root)
    assert stored.count() == stored.select("raw_payload").distinct().count() == 60_000


def test_files_that_lack_columns_or_store_nulls_as_ints(spark, tmp_path):
    root = str(tmp_path / "events")
    complete = events(
        spark, {"service": "s", "api": "blogs", "dt": day("06-30"), "content_id": "A", "draft_created_at": at("06-01 00:00")}
    )
    S.write_events(complete, root)
    assert E.uniform_paths(E.drifted_columns(spark, root), root) == {"": [root]}
    plain = rows(E.union_by_name_scan(spark, root))
    assert plain == rows(E.scan_events(spark, root))

    drifting = events(spark, {"service": "s", "api": "authors", "dt": day("06-30"), "event_kind": "DELETE_DRAFT"})
    for name in ("content_id", "old_status", "draft_created_at"):
        drifting = drifting.withColumn(name, F.lit(None).cast("int"))
    drifting.drop("new_status", "new_updated_at").write.mode("append").partitionBy("service", "api", "dt").parquet(root)

    cover = E.uniform_paths(E.drifted_columns(spark, root), root)
    assert cover == {
        "": [f"{root}/service=s/api=blogs"],
        "`content_id` int, `old_status` int, `draft_created_at` int": [f"{root}/service=s/api=authors"],
    }
    stored = E.union_by_name_scan(spark, root).orderBy("api").collect()
    assert [row.api for row in stored] == ["authors", "blogs"]
    assert [row.content_id for row in stored] == [None, "A"]
    assert [row.draft_created_at for row in stored] == [None, at("06-01 00:00")]
    assert E.union_by_name_scan(spark, root).schema == E.scan_events(spark, root).schema


def test_stored_footers_are_read_once(spark, tmp_path):
    root, stored = str(tmp_path / "events"), str(tmp_path / "drift")
    table = events(spark, {"service": "s", "api": "blogs", "dt": day("06-30"), "content_id": "A"})
    S.write_events(table, root)
    assert E.drifted_columns(spark, root, stored).collect()[0].drift == ""
    # The first file is spoilt without its size or time showing it: only its stored footer can be used.
    (first,) = Path(root).rglob("*.parquet")
    was = first.stat()
    first.write_bytes(b"x" * was.st_size)
    os.utime(first, ns=(was.st_atime_ns, was.st_mtime_ns))
    drifting = events(spark, {"service": "s", "api": "authors", "dt": day("06-30")}).withColumn("content_id", F.lit(None).cast("int"))
    drifting.write.mode("append").partitionBy("service", "api", "dt").parquet(root)
    for _ in range(2):
        cover = E.uniform_paths(E.drifted_columns(spark, root, stored), root)
        assert cover == {"": [f"{root}/service=s/api=blogs"], "`content_id` int": [f"{root}/service=s/api=authors"]}
    # Changed and removed files are noticed.
    first.unlink()
    S.write_events(table, root)
    assert sorted(r.api for r in E.union_by_name_scan(spark, root, stored=stored).collect()) == ["authors", "blogs"]
    assert E.drifted_columns(spark, root, stored).count() == 2 and spark.read.parquet(stored).count() == 3


def bodies():
    texts = [payload("edit", "DRAFT", "PUBLISH", api="a b"), payload("new", None, "DRAFT", api="a b"), "{", "{}"]
    landed = [signed(text) for text in texts]
    return [*landed, (landed[0][0], None, landed[0][2]), (landed[0][0], "bad", landed[0][2])]


def test_batch_ingest_fills_both_tables(spark, tmp_path):
    root = str(tmp_path / "ingested")
    ingest_batch(deliveries(spark, *bodies()), SECRET, root)
    stored = E.scan_events(spark, S.events_root(root))
    assert sorted(row.api for row in stored.collect()) == ["a_b", "a_b", "unknown"]
    rejected = E.scan_quarantine(spark, S.quarantine_root(root)).collect()
    assert sorted(row.reject_reason for row in rejected) == [
        I.INVALID_SIGNATURE,
        I.MISSING_SIGNATURE,
        I.PARSE_ERROR,
    ]
    assert all(row.body is not None for row in rejected)
    direct = I.normalize_events(deliveries(spark, *bodies()), SECRET)
    span = days("06-29", "06-29")
    assert rows(M.calendar_heatmap(stored, span)) == rows(M.calendar_heatmap(direct, span))
    assert rows(M.publish_action_summary(stored, span)) == rows(M.publish_action_summary(direct, span))


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "streamed")
    classified = I.classify_deliveries(deliveries(spark, *bodies()), SECRET)
    for batch_id in (0, 1, 1, 0):
        S.write_deliveries(classified, root, batch_id=batch_id)
    assert E.scan_events(spark, S.events_root(root)).count() == 6
    assert E.scan_quarantine(spark, S.quarantine_root(root)).count() == 6
    assert rows(N.table_summary(spark, S.events_root(root)))[0][0] == 6


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landed, root, progress = (str(tmp_path / name) for name in ("landed", "streamed", "progress"))

    def land():
        deliveries(spark, *bodies()).drop("n").repartition(2).write.mode("append").parquet(landed)

    def run():
        stream = raw_webhook_stream(spark, landed, max_files_per_trigger=1)
        start_ingest(stream, SECRET, root, progress).awaitTermination()
        return E.scan_events(spark, S.events_root(root))

    land()
    batch = str(tmp_path / "batch")
    ingest_batch(raw_webhooks(spark, landed), SECRET, batch)
    expected = E.scan_events(spark, S.events_root(batch))
    assert sorted(rows(run()), key=repr) == sorted(rows(expected), key=repr)
    assert run().count() == 3
    land()
    assert run().count() == 6
    assert E.scan_quarantine(spark, S.quarantine_root(root)).count() == 6


def test_scratch_paths_are_fresh_and_under_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(base) and second.startswith(base)


def test_seven_reports_over_two_writers(spark, tmp_path):
    """Ten events of one day, the ones of the second API written with untyped NULL columns."""
    root, today = str(tmp_path / "events"), "06-20"

    def blog(kind, event_type="edit", content_id=None, received="06-20 01:00", **times):
        row = {"service": "s", "api": "blogs", "dt": day(today), "event_kind": kind, "event_type": event_type,
               "content_id": content_id, "received_at": at(received)}
        return row | {name: at(text) for name, text in times.items()}

    blogs = events(
        spark,
        blog("PUBLISH_FROM_DRAFT", content_id="A", content_created_at="06-18 12:00", content_published_at="06-20 12:00"),
        blog("INITIAL_DRAFT", "new", "A", draft_created_at="06-15 12:00"),
        blog("UPDATE_PUBLISHED", content_id="A", received="06-20 13:00"),
        blog("UNPUBLISH_TO_DRAFT"),
        blog("UNPUBLISH_TO_CLOSED"),
        blog("ADD_DRAFT_TO_PUBLISHED"),
        blog("DISCARD_DRAFT_ON_PUBLISHED"),
        blog(None),
        blog("INITIAL_PUBLISH", "new", "B", content_created_at="06-20 08:00", content_published_at="06-20 14:00"),
    )
    S.write_events(blogs, root)
    authors = events(
        spark, {"service": "s", "api": "authors", "dt": day(today), "event_kind": "DELETE_PUBLISHED", "event_type": "delete"}
    )
    for name in ("content_id", "draft_created_at", "content_created_at", "content_published_at"):
        authors = authors.withColumn(name, F.lit(None).cast("int"))
    authors.write.mode("append").partitionBy("service", "api", "dt").parquet(root)

    table, span = E.union_by_name_scan(spark, root), days("06-19", "06-21")
    assert [row[1] for row in rows(M.calendar_heatmap(table, span))] == [0, 10, 0]
    activity = M.api_activity(table, span).collect()
    assert [(row.api, row.total_count, row.delete_published_count) for row in activity] == [
        ("blogs", 9, 0),
        ("authors", 1, 1),
    ]
    assert rows(M.top_updated_contents(table, span)) == [
        ("blogs", "A", 3, "2026-06-20T13:00:00Z"),
        ("blogs", "B", 1, "2026-06-20T01:00:00Z"),
    ]
    assert rows(M.average_time_to_publish(table, span)) == [("blogs", 1.125, None)]
    assert rows(M.average_draft_to_publish(table, span)) == [("blogs", 5.0, None, 1)]
    assert rows(M.publish_action_summary(table, span)) == [(2, 3, 6, 0.5)]
    assert rows(M.publish_action_trend(table, span))[1][1:] == (1, 1, 0, 2)
