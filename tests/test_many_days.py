"""Tables of many days: how they are listed, and how a stream's micro-batches reach them."""

from datetime import datetime, timedelta

from builders import SECRET, day, deliveries, events, payload, rows, signed
from pyspark.sql import DataFrameWriter, functions as F

from catalogue import queries, sample
from slugline.operators import ingest as I
from slugline.operators import maintenance as K
from slugline.operators import sink as S
from slugline.sources import events as E
from slugline.sources.files import partition_files


def batch_of(spark, n_days):
    """An accepted and a rejected delivery on each of some days."""
    sent = []
    for number in range(n_days):
        raw, digest, _ = signed(payload("edit", "DRAFT", "PUBLISH", id=f"c{number}", service="s", api="a"))
        when = datetime.combine(day("06-01"), datetime.min.time()) + timedelta(days=number)
        sent += [(raw, digest, when), (raw, None, when)]
    return I.classify_deliveries(deliveries(spark, *sent), SECRET)


def test_listing_many_days_takes_few_tasks(spark, tmp_path):
    for number in range(150):
        folder = tmp_path / f"service=s/api=a/dt={day('01-01') + timedelta(days=number)}"
        folder.mkdir(parents=True)
        (folder / "events.parquet").write_bytes(b"never opened")
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    try:
        listed = partition_files(spark, str(tmp_path))
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 64
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert listed.select("dt").distinct().count() == 150


def test_only_a_batch_that_was_begun_before_is_replaced(spark, tmp_path, monkeypatch):
    root, modes = tmp_path / "streamed", []
    mode_of = DataFrameWriter.mode
    monkeypatch.setattr(DataFrameWriter, "mode", lambda writer, mode: modes.extend([mode] if mode else []) or mode_of(writer, mode))
    batch = batch_of(spark, 3)

    def stored():
        events, rejected = S.events_root(str(root)), S.quarantine_root(str(root))
        return E.scan_events(spark, events).count(), E.scan_quarantine(spark, rejected).count()

    for batch_id in (0, 1, 1, 0):
        S.write_deliveries(batch, str(root), batch_id=batch_id)
    assert modes == ["append", "append", "overwrite", "overwrite"] and stored() == (6, 6)
    # A table that was written without notes may hold any batch.
    for note in (root / S.BEGUN).iterdir():
        note.rmdir()
    (root / S.BEGUN).rmdir()
    S.write_deliveries(batch, str(root), batch_id=1)
    S.write_deliveries(batch, str(root), batch_id=2)
    assert modes[4:] == ["overwrite", "append"] and stored() == (9, 9)


def test_what_an_interrupted_batch_left_is_replaced(spark, tmp_path):
    root = str(tmp_path / "streamed")
    batch = batch_of(spark, 3)
    # It was begun, and some of its files had reached the table.
    assert not S._begun_before(spark, root, 5)
    part = batch.where("day(dt) = 1").withColumn(S.BATCH_COLUMN, S.F.lit(5)).withColumn("table", S.F.lit("events"))
    for left in (root, f"{root}/_temporary/0/task_0"):
        part.where("reject_reason IS NULL").write.mode("append").partitionBy("table", "service", "api", "dt", S.BATCH_COLUMN).parquet(left)
    assert E.scan_events(spark, S.events_root(root)).count() == 1
    S.write_deliveries(batch, root, batch_id=5)
    assert E.scan_events(spark, S.events_root(root)).count() == 3
    # Nor does the next batch bring in files that were ready but not yet in the table.
    S.write_deliveries(batch, root, batch_id=6)
    assert E.scan_events(spark, S.events_root(root)).count() == 6


def test_the_copy_shuffles_its_events_once(spark, tmp_path, monkeypatch):
    source, target, laid_out = str(tmp_path / "events"), str(tmp_path / "copy"), []
    table = events(spark, *[{"service": "s", "api": api, "dt": day(d)} for api in ("a", None) for d in ("06-28", "06-29")])
    S.write_events(table, source)
    spread_rows = K.spread_rows
    monkeypatch.setattr(K, "spread_rows", lambda given, *keys: laid_out.append(given) or spread_rows(given, *keys))
    assert K.compact_events(spark, source, target) == 4
    (given,) = laid_out
    plan = given._sc._jvm.PythonSQLUtils.explainString(given._jdf.queryExecution(), "simple")
    # What is due meets the events in the tasks that read them; the write's rebalance is the only shuffle.
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert sorted(map(repr, rows(E.scan_events(spark, target)))) == sorted(map(repr, rows(E.scan_events(spark, source))))
    assert K.compact_events(spark, source, target) == 0


def test_bodies_of_one_row_group_are_made_by_all_tasks(spark, tmp_path):
    twice = [*range(400), 7, 7, None]
    supplied = spark.createDataFrame([(n,) for n in twice], "event_id long").select(
        "event_id", (F.col("event_id") % 40).alias("user_id"), F.lit(datetime(2024, 1, 5)).alias("ts"), F.lit("{}").alias("props")
    )
    supplied.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    tasks = spark.sparkContext.defaultParallelism
    for spread, one in (
        (queries._events(spark, str(tmp_path)).select("raw_payload"), sample.content_events(spark, str(tmp_path)).select("raw_payload")),
        (sample.webhooks(spark, str(tmp_path), spread=tasks), sample.webhooks(spark, str(tmp_path))),
    ):
        assert one.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() == tasks
        held = spread.rdd.glom().map(len).collect()
        assert sum(held) == len(twice) and min(held) > 0
        assert sorted(map(repr, spread.collect())) == sorted(map(repr, one.collect()))
