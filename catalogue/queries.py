"""Every query of the engine by name: (spark, folder of the supplied tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from catalogue import sample
from slugline.functions import payload as P
from slugline.functions.days import business_day, business_day_of_millis
from slugline.functions.lifecycle import event_kind
from slugline.functions.partitions import partition_value
from slugline.functions.timestamps import rfc3339_timestamp
from slugline.operators import counts as C
from slugline.operators import ingest as I
from slugline.operators import inventory as N
from slugline.operators import maintenance as K
from slugline.operators import metrics as M
from slugline.operators import privacy as R
from slugline.operators import sink as S
from slugline.operators import views as V
from slugline.operators.export import json_document, json_rows
from slugline.plans import dashboard
from slugline.plans.ingest import backfill_days, ingest_batch, ingest_new
from slugline.plans.params import DurationUnit, TimeRange
from slugline.schema import PARTITION_COLUMNS, RAW_SCHEMA
from slugline.session import pin_session, scratch_path
from slugline.sources import events as E
from slugline.sources import webhooks as W
from slugline.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]

MAIN = TimeRange.of_days(date(2024, 1, 5), date(2024, 1, 24))
WIDE = TimeRange.of_days(date(2023, 12, 28), date(2024, 2, 3))
EMPTY = TimeRange.of_days(date(2025, 1, 1), date(2025, 1, 1))
# From 12:00 of the first business day to 23:30 of the last one.
MIDDAY = TimeRange.of(1_704_423_600_000, 1_706_106_600_000)
TOP = 15
ROWS_PER_FILE = 25
SIGNATURE_HEADER = "X-Webhook-Signature"
DAYS, HOURS = DurationUnit.DAYS, DurationUnit.HOURS

# --- tables several queries read, written once per session -------------------------------------

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.content_events(spark, sf_dir, spread=spark.sparkContext.defaultParallelism).drop("event_id")


def event_table(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "events", lambda root: S.write_events(_events(spark, sf_dir), root))


def _landed_webhooks(spark: SparkSession, sf_dir: str) -> str:
    """Deliveries as a receiver would land them: body, header map, receive time."""
    name = F.when(F.pmod("event_id", F.lit(2)) == 0, SIGNATURE_HEADER).otherwise(SIGNATURE_HEADER.lower())
    headers = F.when(
        F.col("signature").isNotNull(),
        F.create_map(F.lit("Content-Type"), F.lit("application/json"), name, F.col("signature")),
    ).otherwise(F.create_map(F.lit("Content-Type"), F.lit("application/json")))
    # As many files as the session has cores, as receivers that write side by side would leave. A stream takes four at
    # a time; row groups of 8 MB let all cores share them. The supplied rows are spread, not the larger bodies.
    webhooks = sample.webhooks(spark, sf_dir, spread=spark.sparkContext.defaultParallelism)
    landed = webhooks.select("event_id", "body", headers.alias("headers"), "received_at")
    return _once(spark, sf_dir, "landed", landed.write.option("parquet.block.size", 8 * 1024 * 1024).parquet)


LANDED_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        RAW_SCHEMA["body"],
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        RAW_SCHEMA["received_at"],
    ]
)


def landed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_webhooks(spark, sf_dir)
    return W.raw_webhooks(spark, path, schema=LANDED_SCHEMA, signature_header=SIGNATURE_HEADER)


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    raw = landed_batch(spark, sf_dir)
    return _once(spark, sf_dir, "ingested", lambda root: ingest_batch(raw, sample.SECRET, root))


# --- scans and sinks ----------------------------------------------------------------------------


def scan_events(spark, sf_dir):
    table = E.scan_events(spark, event_table(spark, sf_dir))
    return table.groupBy(*PARTITION_COLUMNS, "event_kind").agg(F.count("*").alias("event_count"))


def scan_events_of_days(spark, sf_dir):
    table = E.scan_events(spark, event_table(spark, sf_dir), MAIN)
    return table.groupBy("dt", "api").agg(F.count("*").alias("event_count"))


def parquet_roundtrip(spark, sf_dir):
    return E.scan_events(spark, event_table(spark, sf_dir))


def partition_layout(spark, sf_dir):
    files = N.file_inventory(spark, event_table(spark, sf_dir))
    folder = F.regexp_extract("file_path", r"/(service=[^/]+/api=[^/]+/dt=[^/]+)/[^/]+\.parquet$", 1)
    return files.groupBy(folder.alias("partition_path")).agg(F.sum("event_count").alias("event_count"))


def sharded_write(spark, sf_dir):
    root = scratch_path(spark, "sharded")
    S.write_events(_events(spark, sf_dir), root, rows_per_file=ROWS_PER_FILE)
    small = F.col("largest_file_events") <= ROWS_PER_FILE
    return N.partition_inventory(spark, root).select(*PARTITION_COLUMNS, "event_count", small.alias("files_are_small"))


def overwrite_write(spark, sf_dir):
    root = scratch_path(spark, "replaced")
    earlier = _events(spark, sf_dir).withColumn("dt", F.date_sub("dt", 400))
    S.write_events(earlier, root)
    S.write_events(_events(spark, sf_dir), root, mode="overwrite")
    return E.scan_events(spark, root).groupBy("dt").agg(F.count("*").alias("event_count"))


def partition_inventory(spark, sf_dir):
    """What the table holds, and that each partition has a file: more than one only where it is large."""
    enough = (F.col("file_count") >= F.col("partition_count")).alias("has_files")
    kept = ["event_count", "partition_count", "first_day", "last_day"]
    return N.table_summary(spark, event_table(spark, sf_dir)).select(*kept, enough)


def union_by_name_scan(spark, sf_dir):
    """Four writers: complete, without columns, all-NULL columns as INT, and an all-NULL api as INT.

    The last one's folders name service and api as well, as the event table's do.
    """
    root = scratch_path(spark, "drifting")
    values = {name: partition_value(F.col(name)) for name in ("service", "api")}
    events = _events(spark, sf_dir).withColumns(values)
    fresh, gone = "event_type = 'new' AND old_status IS NULL", "event_type = 'delete' AND new_status IS NULL"
    created = events.where(fresh).drop("old_status", "old_updated_at")
    deleted = events.where(gone).withColumns(
        {
            name: F.lit(None).cast("int")
            for name in (
                "new_status",
                "new_updated_at",
                "draft_created_at",
                "content_created_at",
                "content_published_at",
            )
        }
    )
    for part in (events.where(f"NOT ({fresh} OR {gone})"), created, deleted):
        part.where("api <> 'unknown'").hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(
            f"{root}/dated"
        )
    named = events.where("api = 'unknown'").withColumn("api", F.lit(None).cast("int"))
    for service in ("svc-0", "svc-1", "svc-2"):
        for_path = named.where(F.col("service") == service)
        folder = f"{root}/named/service={service}/api=unknown"
        for_path.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(folder)
    stored = scratch_path(spark, "drift")
    E.drifted_columns(spark, f"{root}/dated", stored)
    dated = E.union_by_name_scan(spark, f"{root}/dated", stored=stored)
    return dated.unionByName(E.union_by_name_scan(spark, f"{root}/named"))


# --- ingest -------------------------------------------------------------------------------------


def raw_webhooks(spark, sf_dir):
    return landed_batch(spark, sf_dir).select(
        "received_at",
        "signature",
        F.sha2("body", 256).alias("body_sha256"),
        F.octet_length("body").cast("bigint").alias("body_bytes"),
    )


def verify_signature(spark, sf_dir):
    checked = I.verify_signature(landed_batch(spark, sf_dir), sample.SECRET)
    return checked.select("event_id", "signature_ok")


def reject_classification(spark, sf_dir):
    deliveries = I.classify_deliveries(landed_batch(spark, sf_dir), sample.SECRET)
    return deliveries.select("event_id", "reject_reason", "reject_class")


def normalize_events(spark, sf_dir):
    return I.normalize_events(landed_batch(spark, sf_dir), sample.SECRET)


def ingest_events(spark, sf_dir):
    return E.scan_events(spark, S.events_root(_ingested(spark, sf_dir)))


def ingest_quarantine(spark, sf_dir):
    stored = E.scan_quarantine(spark, S.quarantine_root(_ingested(spark, sf_dir)))
    return stored.select(
        "received_at", "dt", "reject_reason", "reject_class", F.sha2("body", 256).alias("body_sha256")
    )


def _stream_of(spark, landing: str) -> DataFrame:
    return W.raw_webhook_stream(
        spark, landing, schema=LANDED_SCHEMA, signature_header=SIGNATURE_HEADER, max_files_per_trigger=4
    )


def _streamed(spark, sf_dir) -> str:
    def write(root: str) -> None:
        stream = _stream_of(spark, _landed_webhooks(spark, sf_dir))
        start_ingest(stream, sample.SECRET, root, scratch_path(spark, "progress")).awaitTermination()

    return _once(spark, sf_dir, "streamed", write)


def stream_ingest(spark, sf_dir):
    return E.scan_events(spark, S.events_root(_streamed(spark, sf_dir)))


def deduplicated_stream(spark, sf_dir):
    """Every seventh delivery lands a second time, after the stream has stopped; it goes on from its checkpoint."""
    landing, root, progress = (scratch_path(spark, name) for name in ("again", "deduplicated", "progress"))
    landed = spark.read.schema(LANDED_SCHEMA).parquet(_landed_webhooks(spark, sf_dir))
    for part in (landed, landed.where("event_id % 7 = 0")):
        part.write.mode("append").parquet(landing)
        query = start_ingest(
            _stream_of(spark, landing), sample.SECRET, root, progress, drop_repeated_within="7 days"
        )
        query.awaitTermination()
    return E.scan_events(spark, S.events_root(root))


def idempotent_ingest(spark, sf_dir):
    """The even deliveries, then all of them, then all of them twice over."""
    root = scratch_path(spark, "once")
    raw = landed_batch(spark, sf_dir)
    for batch in (raw.where("event_id % 2 = 0"), raw, raw.union(raw)):
        ingest_new(batch, sample.SECRET, root)
    events = E.scan_events(spark, S.events_root(root)).select("dt", F.lit("events").alias("stored_as"))
    rejected = E.scan_quarantine(spark, S.quarantine_root(root)).select("dt", F.lit("quarantine").alias("stored_as"))
    return events.union(rejected).groupBy("dt", "stored_as").agg(F.count("*").alias("record_count"))


def _compacted(spark, sf_dir) -> str:
    source = S.events_root(_streamed(spark, sf_dir))
    return _once(spark, sf_dir, "compacted", lambda root: K.compact_events(spark, source, root))


def compacted_events(spark, sf_dir):
    return E.scan_events(spark, _compacted(spark, sf_dir))


def compaction_plan(spark, sf_dir):
    """After the copy no partition is due, and the copy has a file for each of these small partitions."""
    source, target = S.events_root(_streamed(spark, sf_dir)), _compacted(spark, sf_dir)
    due = K.compaction_plan(spark, source, target).select(*PARTITION_COLUMNS, "due")
    return due.join(K.partition_sizes(spark, target), [*PARTITION_COLUMNS]).select(*PARTITION_COLUMNS, "due", "file_count")


def backfilled_days(spark, sf_dir):
    """The even deliveries land first, then the odd ones of some days: those days are rebuilt."""
    landing, root, ledger = (scratch_path(spark, name) for name in ("landing", "backfilled", "ledger"))
    landed = spark.read.schema(LANDED_SCHEMA).parquet(_landed_webhooks(spark, sf_dir))
    odd = (F.col("event_id") % 2 == 1) & business_day(F.col("received_at")).between(F.lit(MAIN.first_day), F.lit(MAIN.last_day))
    for part in (landed.where("event_id % 2 = 0"), landed.where(odd)):
        part.write.mode("append").parquet(landing)
        for _ in range(2):
            backfill_days(
                spark, landing, sample.SECRET, root, ledger, schema=LANDED_SCHEMA, signature_header=SIGNATURE_HEADER
            )
    return E.scan_events(spark, S.events_root(root))


def expired_partitions(spark, sf_dir):
    expired = K.expired_partitions(spark, event_table(spark, sf_dir), MAIN.first_day)
    return expired.select(*PARTITION_COLUMNS, (F.col("bytes") > 0).alias("has_bytes"))


def masked_payload(spark, sf_dir):
    return R.mask_payload(_events(spark, sf_dir), sample.SECRET)


def split_payload(spark, sf_dir):
    root = _once(spark, sf_dir, "split", lambda root: R.write_split_events(_events(spark, sf_dir), root))
    return R.join_payloads(R.scan_split_events(spark, root), R.scan_payloads(spark, root))


def allowed_columns(spark, sf_dir):
    root = scratch_path(spark, "allowed")
    S.write_events(R.only_columns(_events(spark, sf_dir), ["event_kind", "content_id"]), root)
    return E.scan_events(spark, root)


def _parsed_contents(spark, sf_dir) -> DataFrame:
    """Every payload of the sample as (event_id, event_type, old and new status lists)."""
    payload = F.col("payload")
    return (
        sample.content_events(spark, sf_dir)
        .select("event_id", P.parse_sealed(F.col("raw_payload"), F.lit("end")).alias("parsed"))
        .select("event_id", P.payload_of(F.col("parsed")).alias("payload"))
        .select(
            "event_id",
            payload["type"].cast("string").alias("event_type"),
            P.status_list(payload["contents"]["old"]["status"]).alias("old_statuses"),
            P.status_list(payload["contents"]["new"]["status"]).alias("new_statuses"),
        )
    )


def status_extraction(spark, sf_dir):
    return _parsed_contents(spark, sf_dir).select(
        "event_id",
        P.status_csv(F.col("old_statuses")).alias("old_status"),
        P.status_csv(F.col("new_statuses")).alias("new_status"),
    )


def event_kinds(spark, sf_dir):
    kind = event_kind(F.col("event_type"), F.col("old_statuses"), F.col("new_statuses"))
    return _parsed_contents(spark, sf_dir).select("event_id", kind.alias("event_kind"))


def _spelling(position: int) -> Column:
    """`ts` the way one kind of sender would write it, as (updatedAt, updated_at) JSON values."""
    ts = F.col("ts").cast("timestamp")

    def text(hours: float, suffix: str) -> Column:
        local = ts + F.make_dt_interval(secs=F.lit(int(hours * 3600)))
        return F.concat(
            F.lit('"'), F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(suffix + '"')
        )

    other = F.lit('"2001-02-03T04:05:06Z"')
    first, second = {
        0: (text(0, "Z"), other),
        1: (text(9, "+09:00"), other),
        2: (text(-5.5, "-05:30"), other),
        3: (F.lower(text(0, "z")), other),
        4: (text(0, "789Z"), other),
        5: (text(0, ""), other),
        6: (F.lit("5"), text(0, "Z")),
        7: (F.concat(F.lit('"'), F.date_format(ts, "yyyy-MM-dd"), F.lit('"')), other),
        8: (text(23.25, "+23:15"), other),
    }[position]
    return F.concat(
        F.lit('{"contents":{"new":{"updatedAt":'), first, F.lit(',"updated_at":'), second, F.lit("}}}")
    )


def payload_timestamps(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    spelled = F.element_at(F.array(*[_spelling(position) for position in range(9)]), F.col("row"))
    return (
        events.withColumn("row", (F.pmod("event_id", F.lit(9)) + 1).cast("int"))
        .select("event_id", P.parse_sealed(spelled, F.lit("end")).alias("parsed"))
        .select("event_id", P.payload_of(F.col("parsed")).alias("payload"))
        .select("event_id", P.updated_at_text(F.col("payload.contents.new")).alias("text"))
        .select("event_id", rfc3339_timestamp(F.col("text")).alias("updated_at"))
    )


def jst_partition_day(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", business_day(F.col("ts").cast("timestamp")).alias("dt"))


def partition_escape(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sometimes_absent = F.when(F.pmod("page_id", F.lit(10)) != 0, F.col("url"))
    return pages.select("page_id", partition_value(sometimes_absent).alias("partition_value"))


def jst_day_bounds(spark, sf_dir):
    millis = F.unix_millis("received_at")
    return (
        C.in_range(_events(spark, sf_dir), MIDDAY)
        .groupBy(business_day_of_millis(millis).alias("dt"))
        .agg(
            F.count("*").alias("event_count"),
            F.min("received_at").alias("first_received_at"),
            F.max("received_at").alias("last_received_at"),
        )
    )


# --- reports and views --------------------------------------------------------------------------


def _report(metric: Callable[..., DataFrame], span: TimeRange, *args, **kwargs) -> Query:
    def report(spark, sf_dir):
        events = sample.content_events(spark, sf_dir, with_payload=False)
        return metric(events, span, *args, **kwargs)

    return report


def _view(view: Callable[[DataFrame], DataFrame], report: Query) -> Query:
    return lambda spark, sf_dir: view(report(spark, sf_dir))


def _panel(name: str) -> Query:
    """A count panel out of the shared cube, which is counted from the stored table."""

    def panel(spark, sf_dir):
        table = E.scan_events(spark, event_table(spark, sf_dir))
        return dashboard.count_panels(dashboard.activity_cube(table, MAIN), MAIN)[name]

    return panel


api_activity = _report(M.api_activity, MAIN)
top_updated = _report(M.top_updated_contents, MAIN, limit=TOP)
to_publish_days = _report(M.average_time_to_publish, MAIN, DAYS)
to_publish_hours = _report(M.average_time_to_publish, MAIN, HOURS)
from_draft_days = _report(M.average_draft_to_publish, MAIN, DAYS)
from_draft_hours = _report(M.average_draft_to_publish, MAIN, HOURS)

REPORTS: dict[str, Query] = {
    "calendar_heatmap": _report(M.calendar_heatmap, MAIN),
    "calendar_heatmap_quiet_days": _report(M.calendar_heatmap, WIDE),
    "publish_action_summary": _report(M.publish_action_summary, MAIN),
    "publish_action_summary_empty": _report(M.publish_action_summary, EMPTY),
    "publish_action_trend": _report(M.publish_action_trend, MAIN),
    "publish_action_trend_quiet_days": _report(M.publish_action_trend, WIDE),
    "api_activity": api_activity,
    "top_updated_contents": top_updated,
    "avg_time_to_publish_days": to_publish_days,
    "avg_time_to_publish_hours": to_publish_hours,
    "avg_draft_to_publish_days": from_draft_days,
    "avg_draft_to_publish_hours": from_draft_hours,
    "activity_cube": _report(dashboard.activity_cube, MAIN),
    "panel_calendar_heatmap": _panel("calendar_heatmap"),
    "panel_publish_action_summary": _panel("publish_action_summary"),
    "panel_publish_action_trend": _panel("publish_action_trend"),
    "panel_api_activity": _panel("api_activity"),
    "api_activity_by_category": _view(V.activity_view, api_activity),
    "api_activity_detail_view": _view(partial(V.activity_view, view=V.ActivityView.DETAIL), api_activity),
    "operation_category_breakdown": _view(V.operation_category_breakdown, api_activity),
    "top_updated_view": _view(V.top_updated_view, top_updated),
    "duration_view_days": _view(partial(V.duration_view, unit=DAYS), to_publish_days),
    "duration_view_hours": _view(partial(V.duration_view, unit=HOURS), from_draft_hours),
    "publish_duration_bands": _view(partial(V.duration_bands, unit=DAYS), to_publish_days),
    "draft_duration_bands": _view(partial(V.duration_bands, unit=HOURS), from_draft_hours),
    "metric_json": _view(json_rows, _report(M.api_activity, MAIN)),
    "metric_json_null_unit": _view(json_rows, from_draft_days),
    "metric_json_document": _view(json_document, top_updated),
}

OPERATORS: dict[str, Query] = {
    "scan_events": scan_events,
    "scan_events_of_days": scan_events_of_days,
    "union_by_name_scan": union_by_name_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "partition_layout": partition_layout,
    "sharded_write": sharded_write,
    "overwrite_write": overwrite_write,
    "partition_inventory": partition_inventory,
    "raw_webhooks": raw_webhooks,
    "verify_signature": verify_signature,
    "reject_classification": reject_classification,
    "normalize_events": normalize_events,
    "ingest_events": ingest_events,
    "ingest_quarantine": ingest_quarantine,
    "stream_ingest": stream_ingest,
    "deduplicated_stream": deduplicated_stream,
    "idempotent_ingest": idempotent_ingest,
    "compacted_events": compacted_events,
    "compaction_plan": compaction_plan,
    "backfilled_days": backfilled_days,
    "expired_partitions": expired_partitions,
    "masked_payload": masked_payload,
    "split_payload": split_payload,
    "allowed_columns": allowed_columns,
    "status_extraction": status_extraction,
    "payload_timestamps": payload_timestamps,
    "event_kind": event_kinds,
    "jst_partition_day": jst_partition_day,
    "partition_escape": partition_escape,
    "jst_day_bounds": jst_day_bounds,
}


def _pinned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(pin_session(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {name: _pinned(query) for name, query in {**OPERATORS, **REPORTS}.items()}
