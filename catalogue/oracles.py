"""The same results as plain SQL over the supplied tables, written without the engine's code.

`EV` is FIXTURES.md 5.1 and 5.2, `WH` is 5.4. Accepted and rejected records follow from the
divisors that plant the faults, not from parsing or verifying anything.
"""

from __future__ import annotations

from catalogue.sample import OTHER_SECRET, SECRET

FIRST, LAST = "DATE '2024-01-05'", "DATE '2024-01-24'"
WIDE_FIRST, WIDE_LAST = "DATE '2023-12-28'", "DATE '2024-02-03'"
IN_RANGE = f"dt BETWEEN {FIRST} AND {LAST}"

# The fourteen kinds of event.
KINDS = [
    "INITIAL_DRAFT", "SAVE_DRAFT", "PUBLISH_FROM_DRAFT", "INITIAL_PUBLISH", "UPDATE_PUBLISHED",
    "ADD_DRAFT_TO_PUBLISHED", "DISCARD_DRAFT_ON_PUBLISHED", "UNPUBLISH_TO_DRAFT",
    "UNPUBLISH_TO_CLOSED", "REOPEN_TO_DRAFT", "REPUBLISH_FROM_CLOSED", "DELETE_DRAFT",
    "DELETE_PUBLISHED", "DELETE_CLOSED",
]

# The decision table: what a set of statuses means, then what a change of meaning is called.
MATRIX = """
states(state_no, csv) AS (
  VALUES (0, NULL), (1, 'DRAFT'), (2, 'PUBLISH'), (3, 'DRAFT,PUBLISH'), (4, 'CLOSED'), (5, 'CLOSED,DRAFT')
),
meanings AS (
  SELECT state_no, csv, CASE WHEN csv LIKE '%PUBLISH' THEN 'P' WHEN csv = 'DRAFT' THEN 'D' WHEN csv = 'CLOSED' THEN 'C'
    ELSE '-' END AS sense
  FROM states
),
types(type_no, event_type) AS (VALUES (0, 'delete'), (1, 'edit'), (2, 'new')),
names(event_type, turn, kind) AS (
  VALUES ('delete', 'C-', 'DELETE_CLOSED'), ('delete', 'D-', 'DELETE_DRAFT'), ('delete', 'P-', 'DELETE_PUBLISHED'),
    ('new', '-D', 'INITIAL_DRAFT'), ('new', '-P', 'INITIAL_PUBLISH'), ('edit', 'DD', 'SAVE_DRAFT'),
    ('edit', 'DP', 'PUBLISH_FROM_DRAFT'), ('edit', 'PD', 'UNPUBLISH_TO_DRAFT'), ('edit', 'PC', 'UNPUBLISH_TO_CLOSED'),
    ('edit', 'CD', 'REOPEN_TO_DRAFT'), ('edit', 'CP', 'REPUBLISH_FROM_CLOSED'), ('edit', 'PP', 'UPDATE_PUBLISHED')
),
matrix AS (
  SELECT (b.state_no * 6 + a.state_no) * 3 + type_no AS row_no, event_type, b.csv AS old_status, a.csv AS new_status,
    CASE WHEN kind = 'UPDATE_PUBLISHED' AND length(a.csv) > length(b.csv) THEN 'ADD_DRAFT_TO_PUBLISHED'
         WHEN kind = 'UPDATE_PUBLISHED' AND length(a.csv) < length(b.csv) THEN 'DISCARD_DRAFT_ON_PUBLISHED'
         ELSE kind END AS event_kind
  FROM meanings b CROSS JOIN meanings a CROSS JOIN types
  LEFT JOIN names USING (event_type) WHERE turn IS NULL OR turn = b.sense || a.sense
  UNION ALL
  SELECT (b.state_no * 6 + a.state_no) * 3 + type_no, t.event_type, b.csv, a.csv, NULL
  FROM meanings b CROSS JOIN meanings a CROSS JOIN types t
  WHERE NOT EXISTS (FROM names n WHERE n.event_type = t.event_type AND n.turn = b.sense || a.sense)
)"""

EV = f"""
{MATRIX},
ev AS (
  SELECT
    e.event_id, e.ts AS received_at, e.props,
    'svc-' || (e.user_id % 3) AS service,
    CASE WHEN e.event_id % 101 <> 0
      THEN ['blogs','news','pages','authors','papers'][e.user_id % 5 + 1] END AS api,
    CASE WHEN e.event_id % 13 <> 0 THEN 'c-' || e.user_id END AS content_id,
    m.event_type, m.event_kind, m.old_status, m.new_status,
    CASE WHEN m.old_status IS NOT NULL THEN e.ts - INTERVAL 1 DAY END AS old_updated_at,
    CASE WHEN m.new_status IS NOT NULL THEN e.ts END AS new_updated_at,
    CASE WHEN m.new_status IN ('DRAFT', 'DRAFT,PUBLISH')
      THEN e.ts - to_seconds(e.event_id * 7919 % 864000) END AS draft_created_at,
    CASE WHEN m.new_status IN ('PUBLISH', 'DRAFT,PUBLISH')
      THEN e.ts - to_seconds(e.event_id * 7919 % 1209600) END AS content_created_at,
    CASE WHEN m.new_status IN ('PUBLISH', 'DRAFT,PUBLISH')
      THEN e.ts - to_seconds(e.event_id * 104729 % 172800) END AS content_published_at,
    CAST(e.ts + INTERVAL 9 HOURS AS DATE) AS dt
  FROM events e JOIN matrix m ON e.event_id % 108 = m.row_no
)"""


def _stamp(column: str) -> str:
    return f"coalesce('\"' || strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\"', 'null')"


def _text(column: str) -> str:
    return f"coalesce('\"' || {column} || '\"', 'null')"


def _status(column: str) -> str:
    backwards = f"list_reverse(string_split({column}, ','))"
    return f"""CASE WHEN event_id % 2 = 0 AND {column} NOT LIKE '%,%' THEN '"' || {column} || '"'
      ELSE '["' || array_to_string(list_concat({backwards}, {backwards}[1:1]), '","') || '"]' END"""


BODY = f"""
EV_WITH_BODY AS (
  SELECT *,
    '{{"service":' || {_text("service")} || ',"api":' || {_text("api")} || ',"id":' || {_text("content_id")}
    || ',"type":' || {_text("event_type")} || ',"contents":{{"old":'
    || CASE WHEN old_status IS NULL THEN 'null' ELSE
         '{{"status":' || {_status("old_status")} || ',"updatedAt":' || {_stamp("old_updated_at")} || '}}' END
    || ',"new":'
    || CASE WHEN new_status IS NULL THEN 'null' ELSE
         '{{"status":' || {_status("new_status")} || ',"updatedAt":' || {_stamp("new_updated_at")}
         || ',"publishValue":' || CASE WHEN content_published_at IS NULL THEN 'null' ELSE
              '{{"createdAt":' || {_stamp("content_created_at")}
              || ',"publishedAt":' || {_stamp("content_published_at")} || '}}' END
         || ',"draftValue":' || CASE WHEN draft_created_at IS NULL THEN 'null' ELSE
              '{{"createdAt":' || {_stamp("draft_created_at")} || '}}' END
         || ',"fields":' || CASE WHEN event_id % 7 = 0 THEN '{{"a":1,"a":' || props || '}}' ELSE props END || '}}' END
    || '}}}}' AS raw_payload
  FROM ev
)"""


def _pad(secret: bytes, byte: int) -> str:
    return "unhex('" + bytes(b ^ byte for b in secret.ljust(64, b"\0")).hex() + "')"


def _hmac(secret: bytes) -> str:
    return f"sha256({_pad(secret, 0x5C)} || unhex(sha256({_pad(secret, 0x36)} || body)))"


WH = f"""
damaged AS (
  SELECT event_id, received_at,
    CASE
      WHEN event_id % 29 = 0 OR event_id % 19 = 0 THEN encode(raw_payload)
      WHEN event_id % 31 = 0 THEN encode(raw_payload) || unhex('ff')
      WHEN event_id % 23 = 0 THEN encode(raw_payload[:-2])
      WHEN event_id % 37 = 0 THEN encode('{{"service":5' || raw_payload[instr(raw_payload, ',"api":'):])
      WHEN event_id % 41 = 0 THEN encode('{{"service":null,' || raw_payload[2:])
      ELSE encode(raw_payload)
    END AS body
  FROM EV_WITH_BODY
),
digests AS (
  SELECT *, CASE WHEN event_id % 19 = 0 THEN {_hmac(OTHER_SECRET)} ELSE {_hmac(SECRET)} END AS digest
  FROM damaged
),
wh AS (
  SELECT event_id, received_at, body,
    CASE
      WHEN event_id % 29 = 0 THEN NULL
      WHEN event_id % 3 = 0 THEN digest
      WHEN event_id % 3 = 1 THEN base64(unhex(digest))
      ELSE 'sha256=' || digest
    END AS signature
  FROM digests
)"""

REASON = """CASE
  WHEN event_id % 29 = 0 THEN 'missing_signature'
  WHEN event_id % 19 = 0 THEN 'invalid_signature'
  WHEN event_id % 31 = 0 THEN 'invalid_body'
  WHEN event_id % 23 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 THEN 'parse_error' END"""
CLASS = """CASE
  WHEN event_id % 29 = 0 OR event_id % 19 = 0 THEN 401
  WHEN event_id % 31 = 0 OR event_id % 23 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 THEN 400 END"""

EVENT_COLUMNS = """received_at, service, api, content_id, event_type, event_kind, old_status, new_status,
  old_updated_at, new_updated_at, draft_created_at, content_created_at, content_published_at, raw_payload, dt"""
STORED_COLUMNS = EVENT_COLUMNS.replace(" api,", " coalesce(api, 'unknown') AS api,")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


EVENTS = _with(EV)
BODIES = _with(EV, BODY)
WEBHOOKS = _with(EV, BODY, WH)


def _per_day(first: str, last: str, counts: dict[str, str]) -> str:
    """One row for each day in a list of days, counted from the list of kinds seen on it."""
    days = f"list_transform(range(({last} - {first} + 1)::INT), lambda k: {first} + k::INT)"
    totals = ", ".join(f"len({kinds})::BIGINT AS {name}" for name, kinds in counts.items())
    return f"""{EVENTS}, seen AS (SELECT dt, list(coalesce(event_kind, '-')) AS kinds FROM ev GROUP BY dt),
days AS (SELECT unnest({days}) AS dt)
SELECT dt::VARCHAR || 'T00:00:00+09:00' AS time, {totals} FROM days LEFT JOIN
  (SELECT dt AS seen_on, kinds FROM seen) ON seen_on = dt"""


def _among(*kinds: str) -> str:
    return f"list_filter(coalesce(kinds, []), lambda kind: list_contains({list(kinds)}, kind))"


def _calendar(first: str, last: str) -> str:
    return _per_day(first, last, {"value": "coalesce(kinds, [])"})


def _trend(first: str, last: str) -> str:
    counts = {f"{kind.lower()}_count": _among(kind) for kind in PUBLICATIONS}
    return _per_day(first, last, counts | {"publish_count": _among(*PUBLICATIONS)})


# Which kinds are publications, leave a content published, or change its state at all.
PUBLICATIONS = ["PUBLISH_FROM_DRAFT", "INITIAL_PUBLISH", "REPUBLISH_FROM_CLOSED"]
PUBLISHED = [*PUBLICATIONS, "UPDATE_PUBLISHED"]
ARRIVALS = [*PUBLISHED, "INITIAL_DRAFT", "SAVE_DRAFT", "UNPUBLISH_TO_DRAFT", "UNPUBLISH_TO_CLOSED", "REOPEN_TO_DRAFT"]


def _summary(condition: str) -> str:
    def counted(kinds: list[str]) -> str:
        return f"count(*) FILTER (list_contains({kinds}, event_kind))"

    return f"""{EVENTS}
SELECT {counted(PUBLICATIONS)} AS publish_count, {counted(PUBLISHED)} AS published_state_count,
  {counted(ARRIVALS)} AS state_arrival_count,
  avg(list_contains({PUBLISHED}, event_kind)::INT) FILTER (list_contains({ARRIVALS}, event_kind))
    AS published_state_rate
FROM ev WHERE {condition}"""


def _activity(api: str = "api") -> str:
    counts = ",\n  ".join(f"count(*) FILTER (event_kind = '{kind}') AS {kind.lower()}_count" for kind in KINDS)
    return f"""SELECT {api} AS api,
  {counts},
  count(*)::BIGINT AS total_count
FROM ev WHERE {IN_RANGE} GROUP BY 1"""


# Which counts make up each category.
CATEGORY_SUMS = {
    "draft_activity": "initial_draft_count + save_draft_count + add_draft_to_published_count"
    " + discard_draft_on_published_count",
    "publish_activity": "publish_from_draft_count + initial_publish_count + update_published_count"
    " + republish_from_closed_count",
    "unpublish_activity": "unpublish_to_draft_count + unpublish_to_closed_count + reopen_to_draft_count",
    "delete_activity": "delete_draft_count + delete_published_count + delete_closed_count",
}

TOP_CONTENTS = f"""
SELECT api, content_id, count(*)::BIGINT AS count, max(received_at) AS last_at
FROM ev WHERE {IN_RANGE} AND event_type IN ('new', 'edit') AND content_id IS NOT NULL
GROUP BY api, content_id
ORDER BY count DESC, last_at DESC, api NULLS LAST, content_id
LIMIT 15"""


def _both_units(days: str, hours: str) -> str:
    return f"{days} AS avg_days, {hours} AS avg_hours"


def _unit(unit: str, seconds: str, samples: str) -> str:
    null = "CAST(NULL AS DOUBLE)"
    if unit == "days":
        return _both_units(f"{seconds}::DOUBLE / ({samples} * 86400.0::DOUBLE)", null)
    return _both_units(null, f"{seconds}::DOUBLE / ({samples} * 3600.0::DOUBLE)")


def _lead(later: str, earlier: str) -> str:
    """Whole seconds between two clock readings, both cut to the second."""
    return f"(epoch_us(date_trunc('second', {later})) - epoch_us(date_trunc('second', {earlier}))) // 1000000"


def _time_to_publish(unit: str) -> str:
    return f"""{EVENTS}, leads AS (
  SELECT api, {_lead("content_published_at", "content_created_at")} AS seconds,
    content_published_at - content_created_at AS apart
  FROM ev WHERE {IN_RANGE} AND list_contains({PUBLICATIONS}, event_kind)
)
SELECT api, {_unit(unit, "sum(seconds)", "count(seconds)")} FROM leads WHERE apart >= INTERVAL 0 SECONDS GROUP BY api"""


def _draft_to_publish(unit: str) -> str:
    """The first draft and the first publication of each content by rank, side by side."""
    return f"""{EVENTS}, steps AS (
  SELECT api, content_id, 'draft' AS step, draft_created_at AS moment FROM ev WHERE event_kind = 'INITIAL_DRAFT'
  UNION ALL
  SELECT api, content_id, 'publication', content_published_at FROM ev
  WHERE event_kind = 'PUBLISH_FROM_DRAFT' AND {IN_RANGE}
), firsts AS (
  SELECT * FROM steps WHERE api IS NOT NULL AND content_id IS NOT NULL AND moment IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY api, content_id, step ORDER BY moment) = 1
), paired AS (
  SELECT api, content_id, any_value(moment) FILTER (step = 'draft') AS draft_at,
    any_value(moment) FILTER (step = 'publication') AS published_at
  FROM firsts GROUP BY api, content_id
)
SELECT api, {_unit(unit, f"sum({_lead('published_at', 'draft_at')})", "count(*)")}, count(*)::BIGINT AS sample_count
FROM paired WHERE draft_at <= published_at GROUP BY api"""


def _bands(report: str, column: str, low: float, high: float) -> str:
    return f"""SELECT api, {column},
  CASE WHEN {column} < {low} THEN 'green' WHEN {column} < {high} THEN 'yellow'
       WHEN {column} >= {high} THEN 'red' END AS band
FROM ({report})"""


ACCEPTED = f"({REASON}) IS NULL"

# A payload whose free values are digests, its keys in order; the sample's only free value is `fields`.
FREE_VALUE = """CASE WHEN event_id % 7 = 0 THEN '{"a":' || replace(props, ' ', '') || '}' ELSE replace(props, ' ', '') END"""
MASKED = f"""hidden AS (SELECT *, encode({FREE_VALUE}) AS body FROM ev), masked AS (
  SELECT * EXCLUDE (body),
    '{{"api":' || {_text("api")} || ',"contents":{{"new":' || CASE WHEN new_status IS NULL THEN 'null' ELSE
         '{{"draftValue":' || CASE WHEN draft_created_at IS NULL THEN 'null' ELSE
              '{{"createdAt":' || {_stamp("draft_created_at")} || '}}' END
         || ',"fields":"' || {_hmac(SECRET)} || '","publishValue":' || CASE WHEN content_published_at IS NULL THEN 'null' ELSE
              '{{"createdAt":' || {_stamp("content_created_at")}
              || ',"publishedAt":' || {_stamp("content_published_at")} || '}}' END
         || ',"status":' || {_status("new_status")} || ',"updatedAt":' || {_stamp("new_updated_at")} || '}}' END
    || ',"old":' || CASE WHEN old_status IS NULL THEN 'null' ELSE
         '{{"status":' || {_status("old_status")} || ',"updatedAt":' || {_stamp("old_updated_at")} || '}}' END
    || '}},"id":' || {_text("content_id")} || ',"service":' || {_text("service")} || ',"type":' || {_text("event_type")}
    || '}}' AS raw_payload
  FROM hidden
)"""
STORED_DAYS = "SELECT service, coalesce(api, 'unknown') AS api, dt, count(*)::BIGINT AS event_count FROM ev GROUP BY ALL"

ORACLES: dict[str, str] = {
    "scan_events": f"""{EVENTS}
SELECT service, coalesce(api, 'unknown') AS api, dt, event_kind, count(*)::BIGINT AS event_count
FROM ev GROUP BY ALL""",
    "scan_events_of_days": f"""{EVENTS}
SELECT dt, coalesce(api, 'unknown') AS api, count(*)::BIGINT AS event_count
FROM ev WHERE {IN_RANGE} GROUP BY ALL""",
    "union_by_name_scan": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY",
    "parquet_roundtrip": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY",
    "partition_layout": f"""{EVENTS}, stored AS ({STORED_DAYS})
SELECT 'service=' || service || '/api=' || api || '/dt=' || strftime(dt, '%Y-%m-%d') AS partition_path,
  event_count FROM stored""",
    "sharded_write": f"""{EVENTS}, stored AS ({STORED_DAYS})
SELECT service, api, dt, event_count, true AS files_are_small FROM stored""",
    "overwrite_write": f"{EVENTS} SELECT dt, count(*)::BIGINT AS event_count FROM ev GROUP BY dt",
    "partition_inventory": f"""{EVENTS}, stored AS ({STORED_DAYS})
SELECT sum(event_count)::BIGINT AS event_count, count(*)::BIGINT AS partition_count,
  min(dt) AS first_day, max(dt) AS last_day, true AS has_files FROM stored""",
    "raw_webhooks": f"""{WEBHOOKS}
SELECT received_at, signature, sha256(body) AS body_sha256, octet_length(body)::BIGINT AS body_bytes FROM wh""",
    "verify_signature": """SELECT event_id,
  CASE WHEN event_id % 29 <> 0 THEN event_id % 19 <> 0 END AS signature_ok FROM events""",
    "reject_classification": f"""SELECT event_id, {REASON} AS reject_reason,
  ({CLASS})::INTEGER AS reject_class FROM events""",
    "normalize_events": f"{BODIES} SELECT {EVENT_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED}",
    "ingest_events": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED}",
    "ingest_quarantine": f"""{WEBHOOKS}
SELECT received_at, CAST(received_at + INTERVAL 9 HOURS AS DATE) AS dt, {REASON} AS reject_reason,
  ({CLASS})::INTEGER AS reject_class, sha256(body) AS body_sha256
FROM wh WHERE NOT ({ACCEPTED})""",
    "stream_ingest": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED}",
    "deduplicated_stream": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED}",
    "idempotent_ingest": f"""{EVENTS}
SELECT dt, CASE WHEN {ACCEPTED} THEN 'events' ELSE 'quarantine' END AS stored_as, count(*)::BIGINT AS record_count
FROM ev GROUP BY ALL""",
    "compacted_events": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED}",
    "compaction_plan": f"""{EVENTS}
SELECT DISTINCT service, coalesce(api, 'unknown') AS api, dt, false AS due, 1::BIGINT AS file_count FROM ev WHERE {ACCEPTED}""",
    "backfilled_days": f"""{BODIES}
SELECT {STORED_COLUMNS} FROM EV_WITH_BODY WHERE {ACCEPTED} AND (event_id % 2 = 0 OR {IN_RANGE})""",
    "expired_partitions": f"""{EVENTS}
SELECT DISTINCT service, coalesce(api, 'unknown') AS api, dt, true AS has_bytes FROM ev WHERE dt < {FIRST}""",
    "masked_payload": f"{_with(EV, MASKED)} SELECT {EVENT_COLUMNS} FROM masked",
    "split_payload": f"{BODIES} SELECT {STORED_COLUMNS} FROM EV_WITH_BODY",
    "allowed_columns": f"""{EVENTS}
SELECT received_at, service, coalesce(api, 'unknown') AS api, content_id, NULL::VARCHAR AS event_type, event_kind,
  NULL::VARCHAR AS old_status, NULL::VARCHAR AS new_status, NULL::TIMESTAMP AS old_updated_at,
  NULL::TIMESTAMP AS new_updated_at, NULL::TIMESTAMP AS draft_created_at, NULL::TIMESTAMP AS content_created_at,
  NULL::TIMESTAMP AS content_published_at, '' AS raw_payload, dt FROM ev""",
    "status_extraction": f"{EVENTS} SELECT event_id, old_status, new_status FROM ev",
    "payload_timestamps": """SELECT event_id,
  CASE WHEN event_id % 9 NOT IN (5, 7) THEN ts END AS updated_at FROM events""",
    "event_kind": f"{EVENTS} SELECT event_id, event_kind FROM ev",
    "jst_partition_day": "SELECT event_id, CAST(ts + INTERVAL 9 HOURS AS DATE) AS dt FROM events",
    "partition_escape": r"""SELECT page_id,
  CASE WHEN page_id % 10 = 0 THEN 'unknown' ELSE regexp_replace(url, '[/=?#\[\] ]', '_', 'g') END
    AS partition_value
FROM pages""",
    "jst_day_bounds": f"""{EVENTS}
SELECT dt, count(*)::BIGINT AS event_count, min(received_at) AS first_received_at,
  max(received_at) AS last_received_at
FROM ev WHERE list_contains(range(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 1 DAY), dt::TIMESTAMP) GROUP BY dt""",
    "calendar_heatmap": _calendar(FIRST, LAST),
    "calendar_heatmap_quiet_days": _calendar(WIDE_FIRST, WIDE_LAST),
    "publish_action_summary": _summary(IN_RANGE),
    "publish_action_summary_empty": _summary("dt = DATE '2025-01-01'"),
    "publish_action_trend": _trend(FIRST, LAST),
    "publish_action_trend_quiet_days": _trend(WIDE_FIRST, WIDE_LAST),
    "api_activity": f"{EVENTS} {_activity()}",
    "top_updated_contents": f"""{EVENTS}
SELECT api, content_id, count, strftime(last_at, '%Y-%m-%dT%H:%M:%SZ') AS last_event_at
FROM ({TOP_CONTENTS})""",
    "avg_time_to_publish_days": _time_to_publish("days"),
    "avg_time_to_publish_hours": _time_to_publish("hours"),
    "avg_draft_to_publish_days": _draft_to_publish("days"),
    "avg_draft_to_publish_hours": _draft_to_publish("hours"),
    "activity_cube": f"""{EVENTS}
SELECT dt, api, event_kind, count(*)::BIGINT AS event_count FROM ev WHERE {IN_RANGE} GROUP BY ALL""",
    "panel_calendar_heatmap": _calendar(FIRST, LAST),
    "panel_publish_action_summary": _summary(IN_RANGE),
    "panel_publish_action_trend": _trend(FIRST, LAST),
    "panel_api_activity": f"{EVENTS} {_activity("coalesce(api, 'unknown')")}",
    "api_activity_by_category": f"""{EVENTS}, activity AS ({_activity()})
SELECT api, {", ".join(f"{total} AS {name}" for name, total in CATEGORY_SUMS.items())} FROM activity""",
    "api_activity_detail_view": f"""{EVENTS}, activity AS ({_activity()})
SELECT api, {", ".join(f"{kind.lower()}_count AS {kind.lower()}" for kind in KINDS)} FROM activity""",
    "operation_category_breakdown": f"""{EVENTS}, activity AS ({_activity()}), slices AS (
  {" UNION ALL ".join(
      f"SELECT '{name}' AS category, sum({total})::BIGINT AS value FROM activity"
      for name, total in CATEGORY_SUMS.items())}
)
SELECT category, value, value::DOUBLE / (SELECT sum(value)::BIGINT FROM slices) AS share FROM slices""",
    "top_updated_view": f"""{EVENTS}
SELECT api, content_id, count AS updated_count, strftime(last_at, '%Y-%m-%dT%H:%M:%SZ') AS last_event_at,
  strftime(last_at + INTERVAL 9 HOURS, '%Y-%m-%d %H:%M:%S') AS last_event_at_jst
FROM ({TOP_CONTENTS})""",
    "duration_view_days": f"SELECT api, avg_days FROM ({_time_to_publish('days')})",
    "duration_view_hours": f"SELECT api, avg_hours FROM ({_draft_to_publish('hours')})",
    "publish_duration_bands": _bands(_time_to_publish("days"), "avg_days", 1.0, 3.0),
    "draft_duration_bands": _bands(_draft_to_publish("hours"), "avg_hours", 24.0, 72.0),
    "metric_json": f"""{EVENTS}, activity AS ({_activity()})
SELECT to_json(activity)::VARCHAR AS json FROM activity""",
    "metric_json_null_unit": f"SELECT to_json(report)::VARCHAR AS json FROM ({_draft_to_publish('days')}) report",
    "metric_json_document": f"""{EVENTS}, top AS ({TOP_CONTENTS}), shown AS (
  SELECT api, content_id, count, strftime(last_at, '%Y-%m-%dT%H:%M:%SZ') AS last_event_at,
    row_number() OVER (ORDER BY count DESC, last_at DESC, api NULLS LAST, content_id) AS place FROM top
)
SELECT '{{"rows":[' || string_agg(
  to_json(struct_pack(api := api, content_id := content_id, count := count, last_event_at := last_event_at))::VARCHAR,
  ',' ORDER BY place) || ']}}' AS json FROM shown""",
}
