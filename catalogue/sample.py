"""The supplied `events` table turned into content events and into raw webhooks.

`FIXTURES.md` section 5 defines both; only integer arithmetic and text are involved, so that
any SQL engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slugline.functions.days import business_day
from slugline.functions.lifecycle import event_kind
from slugline.functions.signature import hmac_sha256_hex
from slugline.schema import EVENT_COLUMNS

SECRET = b"catalogue-signing-key"
OTHER_SECRET = b"somebody-else"
APIS = ("blogs", "news", "pages", "authors", "papers")

# Every state a content can have on either side of a change, under every type of event: the
# whole decision table, by event_id, the states before slowest and the type fastest.
STATES = (None, "DRAFT", "PUBLISH", "DRAFT,PUBLISH", "CLOSED", "CLOSED,DRAFT")
TYPES = ("delete", "edit", "new")
CHANGES = [(kind, before, after) for before in STATES for after in STATES for kind in TYPES]


def _listed(values) -> str:
    return "array(" + ", ".join("NULL" if value is None else f"'{value}'" for value in values) + ")"


def _transition(part: int) -> str:
    return f"get({_listed(row[part] for row in CHANGES)}, CAST(event_id % {len(CHANGES)} AS INT))"


def _earlier(factor: int, modulus: int) -> str:
    return f"received_at - make_dt_interval(0, 0, 0, event_id * {factor} % {modulus})"


def content_events(
    spark: SparkSession, sf_dir: str, *, with_payload: bool = True, spread: int | None = None
) -> DataFrame:
    """Content events, with `event_id` kept for checks; `raw_payload` is the body of 5.4.

    With `spread`, the supplied rows are dealt by `event_id` to so many tasks first. A row group of the supplied
    file goes to one task, and a file of few would leave the making of all bodies to few tasks.

    Written as SQL text: the sample is set-up for every query, and one expression string costs
    one call into the JVM where a tree of columns costs one per node.
    """
    supplied = spark.read.parquet(f"{sf_dir}/events.parquet")
    if spread is not None:
        supplied = supplied.repartition(spread, "event_id")
    events = (
        supplied.selectExpr(
            "event_id",
            "CAST(ts AS TIMESTAMP) AS received_at",
            "props",
            "concat('svc-', user_id % 3) AS service",
            f"CASE WHEN event_id % 101 <> 0 THEN get({_listed(APIS)}, CAST(user_id % 5 AS INT)) END AS api",
            "CASE WHEN event_id % 13 <> 0 THEN concat('c-', user_id) END AS content_id",
            f"{_transition(0)} AS event_type",
            f"{_transition(1)} AS old_status",
            f"{_transition(2)} AS new_status",
        )
        .withColumn("event_kind", event_kind(F.col("event_type"), F.split("old_status", ","), F.split("new_status", ",")))
        .selectExpr(
            "*",
            "CASE WHEN old_status IS NOT NULL THEN received_at - INTERVAL 1 DAY END AS old_updated_at",
            "CASE WHEN new_status IS NOT NULL THEN received_at END AS new_updated_at",
            "new_status IN ('DRAFT', 'DRAFT,PUBLISH') AS drafted",
            "new_status IN ('PUBLISH', 'DRAFT,PUBLISH') AS published",
        )
        .selectExpr(
            "*",
            f"CASE WHEN drafted THEN {_earlier(7919, 864_000)} END AS draft_created_at",
            f"CASE WHEN published THEN {_earlier(7919, 1_209_600)} END AS content_created_at",
            f"CASE WHEN published THEN {_earlier(104_729, 172_800)} END AS content_published_at",
        )
        .withColumn("dt", business_day(F.col("received_at")))
    )
    payload = _payload_text() if with_payload else "''"
    return events.selectExpr("*", f"{payload} AS raw_payload").select("event_id", *EVENT_COLUMNS)


def _quoted(value: str) -> str:
    """A JSON string, or null."""
    return f"coalesce(concat('\"', {value}, '\"'), 'null')"


def _stamp(instant: str) -> str:
    return _quoted(f"date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")")


def _status(csv: str) -> str:
    """A bare string for even ids with one status, else an array in reverse with a repeat."""
    backwards = f"reverse(split({csv}, ','))"
    return f"""CASE WHEN event_id % 2 = 0 AND NOT contains({csv}, ',') THEN {_quoted(csv)}
        ELSE concat('["', array_join(concat({backwards}, slice({backwards}, 1, 1)), '","'), '"]') END"""


# Keys repeated inside free values are the sender's business.
_INNER_REPEATS = """CASE WHEN event_id % 7 = 0 THEN concat('{"a":1,"a":', props, '}') ELSE props END"""


def _json(fields: dict[str, str]) -> str:
    """A JSON object out of key and value expressions."""
    pairs = ", ',', ".join(f"'\"{key}\":', {value}" for key, value in fields.items())
    return f"concat('{{', {pairs}, '}}')"


def _payload_text() -> str:
    """The JSON body of an event."""
    published = _json(
        {"createdAt": _stamp("content_created_at"), "publishedAt": _stamp("content_published_at")}
    )
    drafted = _json({"createdAt": _stamp("draft_created_at")})
    old = _json({"status": _status("old_status"), "updatedAt": _stamp("old_updated_at")})
    new = _json(
        {
            "status": _status("new_status"),
            "updatedAt": _stamp("new_updated_at"),
            "publishValue": f"CASE WHEN published THEN {published} ELSE 'null' END",
            "draftValue": f"CASE WHEN drafted THEN {drafted} ELSE 'null' END",
            "fields": _INNER_REPEATS,
        }
    )
    contents = _json({"old": f"coalesce({old}, 'null')", "new": f"coalesce({new}, 'null')"})
    return _json(
        {
            "service": _quoted("service"),
            "api": _quoted("api"),
            "id": _quoted("content_id"),
            "type": _quoted("event_type"),
            "contents": contents,
        }
    )


# Planted faults, by divisor of event_id; the first that matches wins.
NO_SIGNATURE, WRONG_KEY, BAD_UTF8, CUT_SHORT, NUMERIC_SERVICE, SERVICE_TWICE = 29, 19, 31, 23, 37, 41


def webhooks(spark: SparkSession, sf_dir: str, *, spread: int | None = None) -> DataFrame:
    """The events as signed webhook deliveries, some of them faulty; `event_id` is kept.

    `spread` is that of `content_events`.
    """
    damaged = f"""CASE
        WHEN event_id % {NO_SIGNATURE} = 0 OR event_id % {WRONG_KEY} = 0 THEN CAST(raw_payload AS BINARY)
        WHEN event_id % {BAD_UTF8} = 0 THEN concat(CAST(raw_payload AS BINARY), X'FF')
        WHEN event_id % {CUT_SHORT} = 0
            THEN CAST(left(raw_payload, length(raw_payload) - 1) AS BINARY)
        WHEN event_id % {NUMERIC_SERVICE} = 0
            THEN CAST(concat('{{"service":5', substr(raw_payload, instr(raw_payload, ',"api":'))) AS BINARY)
        WHEN event_id % {SERVICE_TWICE} = 0
            THEN CAST(concat('{{"service":null,', substr(raw_payload, 2)) AS BINARY)
        ELSE CAST(raw_payload AS BINARY) END"""
    digest = F.when(F.expr(f"event_id % {WRONG_KEY} = 0"), hmac_sha256_hex(F.col("body"), OTHER_SECRET))
    signature = f"""CASE
        WHEN event_id % {NO_SIGNATURE} = 0 THEN NULL
        WHEN event_id % 3 = 0 THEN digest
        WHEN event_id % 3 = 1 THEN base64(unhex(digest))
        ELSE concat('sha256=', digest) END"""
    return (
        content_events(spark, sf_dir, spread=spread)
        .selectExpr("event_id", f"{damaged} AS body", "received_at")
        .withColumn("digest", digest.otherwise(hmac_sha256_hex(F.col("body"), SECRET)))
        .selectExpr("event_id", "body", f"{signature} AS signature", "received_at")
    )
