"""Small inputs for tests."""

from __future__ import annotations

import hashlib
import hmac
import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from slugline.plans.params import TimeRange
from slugline.schema import EVENT_SCHEMA

SECRET = b"secret"


def day(text: str) -> date:
    return date.fromisoformat(f"2026-{text}")


def at(text: str) -> datetime:
    """`06-30 12:00` or `06-30 12:00:01.5` of 2026, UTC."""
    month_day, clock = text.split()
    return datetime.fromisoformat(f"2026-{month_day}T{clock}")


def days(first: str, last: str) -> TimeRange:
    return TimeRange.of_days(day(first), day(last))


def events(spark: SparkSession, *rows: dict) -> DataFrame:
    """Events from partial rows; what a row does not name is NULL, or a filler where required."""
    filler = {"received_at": datetime(2026, 6, 30), "raw_payload": "{}"}
    full = [tuple({**filler, **row}.get(name) for name in EVENT_SCHEMA.names) for row in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


def signed(body: bytes | str, secret: bytes = SECRET) -> tuple[bytes, str, datetime]:
    raw = body.encode() if isinstance(body, str) else body
    return raw, hmac.new(secret, raw, hashlib.sha256).hexdigest(), datetime(2026, 6, 29, 1, 2, 3)


def deliveries(spark: SparkSession, *rows: tuple) -> DataFrame:
    numbered = [(index, *row) for index, row in enumerate(rows)]
    return spark.createDataFrame(
        numbered, "n int, body binary, signature string, received_at timestamp"
    )


def side(status, **fields) -> dict | None:
    """One side of a change; no status, no side."""
    return None if status is None else {"status": status, **fields}


def payload(kind: str, before=None, after=None, **envelope) -> str:
    """A body around two sides, each None, a status value or a whole side."""
    sides = [value if isinstance(value, dict) else side(value) for value in (before, after)]
    body = {"type": kind, "contents": dict(zip(("old", "new"), sides, strict=True)), **envelope}
    return json.dumps(body, ensure_ascii=False)


def rows(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]
