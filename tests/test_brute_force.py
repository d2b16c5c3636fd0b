"""Column expressions against plain Python, over whole input spaces or many random inputs."""

import base64
import hashlib
import hmac
import random
from datetime import datetime, timedelta, timezone
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from slugline.functions.days import business_day, day_label, seconds_between
from slugline.functions.lifecycle import event_kind
from slugline.functions.signature import hmac_sha256_hex, signature_matches
from slugline.functions.timestamps import rfc3339_timestamp

STATUSES = ("ARCHIVED", "CLOSED", "DRAFT", "PUBLISH")
SETS = [list(chosen) for size in range(5) for chosen in combinations(STATUSES, size)]


def meaning(statuses):
    if "PUBLISH" in statuses:
        return "published"
    return {("DRAFT",): "draft", ("CLOSED",): "closed"}.get(tuple(statuses))


def expected_kind(event_type, old, new):
    before, after = meaning(old), meaning(new)
    if event_type == "new":
        kinds = {"draft": "INITIAL_DRAFT", "published": "INITIAL_PUBLISH"}
        return kinds.get(after) if before is None else None
    if event_type == "delete":
        kinds = {"draft": "DELETE_DRAFT", "published": "DELETE_PUBLISHED", "closed": "DELETE_CLOSED"}
        return kinds.get(before) if after is None else None
    if event_type != "edit":
        return None
    if before == after == "published":
        had, has = "DRAFT" in old, "DRAFT" in new
        if had == has:
            return "UPDATE_PUBLISHED"
        return "DISCARD_DRAFT_ON_PUBLISHED" if had else "ADD_DRAFT_TO_PUBLISHED"
    return {
        ("draft", "draft"): "SAVE_DRAFT",
        ("draft", "published"): "PUBLISH_FROM_DRAFT",
        ("published", "draft"): "UNPUBLISH_TO_DRAFT",
        ("published", "closed"): "UNPUBLISH_TO_CLOSED",
        ("closed", "draft"): "REOPEN_TO_DRAFT",
        ("closed", "published"): "REPUBLISH_FROM_CLOSED",
    }.get((before, after))


def test_every_combination_of_statuses(spark):
    cases = list(product(("new", "edit", "delete", "other", None), SETS, SETS))
    frame = spark.createDataFrame(
        [(n, *case) for n, case in enumerate(cases)], "n int, t string, old array<string>, new array<string>"
    )
    kinds = frame.select("n", event_kind(F.col("t"), F.col("old"), F.col("new")).alias("kind"))
    found = {row.n: row.kind for row in kinds.collect()}
    assert [found[n] for n in range(len(cases))] == [expected_kind(*case) for case in cases]
    assert len(set(found.values())) == 15


@pytest.mark.parametrize("length", [0, 1, 32, 63, 64, 65, 131])
def test_hmac_of_random_bodies(spark, length):
    source = random.Random(length)
    secret = source.randbytes(length)
    bodies = [source.randbytes(source.randrange(300)) for _ in range(100)]
    frame = spark.createDataFrame([(n, body) for n, body in enumerate(bodies)], "n int, body binary")
    found = frame.select("n", hmac_sha256_hex(F.col("body"), secret).alias("hex")).orderBy("n").collect()
    assert [row.hex for row in found] == [hmac.new(secret, body, hashlib.sha256).hexdigest() for body in bodies]


def test_signature_forms(spark):
    source = random.Random(7)
    cases = []
    for _ in range(60):
        digest, other = source.randbytes(32), source.randbytes(32)
        texts = [digest.hex(), digest.hex().upper(), base64.b64encode(digest).decode()]
        wrong = [other.hex(), base64.b64encode(other).decode(), digest.hex()[:-1], base64.urlsafe_b64encode(other).decode()]
        for good, text in [(True, t) for t in texts] + [(False, t) for t in wrong]:
            cases += [(digest.hex(), prefix + text, good) for prefix in ("", "sha256=", "SHA256=", "\t ")]
    frame = spark.createDataFrame(cases, "digest string, header string, good boolean")
    matches = signature_matches(F.col("digest"), F.col("header"))
    assert frame.where(matches != F.col("good")).count() == 0


def test_random_timestamps_with_offsets(spark):
    source = random.Random(3)
    cases = []
    for n in range(500):
        instant = datetime(1950, 1, 1, tzinfo=timezone.utc) + timedelta(
            microseconds=source.randrange(150 * 365 * 86_400_000_000)
        )
        zone = timezone(timedelta(minutes=source.randrange(-1439, 1440)))
        cases.append((n, instant.astimezone(zone).isoformat(timespec="microseconds"), instant.replace(tzinfo=None)))
    frame = spark.createDataFrame([case[:2] for case in cases], "n int, text string")
    found = frame.select("n", rfc3339_timestamp(F.col("text")).alias("at")).orderBy("n").collect()
    assert [row.at for row in found] == [case[2] for case in cases]


def test_days_around_midnight_in_any_session_zone(spark):
    instants = ["2026-06-29 14:59:59.999999", "2026-06-29 15:00:00", "1969-12-31 14:59:59.5", "1969-12-31 15:00:00"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame = spark.createDataFrame([(text,) for text in instants], "text string")
        at = F.concat("text", F.lit("Z")).cast("timestamp")
        labels = frame.select(day_label(business_day(at)).alias("label")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    suffix = "T00:00:00+09:00"
    expected = ["2026-06-29", "2026-06-30", "1969-12-31", "1970-01-01"]
    assert [row.label for row in labels] == [day + suffix for day in expected]


def test_second_boundaries_across_1970(spark):
    frame = spark.createDataFrame(
        [("1969-12-31 23:59:59.9", "1970-01-01 00:00:00.1"), ("2026-06-30 00:00:00.1", "2026-06-30 00:00:00.9")],
        "a string, b string",
    )
    between = seconds_between(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    assert [row.s for row in frame.select(between.alias("s")).collect()] == [1, 0]
