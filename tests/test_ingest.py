"""Verification, strict parsing and normalisation of single deliveries."""

import base64
import random
from datetime import datetime, timedelta

import pytest
from builders import SECRET, deliveries, payload, side, signed

from slugline.operators import ingest as I
from slugline.sources.webhooks import as_raw_webhooks, header_value

BODY = payload("edit", "CLOSED", ["PUBLISH"], service="shop", api="prices", id="p/9")
RAW, HEX, AT = signed(BODY)
B64 = base64.b64encode(bytes.fromhex(HEX)).decode()


def reasons(spark, *rows, secret=SECRET):
    classified = I.classify_deliveries(deliveries(spark, *rows), secret).orderBy("n")
    return [row.reject_reason for row in classified.select("reject_reason").collect()]


def events_of(spark, *bodies):
    classified = I.classify_deliveries(deliveries(spark, *[signed(body) for body in bodies]), SECRET)
    return classified.orderBy("n").collect()


@pytest.mark.parametrize("value", ["1", "1" * 1500, '"' + "x" * 21_000_000 + '"'], ids=["short", "digits", "long"])
def test_repeated_keys_beside_values_of_any_length(spark, value):
    """What a value's length is decides nothing."""
    rejected = [
        f'{{"contents":{{"new":{{"n":{value}}},"new":null}}}}',
        f'{{"service":"a","x":{value},"service":"b"}}',
        f'{{"service":"a","x":{value},"\\u0073ervice":"b"}}',
        f'{{"contents":{{"\\u006fld":null,"x":{value},"old":null}}}}',
    ]
    kept = [
        f'{{"x":{value},"extra":1,"extra":2}}',
        f'{{"id":"i","contents":{{"new":{{"id":{value},"id":2}},"x":{{"old":1,"old":2}}}}}}',
        f'{{"service":"service","api":"service","x":{value},"y":{{"service":1,"service":2}}}}',
        f'{{"service":"\\u0073","x":{value}}}',
    ]
    found = reasons(spark, *[signed(body) for body in rejected + kept])
    assert found == [I.PARSE_ERROR] * len(rejected) + [None] * len(kept)


def test_signature_encodings(spark):
    headers = [HEX, HEX.upper(), B64, f"sha256={HEX}", f"SHA256={HEX}", f" \tsha256={B64} "]
    assert reasons(spark, *[(RAW, header, AT) for header in headers]) == [None] * len(headers)


def test_signatures_turned_away(spark):
    headers = [
        "",
        "sha256=",
        f"Sha256={HEX}",
        f"sha256=sha256={HEX}",
        HEX[:-2],
        HEX + "00",
        B64.rstrip("="),
        signed(BODY, b"wrong")[1],
        HEX[:10] + " " + HEX[10:],
    ]
    assert reasons(spark, *[(RAW, header, AT) for header in headers]) == [I.INVALID_SIGNATURE] * len(headers)


def test_no_readable_header_is_a_missing_one(spark):
    assert reasons(spark, (RAW, None, AT), (RAW, HEX + "é", AT), (RAW, HEX + "\n", AT)) == [
        I.MISSING_SIGNATURE
    ] * 3


@pytest.mark.parametrize("secret", [b"", b"k" * 64, b"k" * 65, b"k" * 200, bytes(range(256))])
def test_secrets_of_any_length(spark, secret):
    raw, digest, received = signed(BODY, secret)
    assert reasons(spark, (raw, digest, received), (RAW, HEX, AT), secret=secret) == [
        None,
        I.INVALID_SIGNATURE,
    ]


def test_precedence_of_reasons(spark):
    broken, digest, received = signed(b"\xff{")
    assert reasons(spark, (broken, None, received), (broken, HEX, received), (broken, digest, received)) == [
        I.MISSING_SIGNATURE,
        I.INVALID_SIGNATURE,
        I.INVALID_BODY,
    ]


@pytest.mark.parametrize(
    "body",
    [
        "",
        "   ",
        "null",
        "5",
        '"text"',
        '["s","a","i","edit",null]',
        "{",
        '{"service":"s"} x',
        '{"service":"s"}{"service":"t"}',
        '{"service":"s"},{"service":"t"}',
        '{"service":"s"}],[{"service":"t"}',
        '{"service":"s"}},{"w":1}',
        '{"service":"s",}',
        "{'service':'s'}",
        '{"service":5}',
        '{"api":true}',
        '{"id":["x"]}',
        '{"type":{"a":1}}',
        '{"contents":"x"}',
        '{"contents":[1]}',
        '{"contents":5}',
        '{"service":"s","service":"t"}',
        '{"contents":{"new":{"status":"DRAFT"},"new":null}}',
        '{"x":1,"type":"new","y":{"type":"edit"},"type":"new"}',
        "﻿{}",
        '{"a":NaN}',
    ],
)
def test_bodies_that_do_not_parse(spark, body):
    assert reasons(spark, signed(body)) == [I.PARSE_ERROR]


@pytest.mark.parametrize(
    "body",
    [
        "{}",
        ' {"service":"s"}\n',
        '{"service":null,"api":null,"id":null,"type":null,"contents":null}',
        '{"contents":{}}',
        '{"contents":{"old":5,"new":"x"}}',
        '{"contents":{"old":[{"status":"DRAFT"}]}}',
        '{"extra":{"deep":[1,2,{"x":null}]}}',
        '{"service":"},{"}',
        '{"extra":1,"extra":2}',
        '{"contents":{"new":{"free":{"a":1,"a":[2]},"free":3}}}',
        '{"x":{"service":"a","service":"b"}}',
    ],
)
def test_bodies_that_parse(spark, body):
    (event,) = events_of(spark, body)
    assert event.reject_reason is None
    assert event.raw_payload == body
    assert event.event_kind is None and event.old_status is None and event.new_status is None


def test_every_field_of_an_event(spark):
    """Random instants in every field that has one; what comes out is what went in."""
    source = random.Random(11)
    fields = ("old_updated_at", "new_updated_at", "draft_created_at", "content_created_at", "content_published_at")
    for _ in range(3):
        instant = {name: datetime(2020, 1, 1) + timedelta(seconds=source.randrange(10**8)) for name in fields}
        text = {name: value.isoformat() + "Z" for name, value in instant.items()}
        after = side(
            ["PUBLISH", "DRAFT"],
            updated_at=text["new_updated_at"],
            draftValue={"createdAt": text["draft_created_at"]},
            publishValue={"createdAt": text["content_created_at"], "publishedAt": text["content_published_at"]},
        )
        before = side("PUBLISH", updatedAt=text["old_updated_at"])
        names = {key: f"{key} {source.random()}" for key in ("service", "api", "id")}
        (event,) = events_of(spark, payload("edit", before, after, **names))
        assert {name: getattr(event, name) for name in fields} == instant
        assert (event.service, event.api, event.content_id) == tuple(names.values())
        assert (event.event_kind, event.old_status, event.new_status) == (
            "ADD_DRAFT_TO_PUBLISHED",
            "PUBLISH",
            "DRAFT,PUBLISH",
        )
        assert (event.received_at, event.dt) == (AT, (AT + timedelta(hours=9)).date())


def test_sides_that_are_not_there(spark):
    (gone, fresh) = events_of(spark, payload("delete", "CLOSED"), payload("new", None, ["DRAFT"]))
    assert (gone.event_kind, gone.new_status, gone.new_updated_at) == ("DELETE_CLOSED", None, None)
    assert (fresh.event_kind, fresh.old_status, fresh.draft_created_at) == ("INITIAL_DRAFT", None, None)


def test_statuses(spark):
    values = [["PUBLISH", 7, "DRAFT", "PUBLISH", None], [], 7, None, {"a": "DRAFT"}, "", ["é", "Z", "a"]]
    events = events_of(spark, *[payload("edit", "DRAFT", {"status": value}) for value in values])
    assert [event.new_status for event in events] == ["DRAFT,PUBLISH", None, None, None, None, "", "Z,a,é"]


TIMES = [
    ("2026-06-29T12:00:00Z", datetime(2026, 6, 29, 12)),
    ("2026-06-29t12:00:00z", datetime(2026, 6, 29, 12)),
    ("2026-06-29 12:00:00+00:00", datetime(2026, 6, 29, 12)),
    ("2026-06-29T12:00:00.5+09:00", datetime(2026, 6, 29, 3, 0, 0, 500000)),
    ("2026-06-29T12:00:00−09:30", datetime(2026, 6, 29, 21, 30)),
    ("2026-06-29T12:00:00+23:59", datetime(2026, 6, 28, 12, 1)),
    ("2026-06-29T12:00:00.123456789012Z", datetime(2026, 6, 29, 12, 0, 0, 123456)),
    ("2026-06-29T23:59:60Z", datetime(2026, 6, 30)),
    ("2026-06-29T23:59:60.25+09:00", datetime(2026, 6, 29, 15, 0, 0, 250000)),
    ("2026-06-29", None),
    ("2026-06-29T12:00:00", None),
    ("2026-06-29T12:00Z", None),
    ("2026-06-29T12:00:00.Z", None),
    ("2026-06-29T12:00:00+0900", None),
    ("2026-06-29T12:00:00+24:00", None),
    ("2026-06-29T12:00:00+09:60", None),
    ("2026-06-29T24:00:00Z", None),
    ("2026-06-29T12:00:61Z", None),
    ("2026-02-30T12:00:00Z", None),
    ("2026-13-01T12:00:00+09:00", None),
    (" 2026-06-29T12:00:00Z", None),
    ("2026-06-29T12:00:00Z\\n", None),
    ("", None),
]


def test_timestamps(spark):
    bodies = [f'{{"contents":{{"new":{{"updatedAt":"{text}"}}}}}}' for text, _ in TIMES]
    assert [event.new_updated_at for event in events_of(spark, *bodies)] == [value for _, value in TIMES]


def test_second_spelling_of_the_update_time(spark):
    good = '"2026-06-29T12:00:00Z"'
    cases = [f'"updated_at":{good}', f'"updatedAt":5,"updated_at":{good}', f'"updatedAt":"?","updated_at":{good}']
    events = events_of(spark, *[f'{{"contents":{{"old":{{{case}}}}}}}' for case in cases])
    expected = datetime(2026, 6, 29, 12)
    assert [event.old_updated_at for event in events] == [expected, expected, None]


def test_rejected_deliveries_are_kept_as_they_came(spark):
    classified = I.classify_deliveries(deliveries(spark, (RAW, "no", AT), signed("{"), (RAW, HEX, AT)), SECRET)
    kept = I.rejected_deliveries(classified).orderBy("reject_class").collect()
    assert [(bytes(row.body), row.reject_class) for row in kept] == [(b"{", 400), (RAW, 401)]
    assert I.accepted_events(classified).count() == 1


def test_header_lookup_and_body_kinds(spark):
    landed = spark.createDataFrame(
        [("{}", {"X-SIGN": "a"}), (None, {"x-sign": "b"}), ("é", {"other": "c"})],
        "body string, headers map<string,string>",
    )
    raw = as_raw_webhooks(landed, signature_header="x-Sign").collect()
    assert [(bytes(row.body), row.signature) for row in raw] == [(b"{}", "a"), (b"", "b"), ("é".encode(), None)]
    assert all(row.received_at is not None for row in raw)
    named = landed.select(header_value(landed.headers, "OTHER").alias("value")).collect()
    assert [row.value for row in named] == [None, None, "c"]


def test_long_bodies_are_read_whole(spark):
    """The statuses stand after eight megabytes of text."""
    text = "x\\n\u00e9" * 2_000_000
    body = f'{{"type":"new","api":"a","contents":{{"new":{{"html":"{text}","status":"DRAFT"}}}}}}'
    (event,) = events_of(spark, body)
    assert (event.reject_reason, event.event_kind) == (None, "INITIAL_DRAFT")
    assert len(event.raw_payload) == len(body)


def test_no_limit_on_a_text_or_a_number(spark):
    long_text, long_number = "x" * 25_000_000, "0." + "123" * 500
    body = f'{{"type":"new","contents":{{"new":{{"html":"{long_text}","n":{long_number},"status":"DRAFT"}}}}}}'
    (event,) = events_of(spark, body)
    assert (event.reject_reason, event.event_kind) == (None, "INITIAL_DRAFT")


def test_the_secret_is_not_shown(spark):
    secret = b"a secret of some length"
    frame = I.classify_deliveries(deliveries(spark, (RAW, HEX, AT)), secret)
    for text in (frame._jdf.queryExecution().toString(), frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "extended")):
        for pad in (0x36, 0x5C):
            assert bytes(b ^ pad for b in secret.ljust(64, b"\0")).hex().lower() not in text.lower()
