"""The reports against a plain model over random events, under several session zones."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from builders import events, rows

from slugline.operators import metrics as M
from slugline.operators import views as V
from slugline.plans.params import DurationUnit, InvalidParameter, TimeRange
from slugline.schema import EVENT_KINDS, PUBLISH_ACTIONS, PUBLISHED_STATE, STATE_ARRIVALS

FIRST, LAST = date(2023, 3, 9), date(2023, 3, 14)
SPAN = TimeRange.of_days(FIRST, LAST)
DAY_SECONDS = {DurationUnit.DAYS: 86_400, DurationUnit.HOURS: 3_600}


def random_events(seed: int, n: int) -> list[dict]:
    source = random.Random(seed)

    def instant(spread: int) -> datetime | None:
        if source.random() < 0.1:
            return None
        return datetime(2023, 3, 12) + timedelta(microseconds=source.randrange(-spread, spread) * 1_000_003)

    return [
        {
            "received_at": datetime(2023, 3, 12) + timedelta(milliseconds=source.randrange(-(10**9), 10**9)),
            "dt": FIRST + timedelta(days=source.randrange(-3, 9)),
            "api": source.choice(["x", "y", "Z", None]),
            "content_id": source.choice([None, *map(str, range(9))]),
            "event_type": source.choice(["new", "edit", "delete", None]),
            "event_kind": source.choice([*EVENT_KINDS, PUBLISH_ACTIONS[0], "INITIAL_DRAFT", "STRANGE", None]),
            "draft_created_at": instant(300_000),
            "content_created_at": instant(300_000),
            "content_published_at": instant(400_000),
        }
        for _ in range(n)
    ]


def inside(table):
    return [e for e in table if FIRST <= e["dt"] <= LAST]


def whole_seconds(earlier: datetime, later: datetime) -> int:
    return int((later.replace(microsecond=0) - earlier.replace(microsecond=0)).total_seconds())


def means(samples: dict, unit: DurationUnit) -> dict:
    return {api: sum(s) / (len(s) * DAY_SECONDS[unit]) for api, s in samples.items()}


def leads(table):
    told = defaultdict(list)
    for e in inside(table):
        a, b = e["content_created_at"], e["content_published_at"]
        if e["event_kind"] in PUBLISH_ACTIONS and a and b and b >= a:
            told[e["api"]].append(whole_seconds(a, b))
    return told


def draft_leads(table):
    drafts, publications = defaultdict(list), defaultdict(list)
    for e in table:
        key = (e["api"], e["content_id"])
        if None in key:
            continue
        if e["event_kind"] == "INITIAL_DRAFT" and e["draft_created_at"]:
            drafts[key].append(e["draft_created_at"])
        if e["event_kind"] == "PUBLISH_FROM_DRAFT" and e["content_published_at"] and FIRST <= e["dt"] <= LAST:
            publications[key].append(e["content_published_at"])
    told = defaultdict(list)
    for key in drafts.keys() & publications.keys():
        a, b = min(drafts[key]), min(publications[key])
        if b >= a:
            told[key[0]].append(whole_seconds(a, b))
    return told


def top(table):
    changed = defaultdict(list)
    for e in inside(table):
        if e["event_type"] in ("new", "edit") and e["content_id"] is not None:
            changed[e["api"], e["content_id"]].append(e["received_at"])
    order = sorted(changed, key=lambda k: (-len(changed[k]), -max(changed[k]).timestamp(), k[0] is None, k[0] or "", k[1]))
    return [(*k, len(changed[k]), max(changed[k]).strftime("%Y-%m-%dT%H:%M:%SZ")) for k in order]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_reports_in_any_session_zone(spark, zone):
    data = random_events(5, 700)
    table = events(spark, *data)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        kinds = Counter(e["event_kind"] for e in inside(data))
        counts = [sum(kinds[k] for k in group) for group in (PUBLISH_ACTIONS, PUBLISHED_STATE, STATE_ARRIVALS)]
        assert rows(M.publish_action_summary(table, SPAN)) == [(*counts, counts[1] / counts[2])]
        days = [FIRST + timedelta(days=k) for k in range((LAST - FIRST).days + 1)]
        by_day = Counter((e["dt"], e["event_kind"]) for e in inside(data))
        want = [(f"{d}T00:00:00+09:00", *(p := [by_day[d, k] for k in PUBLISH_ACTIONS]), sum(p)) for d in days]
        assert rows(M.publish_action_trend(table, SPAN)) == want
        assert sum(r.value for r in M.calendar_heatmap(table, SPAN).collect()) == len(inside(data))
        best = M.top_updated_contents(table, SPAN, limit=12)
        assert rows(best) == top(data)[:12]
        shown = V.top_updated_view(best).collect()
        local = [datetime.fromisoformat(r.last_event_at[:-1]) + timedelta(hours=9) for r in shown]
        assert [r.last_event_at_jst for r in shown] == [str(x) for x in local]
        for unit in DurationUnit:
            found = {r.api: r[unit.column] for r in M.average_time_to_publish(table, SPAN, unit).collect()}
            assert found == means(leads(data), unit)
            report = M.average_draft_to_publish(table, SPAN, unit).collect()
            assert {r.api: r[unit.column] for r in report} == means(draft_leads(data), unit)
            assert {r.api: r.sample_count for r in report} == {a: len(s) for a, s in draft_leads(data).items()}
            values = [r[unit.column] for r in report]
            assert values == sorted(values, reverse=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_no_arrivals_no_rate(spark):
    quiet = [e | {"event_kind": "DELETE_DRAFT"} for e in random_events(6, 20)]
    assert rows(M.publish_action_summary(events(spark, *quiet), SPAN)) == [(0, 0, 0, None)]
    with pytest.raises(InvalidParameter):
        M.top_updated_contents(events(spark, *quiet), SPAN, limit=1001)
