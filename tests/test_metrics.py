"""Reports on small inputs with known answers."""

import json

from builders import at, day, days, events, rows

from slugline.operators import metrics as M
from slugline.operators import views as V
from slugline.operators.export import json_document, json_rows
from slugline.plans.dashboard import activity_cube, content_panels, count_panels
from slugline.plans.params import DurationUnit
from slugline.schema import EVENT_KINDS

DAYS, HOURS = DurationUnit.DAYS, DurationUnit.HOURS
PFD, IP = "PUBLISH_FROM_DRAFT", "INITIAL_PUBLISH"


def kinds_on(spark, *pairs):
    return events(spark, *[{"dt": day(dt), "api": "blogs", "event_kind": kind} for dt, kind in pairs])


def test_calendar(spark):
    table = kinds_on(spark, ("06-30", PFD), ("06-30", None), ("06-28", PFD))
    assert rows(M.calendar_heatmap(table, days("06-29", "07-01"))) == [
        ("2026-06-29T00:00:00+09:00", 0),
        ("2026-06-30T00:00:00+09:00", 2),
        ("2026-07-01T00:00:00+09:00", 0),
    ]


def test_activity_order_and_unknown_kinds(spark):
    table = events(
        spark,
        *[{"dt": day("06-30"), "api": api, "event_kind": kind}
          for api, kind in [("b", PFD), ("a", None), (None, "OTHER"), ("c", IP), ("c", IP)]],
    )
    report = M.api_activity(table, days("06-30", "06-30")).collect()
    assert [(row.api, row.total_count) for row in report] == [("c", 2), ("a", 1), ("b", 1), (None, 1)]
    counted = [sum(row[f"{kind.lower()}_count"] for kind in EVENT_KINDS) for row in report]
    assert counted == [2, 0, 1, 0]


def test_second_boundaries(spark):
    table = events(
        spark,
        {"dt": day("06-30"), "api": "a", "event_kind": IP,
         "content_created_at": at("06-30 00:00:00.9"), "content_published_at": at("06-30 00:00:01.1")},
    )
    assert rows(M.average_time_to_publish(table, days("06-30", "06-30"), HOURS)) == [("a", None, 1 / 3600)]


def test_views(spark):
    table = kinds_on(spark, *[("06-30", kind) for kind in EVENT_KINDS], ("06-30", None))
    activity = M.api_activity(table, days("06-30", "06-30"))
    assert rows(V.activity_view(activity)) == [("blogs", 4, 4, 3, 3)]
    detail = V.activity_view(activity, V.ActivityView.DETAIL)
    assert detail.columns == ["api", *[kind.lower() for kind in EVENT_KINDS]]
    assert rows(V.operation_category_breakdown(activity)) == [
        ("draft_activity", 4, 4 / 14),
        ("publish_activity", 4, 4 / 14),
        ("unpublish_activity", 3, 3 / 14),
        ("delete_activity", 3, 3 / 14),
    ]
    nothing = M.api_activity(table, days("08-01", "08-01"))
    assert [row[1:] for row in rows(V.operation_category_breakdown(nothing))] == [(0, None)] * 4


def test_bands_at_their_limits(spark):
    durations = spark.createDataFrame([("a", 0.99), ("b", 1.0), ("c", 3.0), ("d", None)], "api string, avg_days double")
    assert [row.band for row in V.duration_bands(durations, DAYS).collect()] == ["green", "yellow", "red", None]


def test_json(spark):
    table = kinds_on(spark, ("06-30", PFD))
    summary = json_rows(M.publish_action_summary(table, days("08-01", "08-01"))).first().json
    assert json.loads(summary) == {
        "publish_count": 0,
        "published_state_count": 0,
        "state_arrival_count": 0,
        "published_state_rate": None,
    }
    calendar = json.loads(json_document(M.calendar_heatmap(table, days("06-20", "07-05"))).first().json)
    assert [row["time"] for row in calendar["rows"]] == sorted(row["time"] for row in calendar["rows"])
    assert len(calendar["rows"]) == 16


def test_dashboard_from_one_cube(spark, small):
    from catalogue.queries import MAIN, WIDE
    from catalogue.sample import content_events

    table = content_events(spark, small)
    panels = count_panels(activity_cube(table, WIDE).persist(), MAIN)
    for name in ("calendar_heatmap", "publish_action_summary", "publish_action_trend", "api_activity"):
        assert rows(panels[name]) == rows(getattr(M, name)(table, MAIN)), name
    assert set(content_panels(table, MAIN)) == {
        "top_updated_contents",
        "average_time_to_publish",
        "average_draft_to_publish",
    }


def test_reports_agree_with_each_other(spark, small):
    from catalogue.queries import WIDE
    from catalogue.sample import content_events

    table = content_events(spark, small)
    calendar = sum(row.value for row in M.calendar_heatmap(table, WIDE).collect())
    activity = M.api_activity(table, WIDE).collect()
    trend = sum(row.publish_count for row in M.publish_action_trend(table, WIDE).collect())
    summary = M.publish_action_summary(table, WIDE).first()
    counted = sum(row[f"{kind.lower()}_count"] for row in activity for kind in EVENT_KINDS)
    slices = V.operation_category_breakdown(M.api_activity(table, WIDE)).collect()
    assert calendar == sum(row.total_count for row in activity) == table.count()
    assert trend == summary.publish_count
    assert counted == sum(row.value for row in slices) < calendar
