"""The physical plans: what is read, what is shuffled, what stays out."""

import re
from functools import partial

import pytest
from builders import SECRET, deliveries, signed

from catalogue.queries import MAIN
from catalogue.sample import content_events
from slugline.operators import ingest as I
from slugline.operators import metrics as M
from slugline.operators import sink as S
from slugline.plans.dashboard import activity_cube
from slugline.sources import events as E

REPORTS = {
    "calendar_heatmap": (M.calendar_heatmap, set()),
    "publish_action_summary": (M.publish_action_summary, {"event_kind"}),
    "publish_action_trend": (M.publish_action_trend, {"event_kind"}),
    "api_activity": (M.api_activity, {"event_kind"}),
    "top_updated_contents": (M.top_updated_contents, {"received_at", "content_id", "event_type"}),
    "average_time_to_publish": (
        M.average_time_to_publish,
        {"event_kind", "content_created_at", "content_published_at"},
    ),
    "average_draft_to_publish": (
        partial(M.average_draft_to_publish, sent_contents=0),
        {"content_id", "event_kind", "draft_created_at", "content_published_at"},
    ),
}


@pytest.fixture(scope="module")
def table(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "events")
    S.write_events(content_events(spark, small), root)
    return E.scan_events(spark, root)


def plan_of(frame, mode="formatted"):
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_only_their_columns_and_days(table, name):
    report, columns = REPORTS[name]
    plan = plan_of(report(table, MAIN))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {field.split(":")[0] for field in schema.split(",") if field} == columns
    (pruning,) = re.findall(r"PartitionFilters: (.*)", plan) or [""]
    if name == "average_draft_to_publish":
        assert "dt" not in pruning
    else:
        assert "2024-01-05" in pruning and "2024-01-24" in pruning
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_filters_reach_the_files(table):
    plan = plan_of(M.average_time_to_publish(table, MAIN))
    assert re.search(r"PushedFilters: .*IsNotNull\(content_published_at\).*In\(event_kind", plan)


def test_draft_to_publish_meets_in_one_scan_and_one_shuffle_by_content(table):
    plan = plan_of(M.average_draft_to_publish(table, MAIN, sent_contents=0), "simple")
    assert "Join" not in plan
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(api#\d+, content_id#\d+", plan)) == 1


def test_top_contents_is_a_top_k(table):
    plan = plan_of(M.top_updated_contents(table, MAIN), "simple")
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_every_shuffle_of_events_follows_a_partial_aggregate(table):
    whole = REPORTS["average_draft_to_publish"][0]
    for report in (M.api_activity, M.top_updated_contents, whole, activity_cube):
        lines = plan_of(report(table, MAIN), "simple").splitlines()
        lowest = max(index for index, line in enumerate(lines) if "Exchange" in line)
        assert "HashAggregate" in lines[lowest + 1] and "partial_" in lines[lowest + 1]


def test_only_bounded_sides_are_broadcast(table):
    for name, (report, _) in REPORTS.items():
        plan = plan_of(report(table, MAIN), "simple")
        expected = 1 if name in ("calendar_heatmap", "publish_action_trend") else 0
        assert plan.count("BroadcastExchange") == expected, name


@pytest.mark.parametrize("outcome", [I.accepted_events, I.rejected_deliveries])
def test_ingest_parses_once_without_shuffle_or_python(spark, outcome):
    classified = I.classify_deliveries(deliveries(spark, signed("{}")), SECRET)
    plan = plan_of(outcome(classified), "simple")
    assert plan.count("from_json(VariantType") == 1
    # Two more readings, of the branch for texts that name a field twice, and no other way to read a body.
    assert plan.count("from_json(") == 3 and not re.search(r"get_json_object|json_object_keys|json_tuple|parse_json", plan)
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.index("Filter isn") < plan.index("from_json(VariantType")


def test_generated_ingest_code_stays_compilable(spark):
    classified = I.classify_deliveries(deliveries(spark, signed("{}")), SECRET)
    code = plan_of(classified, "codegen")
    assert max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
