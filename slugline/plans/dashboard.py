"""All panels of the dashboard for one time range."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slugline.operators import counts as C
from slugline.operators import metrics as M
from slugline.operators import views as V
from slugline.plans.params import DurationUnit, TimeRange


def activity_cube(events: DataFrame, span: TimeRange) -> DataFrame:
    """Events per (dt, api, event_kind): what every count panel needs, from one scan."""
    return C.count_events(events, span, *C.CUBE)


def count_panels(cube: DataFrame, span: TimeRange) -> dict[str, DataFrame]:
    """The count panels out of a cube that covers at least the range.

    Persist the cube if several panels are shown, or store one that covers more days.
    """
    cube = C.in_range(cube, span)
    activity = C.api_activity_of(cube)
    return {
        "calendar_heatmap": C.calendar_of(cube, span),
        "publish_action_summary": C.publish_summary_of(cube),
        "publish_action_trend": C.publish_trend_of(cube, span),
        "api_activity": activity,
        "api_activity_by_category": V.activity_view(activity),
        "operation_category_breakdown": V.operation_category_breakdown(activity),
    }


def content_panels(
    events: DataFrame,
    span: TimeRange,
    unit: DurationUnit = DurationUnit.DAYS,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """The panels that look at single contents and so read the event table themselves."""
    to_publish = M.average_time_to_publish(events, span, unit)
    from_draft = M.average_draft_to_publish(events, span, unit)
    return {
        "top_updated_contents": V.top_updated_view(M.top_updated_contents(events, span, limit)),
        "average_time_to_publish": V.duration_bands(to_publish, unit),
        "average_draft_to_publish": V.duration_bands(from_draft, unit),
    }
