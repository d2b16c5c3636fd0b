"""The seven reports over the event table, each a function of events and a time range.

Only the columns a report names are read, and only partitions inside the range, except that
`average_draft_to_publish` needs initial drafts of any age.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slugline.functions.days import seconds_between, utc_text
from slugline.operators import counts as C
from slugline.plans.params import DurationUnit, TimeRange, checked_limit
from slugline.schema import EDIT, NEW, PUBLISH_ACTIONS, STATE_ARRIVALS


def calendar_heatmap(events: DataFrame, span: TimeRange) -> DataFrame:
    """Events per business day, quiet days included."""
    return C.calendar_of(C.count_events(events, span, "dt"), span)


def publish_action_summary(events: DataFrame, span: TimeRange) -> DataFrame:
    """One row: publish actions, arrivals in the published state, all arrivals, and their ratio."""
    arrivals = events.where(F.col("event_kind").isin(*STATE_ARRIVALS))
    return C.publish_summary_of(C.count_events(arrivals, span, "event_kind"))


def publish_action_trend(events: DataFrame, span: TimeRange) -> DataFrame:
    """Publish actions per business day and kind, quiet days included."""
    actions = events.where(F.col("event_kind").isin(*PUBLISH_ACTIONS))
    return C.publish_trend_of(C.count_events(actions, span, "dt", "event_kind"), span)


def api_activity(events: DataFrame, span: TimeRange) -> DataFrame:
    """Events per API and kind, with a total that includes events of no kind."""
    return C.api_activity_of(C.count_events(events, span, "api", "event_kind"))


def top_updated_contents(events: DataFrame, span: TimeRange, limit: int | None = None) -> DataFrame:
    """The contents created or edited most often, most recent first among equals.

    The cut is a top-k per task that is merged at the end, not a sort of all contents. Equal
    counts and times are ordered by api and content_id so that the cut is repeatable.
    """
    changes = C.in_range(events, span).where(
        F.col("event_type").isin(NEW, EDIT) & F.col("content_id").isNotNull()
    )
    return (
        changes.groupBy("api", "content_id")
        .agg(F.count("*").alias("count"), F.max("received_at").alias("last_at"))
        .orderBy(
            F.desc("count"),
            F.desc_nulls_last("last_at"),
            F.asc_nulls_last("api"),
            F.asc("content_id"),
        )
        .limit(checked_limit(limit))
        .select("api", "content_id", "count", utc_text(F.col("last_at")).alias("last_event_at"))
    )


def _average(total_seconds: Column, samples: Column, unit: DurationUnit) -> Column:
    """Exact integer sum over a count: the mean does not depend on the order of summation."""
    return total_seconds.cast("double") / (samples * F.lit(unit.seconds))


def _unit_columns(unit: DurationUnit, average: Column) -> list[Column]:
    """Both unit columns, the one not asked for being NULL."""
    return [
        (average if other is unit else F.lit(None).cast("double")).alias(other.column)
        for other in DurationUnit
    ]


def _longest_first(report: DataFrame, unit: DurationUnit) -> DataFrame:
    return report.orderBy(F.desc_nulls_last(unit.column), F.asc_nulls_last("api"))


def average_time_to_publish(
    events: DataFrame, span: TimeRange, unit: DurationUnit = DurationUnit.DAYS
) -> DataFrame:
    """Mean time from creation to publication per API, over publish actions in the range."""
    created, published = F.col("content_created_at"), F.col("content_published_at")
    published_later = C.in_range(events, span).where(
        F.col("event_kind").isin(*PUBLISH_ACTIONS) & (published >= created)
    )
    sums = published_later.groupBy("api").agg(
        F.sum(seconds_between(created, published)).alias("seconds"), F.count("*").alias("samples")
    )
    average = _average(F.col("seconds"), F.col("samples"), unit)
    return _longest_first(sums.select("api", *_unit_columns(unit, average)), unit)


# Contents published in a range whose keys may be sent to every task: at most some 30 MB.
SENT_CONTENTS = 200_000


def average_draft_to_publish(
    events: DataFrame, span: TimeRange, unit: DurationUnit = DurationUnit.DAYS, sent_contents: int = SENT_CONTENTS
) -> DataFrame:
    """Mean time from a content's first draft, of any date, to its first publication in the range.

    Drafts and publications meet on (api, content_id). The publications of the range are counted
    first, which reads the range's days alone. While their contents are at most `sent_contents`, the drafts of
    all history are filtered by them in the scan's own tasks, so that a report on a day
    shuffles what that day published and not every content ever drafted. Beyond that both sides
    are minima over the same key in one scan and one shuffle.
    """
    keys = ("api", "content_id")
    named = events.where(F.col("api").isNotNull() & F.col("content_id").isNotNull())
    is_draft = (F.col("event_kind") == "INITIAL_DRAFT") & F.col("draft_created_at").isNotNull()
    is_publication = (F.col("event_kind") == "PUBLISH_FROM_DRAFT") & F.col("content_published_at").isNotNull()
    published = C.in_range(named, span).where(is_publication)
    first_published = published.groupBy(*keys).agg(F.min("content_published_at").alias("published_at"))
    draft_at = F.min(F.when(is_draft, F.col("draft_created_at"))).alias("draft_at")
    if first_published.limit(sent_contents + 1).count() <= sent_contents:
        drafts = named.where(is_draft).join(F.broadcast(first_published.select(*keys)), [*keys], "left_semi")
        contents = drafts.groupBy(*keys).agg(draft_at).join(first_published, [*keys])
    else:
        in_span = F.col("dt").between(F.lit(span.first_day), F.lit(span.last_day))
        published_at = F.min(F.when(is_publication & in_span, F.col("content_published_at"))).alias("published_at")
        contents = named.where(is_draft | (is_publication & in_span)).groupBy(*keys).agg(draft_at, published_at)
    sums = contents.where(F.col("published_at") >= F.col("draft_at")).groupBy("api").agg(
        F.sum(seconds_between(F.col("draft_at"), F.col("published_at"))).alias("seconds"),
        F.count("*").alias("sample_count"),
    )
    average = _average(F.col("seconds"), F.col("sample_count"), unit)
    return _longest_first(sums.select("api", *_unit_columns(unit, average), "sample_count"), unit)
