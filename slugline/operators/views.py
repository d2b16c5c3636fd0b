"""What a dashboard shows: reports with fields combined, renamed, selected and graded."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame, functions as F

from slugline.functions.days import DAY_OFFSET_SECONDS
from slugline.plans.params import DurationUnit
from slugline.schema import CATEGORIES, EVENT_KINDS, count_column

# Where a mean lead time turns from green to yellow and from yellow to red.
BAND_LIMITS = {DurationUnit.DAYS: (1.0, 3.0), DurationUnit.HOURS: (24.0, 72.0)}


class ActivityView(Enum):
    """Which fields the activity chart shows next to `api`."""

    CATEGORIES = tuple(CATEGORIES)
    DETAIL = tuple(kind.lower() for kind in EVENT_KINDS)


def _sum_of(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def with_activity_fields(activity: DataFrame) -> DataFrame:
    """API activity under its display names: fourteen kinds, four categories, the total."""
    details = [F.col(count_column(kind)).alias(kind.lower()) for kind in EVENT_KINDS]
    categories = [
        _sum_of([F.col(count_column(kind)) for kind in kinds]).alias(name)
        for name, kinds in CATEGORIES.items()
    ]
    return activity.select("api", *details, *categories, "total_count")


def activity_view(activity: DataFrame, view: ActivityView = ActivityView.CATEGORIES) -> DataFrame:
    """API activity with the fields of one view, in display order."""
    return with_activity_fields(activity).select("api", *view.value)


def operation_category_breakdown(activity: DataFrame) -> DataFrame:
    """The four categories over all APIs, and the share of each; NULL shares if nothing happened."""
    totals = activity_view(activity).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in CATEGORIES]
    )
    everything = _sum_of([F.col(name) for name in CATEGORIES])
    slices = F.array(
        *[F.struct(F.lit(name).alias("category"), F.col(name).alias("value")) for name in CATEGORIES]
    )
    share = F.when(F.col("everything") != 0, F.col("value").cast("double") / F.col("everything"))
    return totals.select(everything.alias("everything"), F.inline(slices)).select(
        "category", "value", share.alias("share")
    )


def top_updated_view(top: DataFrame) -> DataFrame:
    """Most updated contents with the count renamed and the time also in dashboard-local form."""
    utc = F.to_timestamp_ntz("last_event_at", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    local = utc + F.make_dt_interval(secs=F.lit(DAY_OFFSET_SECONDS))
    return top.select(
        "api",
        "content_id",
        F.col("count").alias("updated_count"),
        "last_event_at",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("last_event_at_jst"),
    )


def duration_view(durations: DataFrame, unit: DurationUnit) -> DataFrame:
    """A lead-time report with the chosen unit's field only."""
    return durations.select("api", unit.column)


def duration_bands(durations: DataFrame, unit: DurationUnit) -> DataFrame:
    """A lead-time view graded green, yellow or red; no value, no band."""
    low, high = BAND_LIMITS[unit]
    value = F.col(unit.column)
    band = F.when(value < low, "green").when(value < high, "yellow").when(value >= high, "red")
    return duration_view(durations, unit).withColumn("band", band)
