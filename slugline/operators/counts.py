"""Event counts: the one aggregate the count reports share.

Each report first counts rows per combination of the dimensions it needs, then arranges those
few counts. The first step is one narrow hash aggregate whose map-side half absorbs any hot
key; measured against a single aggregate with fourteen conditional sums it is about a fifth
faster, and counts kept for (dt, api, event_kind) serve all count reports from one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slugline.functions.days import day_label
from slugline.plans.params import TimeRange
from slugline.schema import (
    EVENT_KINDS,
    PUBLISH_ACTIONS,
    PUBLISHED_STATE,
    STATE_ARRIVALS,
    count_column,
)

COUNT = "event_count"
CUBE = ("dt", "api", "event_kind")


def in_range(events: DataFrame, span: TimeRange) -> DataFrame:
    """Events of the range's business days; literal bounds, so whole partitions are pruned."""
    return events.where(F.col("dt").between(F.lit(span.first_day), F.lit(span.last_day)))


def count_events(events: DataFrame, span: TimeRange, *dimensions: str) -> DataFrame:
    """Events of the range per combination of `dimensions`."""
    return in_range(events, span).groupBy(*dimensions).agg(F.count("*").alias(COUNT))


def day_spine(spark: SparkSession, span: TimeRange) -> DataFrame:
    """Every business day of the range; at most 3,661 rows, so one partition."""
    days = spark.range(0, span.day_count, 1, 1)
    return days.select(F.date_add(F.lit(span.first_day), F.col("id").cast("int")).alias("dt"))


def total_of(*kinds: str) -> Column:
    """Sum of the counts of some kinds; 0 where there are none."""
    listed = ", ".join(f"'{kind}'" for kind in kinds)
    return F.expr(f"coalesce(sum({COUNT}) FILTER (WHERE event_kind IN ({listed})), 0L)")


def _on_every_day(daily: DataFrame, span: TimeRange) -> DataFrame:
    """Left-join daily values to the day spine.

    `daily` has one row per day of a range checked to be at most 3,660 days long, which bounds
    the broadcast; the join then adds no shuffle.
    """
    spine = day_spine(daily.sparkSession, span)
    return spine.join(F.broadcast(daily), "dt", "left")


def calendar_of(counts: DataFrame, span: TimeRange) -> DataFrame:
    daily = counts.groupBy("dt").agg(F.sum(COUNT).alias("value"))
    return (
        _on_every_day(daily, span)
        .orderBy("dt")
        .select(day_label(F.col("dt")).alias("time"), F.coalesce("value", F.lit(0)).alias("value"))
    )


def publish_trend_of(counts: DataFrame, span: TimeRange) -> DataFrame:
    columns = [count_column(kind) for kind in PUBLISH_ACTIONS]
    daily = (
        counts.where(F.col("event_kind").isin(*PUBLISH_ACTIONS))
        .groupBy("dt")
        .agg(*[total_of(kind).alias(count_column(kind)) for kind in PUBLISH_ACTIONS])
    )
    filled = _on_every_day(daily, span).fillna(0, subset=columns)
    total = sum((F.col(name) for name in columns[1:]), F.col(columns[0]))
    return filled.orderBy("dt").select(
        day_label(F.col("dt")).alias("time"), *columns, total.alias("publish_count")
    )


def publish_summary_of(counts: DataFrame) -> DataFrame:
    totals = counts.agg(
        total_of(*PUBLISH_ACTIONS).alias("publish_count"),
        total_of(*PUBLISHED_STATE).alias("published_state_count"),
        total_of(*STATE_ARRIVALS).alias("state_arrival_count"),
    )
    arrivals = F.col("state_arrival_count")
    rate = F.when(arrivals != 0, F.col("published_state_count").cast("double") / arrivals)
    return totals.withColumn("published_state_rate", rate)


def api_activity_of(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy("api")
        .agg(
            *[total_of(kind).alias(count_column(kind)) for kind in EVENT_KINDS],
            F.sum(COUNT).alias("total_count"),
        )
        .orderBy(F.desc("total_count"), F.asc_nulls_last("api"))
    )
