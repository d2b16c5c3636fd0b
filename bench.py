"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the supplied tables, BENCH_CPUS the number of local threads.
Each query runs once to warm up, then BENCH_RUNS times; its value is the median. Every row of a
result is computed and dropped, so the driver is not part of the measurement. Reports read the
stored, partitioned event table; `ingest_events` verifies, parses and writes all deliveries to a new table.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from catalogue import sample
from catalogue.queries import MAIN, QUERIES, TOP, event_table, landed_batch
from slugline.operators import metrics as M
from slugline.operators import views as V
from slugline.plans.ingest import ingest_batch
from slugline.plans.params import DurationUnit
from slugline.session import build_session, scratch_path
from slugline.sources.events import scan_events

REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "calendar_heatmap": lambda events: M.calendar_heatmap(events, MAIN),
    "publish_action_summary": lambda events: M.publish_action_summary(events, MAIN),
    "publish_action_trend": lambda events: M.publish_action_trend(events, MAIN),
    "api_activity": lambda events: M.api_activity(events, MAIN),
    "top_updated_contents": lambda events: M.top_updated_contents(events, MAIN, limit=TOP),
    "avg_time_to_publish_days": lambda events: M.average_time_to_publish(events, MAIN, DurationUnit.DAYS),
    "avg_draft_to_publish_days": lambda events: M.average_draft_to_publish(events, MAIN, DurationUnit.DAYS),
    "operation_category_breakdown": lambda events: V.operation_category_breakdown(M.api_activity(events, MAIN)),
}
BY_NAME = ("scan_events", "panel_api_activity", "verify_signature", "reject_classification", "normalize_events")


def dropped(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def headline(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], None]]:
    """What is timed, by name; tables that are read are written beforehand."""
    table, landed = event_table(spark, sf_dir), landed_batch(spark, sf_dir)

    def report(of: Callable[[DataFrame], DataFrame]) -> Callable[[], None]:
        return lambda: dropped(of(scan_events(spark, table)))

    def named(name: str) -> Callable[[], None]:
        return lambda: dropped(QUERIES[name](spark, sf_dir))

    timed = {name: report(of) for name, of in REPORTS.items()} | {name: named(name) for name in BY_NAME}
    return timed | {"ingest_events": lambda: ingest_batch(landed, sample.SECRET, scratch_path(spark, "bench"))}


def seconds_of(run: Callable[[], None]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in headline(spark, sf_dir).items():
        seconds_of(run)
        seconds[name] = round(statistics.median(seconds_of(run) for _ in range(runs)), 3)
    spark.stop()
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
