"""Connected components of a link table, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slugline.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in `links` (a, b).

    Each round takes the smallest label among an id's neighbours and then the label of that
    label, so chains shorten by more than half. A round is one written table: nothing of the
    graph reaches the driver but whether a label changed. Minima are aggregated before the
    shuffle, so a hub is no hot key. Null ends are ignored; an empty table gives an empty one.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = written(ends.union(ends.select("b", "a")).distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).selectExpr("id", "least(id, near) AS label"),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "id").selectExpr("id", "label AS old", "least(label, near) AS label")
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        stepped = lower.join(jump, "label").selectExpr("id", "old", "least(label, further) AS label")
        moved = written(stepped, "labels")
        labels = moved.select("id", "label")
        if moved.where("old <> label").limit(1).count() == 0:
            return labels.withColumnRenamed("label", "component")
