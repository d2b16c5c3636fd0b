"""Exact top-k by inner product with M-trees: paged metric nodes, best-first search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from slugline.llm.common import slices, written

CELLS = 64  # routing objects of the level above the trees, at least; their number grows with the rows
MOST_CELLS = 4096
TREE_ROWS = 4096
LEAF_ROWS = 64
FANOUT = 16
TREES_IN_GROUP = 8
QUERIES_IN_GROUP = 8192
ROOT_BYTES = 64 << 20  # of root nodes that one broadcast may hold; beyond that queries meet them in parts
ROWS_AT_ONCE = 256
SLACK = 1e-6  # squared distances are whole numbers, so this covers rounding


def scaled(embedding: str, scale: int) -> Column:
    """floor(scale * x) of every component x; null for a vector with a null or non-finite one."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    return F.when(~bad, whole)


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in vectors], np.int64)


def lifted(vectors: np.ndarray, most: int) -> np.ndarray:
    """Vectors with one more coordinate that brings each to the squared length `most`.

    Among these, a query with a zero there has the squared distance |q|^2 + most - 2 q.x, so
    the largest inner products are the nearest neighbours and the triangle inequality holds.
    """
    squares = (vectors * vectors).sum(axis=1)
    return np.column_stack((vectors.astype(float), np.sqrt(np.maximum(most - squares, 0))))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


# --- building ----------------------------------------------------------------------------------


def tree_nodes(ids: np.ndarray, vectors: np.ndarray, most: int, seed: int) -> list[dict]:
    """The nodes of one M-tree, the root first, each a page.

    A node has a routing object `center`, its covering `radius` and the distance `up` to its
    parent's. A leaf holds rows with their distances to the center. A node of more rows than a
    leaf has is dealt to the nearest of FANOUT of its rows; where that parts nothing (equal
    vectors), into runs.
    """
    points = lifted(vectors, most)
    rng = np.random.default_rng(seed)
    nodes: list[dict] = []
    todo = [(np.arange(len(ids)), points.mean(axis=0), -1)]
    while todo:
        rows, center, parent = todo.pop()
        reach = distances(center[None], points[rows])[0]
        up = float(np.linalg.norm(center - nodes[parent]["center"])) if parent >= 0 else 0.0
        number = len(nodes)
        nodes.append({"node": number, "parent": parent, "center": center, "radius": float(reach.max()), "up": up})
        leaf = len(rows) <= LEAF_ROWS
        order = np.argsort(reach, kind="stable")
        nodes[-1] |= {
            "ids": ids[rows[order]] if leaf else np.array([], np.int64),
            "vectors": vectors[rows[order]].tobytes() if leaf else b"",
            "reach": reach[order] if leaf else np.array([]),
        }
        if leaf:
            continue
        chosen = points[rng.choice(rows, FANOUT, replace=False)]
        nearest = distances(points[rows], chosen).argmin(axis=1)
        if len(np.unique(nearest)) == 1:
            nearest = np.arange(len(rows)) * FANOUT // len(rows)
        for k in np.unique(nearest):
            part = rows[nearest == k]
            todo.append((part, points[part].mean(axis=0) if len(part) > 1 else points[part[0]], number))
    return nodes


# --- searching ---------------------------------------------------------------------------------


@dataclass
class Best:
    """The best k of each query so far, by falling score and rising id."""

    ids: np.ndarray
    scores: np.ndarray
    full: np.ndarray  # the k-th score that is known to be reached, or the least number

    @classmethod
    def of(cls, n: int, k: int, floor: np.ndarray) -> Best:
        least = np.iinfo(np.int64).min
        return cls(np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), least), floor.copy())

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: np.ndarray) -> None:
        """Offer rows to the queries `at`; a query's own row and scores below its k-th don't count."""
        least = np.iinfo(np.int64).min
        scores = np.where((ids[None] == own[at][:, None]) | (scores < self.full[at][:, None]), least, scores)
        better = np.flatnonzero((scores > least).any(axis=1))
        if not len(better):
            return
        rows, k = at[better], self.ids.shape[1]
        all_ids = np.hstack((self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))))
        all_scores = np.hstack((self.scores[rows], scores[better]))
        order = np.lexsort((all_ids, -np.maximum(all_scores, least + 1)), axis=1)[:, :k]
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.full[rows] = np.maximum(self.full[rows], self.scores[rows][:, -1])


def farthest(squares: np.ndarray, floor: np.ndarray, most: int) -> np.ndarray:
    """How far from a query, of a squared length, a row may lie that has a score of `floor` or more."""
    known = floor > np.iinfo(np.int64).min
    beyond = squares + float(most) - 2.0 * np.where(known, floor, 0)
    return np.where(known, np.sqrt(np.maximum(beyond, 0)), np.inf) + SLACK


def search_tree(nodes: list[dict], queries: np.ndarray, own: np.ndarray, most: int, best: Best) -> int:
    """Best-first search of one tree for all queries; returns the number of distances computed.

    In a round every query opens the nearest node it has not opened, and queries at the same
    node go through it together. A child or row is passed over without computing its distance
    when |distance to the parent - stored distance| less the radius is beyond the k-th best.
    """
    squares = (queries * queries).sum(axis=1)
    points = np.column_stack((queries.astype(float), np.zeros(len(queries))))
    floats = points[:, :-1]
    children: dict[int, list[int]] = {}
    for node in nodes:
        children.setdefault(node["parent"], []).append(node["node"])
    bound = np.full((len(queries), len(nodes)), np.inf)
    away = np.zeros((len(queries), len(nodes)))
    away[:, 0] = distances(points, nodes[0]["center"][None])[:, 0]
    bound[:, 0] = np.maximum(away[:, 0] - nodes[0]["radius"], 0)
    computed = len(queries)

    def limit(at: np.ndarray) -> np.ndarray:
        return farthest(squares[at], best.full[at], most)

    live = np.arange(len(queries))
    while len(live):
        nearest = bound[live].argmin(axis=1)
        lowest = bound[live, nearest]
        going = np.isfinite(lowest) & (lowest <= limit(live))
        live, nearest = live[going], nearest[going]
        for number in np.unique(nearest):
            at, node = live[nearest == number], nodes[number]
            bound[at, number] = np.inf
            if number in children:
                below = np.array(children[number])
                ups = np.array([nodes[c]["up"] for c in below])
                radii = np.array([nodes[c]["radius"] for c in below])
                near = np.abs(away[at, number][:, None] - ups) - radii <= limit(at)[:, None]
                for k in np.flatnonzero(near.any(axis=0)):
                    some = at[near[:, k]]
                    d = distances(points[some], nodes[below[k]]["center"][None])[:, 0]
                    computed += len(some)
                    away[some, below[k]] = d
                    bound[some, below[k]] = np.maximum(d - radii[k], 0)
            else:
                near = np.abs(away[at, number][:, None] - node["reach"]) <= limit(at)[:, None]
                rows = near.any(axis=0)
                if rows.any():
                    vectors = node["matrix"][rows]
                    scores = np.rint(floats[at] @ vectors.T.astype(float)).astype(np.int64)
                    computed += scores.size
                    best.add(at, node["ids"][rows], scores, own)
    return computed


def _opened(pages: pd.DataFrame) -> list[list[dict]]:
    """The trees of node pages, each with its nodes in order."""
    trees = []
    for _, rows in pages.groupby("tree", sort=True):
        nodes = []
        for row in rows.sort_values("node").to_dict("records"):
            row["center"], row["reach"] = np.asarray(row["center"], float), np.asarray(row["reach"], float)
            row["ids"] = np.asarray(row["ids"], np.int64)
            row["matrix"] = np.frombuffer(row["vectors"], np.int64).reshape(len(row["ids"]), len(row["center"]) - 1)
            nodes.append(row)
        trees.append(nodes)
    return trees


def _answers(queries: pd.DataFrame, best: Best) -> pd.DataFrame:
    rows, places = np.nonzero(best.scores > np.iinfo(np.int64).min)
    told = {"query_id": queries["query_id"].to_numpy()[rows], "vec_id": best.ids[rows, places]}
    return pd.DataFrame(told | {"score": best.scores[rows, places]})


def reachable(queries: DataFrame, roots: DataFrame, longest: dict[int, int], root_bytes: int | None = None) -> DataFrame:
    """(query_id, v, dims, floor, trees_no): the groups of trees where a row may reach a query's floor.

    `roots` (dims, trees_no, center, radius) are the root nodes of all trees. Their covering radii
    tell, before anything is shuffled, that no row of a tree is near enough. More of them than
    `ROOT_BYTES` are split by hash into parts, and the queries go past one part after the other.
    """
    spark = queries.sparkSession
    kept = roots.select("dims", "trees_no", "center", "radius")
    size = kept.agg(F.sum(F.lit(8) * (F.col("dims") + 4))).head()[0] or 0
    parts = max(1, -(-size // (ROOT_BYTES if root_bytes is None else root_bytes)))
    fields = "query_id long, v array<long>, dims int, floor long"
    found = None
    for part in range(parts):
        told = kept.where(F.pmod(F.xxhash64("trees_no"), F.lit(parts)) == part).orderBy("dims", "trees_no").toArrow()
        balls = {}
        for d in longest:
            of = told.filter(pa.compute.equal(told["dims"], d)).combine_chunks()
            if len(of):
                centers = np.concatenate([c.values.to_numpy() for c in of["center"].chunks]).reshape(len(of), -1)
                balls[d] = (of["trees_no"].to_numpy(), centers, of["radius"].to_numpy())
        shared = spark.sparkContext.broadcast(balls)

        def per_batch(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims, floor = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                for d in np.unique(dims):
                    if d not in shared.value:
                        continue
                    groups, centers, radii = shared.value[d]
                    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
                    of_length = np.flatnonzero(dims == d)
                    for part in slices(len(of_length), ROWS_AT_ONCE):
                        at = of_length[part]
                        vectors = batch.column(1).take(pa.array(at)).flatten().to_numpy().reshape(len(at), d)
                        points = np.column_stack((vectors.astype(float), np.zeros(len(at))))
                        limit = farthest((vectors * vectors).sum(axis=1), floor[at], longest[d])
                        near = distances(points, centers) - radii <= limit[:, None]
                        rows, places = np.nonzero(np.logical_or.reduceat(near, first, axis=1))
                        columns = batch.take(pa.array(at[rows])).columns
                        names = ["query_id", "v", "dims", "floor", "trees_no"]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(groups[first][places], pa.int64())], names)

        met = queries.select("query_id", "v", "dims", "floor").mapInArrow(per_batch, f"{fields}, trees_no long")
        found = met if found is None else found.unionAll(met)
    return found


ANSWER = "query_id long, vec_id long, score long"


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product with each query.

    Both tables have vec_id and v, an array of whole numbers; rows with a null id or vector take
    no part. A row is no answer to the query of its own id. Ties go to the smaller id; fewer
    candidates than k are all returned, and a vector is compared with those of its length only.
    Repeated query rows are answered once, repeated rows are candidates of their own. Inner
    products and squared lengths are exact below 2^53.

    Index: rows go to the nearest of `CELLS` routing objects, or more with the root of the number
    of rows, up to `MOST_CELLS`; a cell is dealt by hash into trees of about `TREE_ROWS` rows, whose
    nodes are pages of a written table. Search: each query goes through one tree of its own cell
    first, which gives a k-th score to beat. The root nodes then tell which groups of trees may hold
    such a score (`reachable`), and blocks of those queries meet the group, each pair of them
    one task's group. Only rows that beat the first score leave a task. All of the index is exact, so
    recall is 1. Other columns of both tables, whatever their names, are not read.
    """
    rows = written(vectors.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").select(
        "vec_id", "v", F.size("v").alias("dims"), F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x).alias("square")
    ), "vectors")
    asked = queries.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").select(
        F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dims")
    ).dropDuplicates(["query_id"])
    spark = vectors.sparkSession
    longest = {r["dims"]: r["m"] for r in rows.groupBy("dims").agg(F.max("square").alias("m")).collect()}
    if not longest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_cells = min(MOST_CELLS, max(CELLS, math.isqrt(rows.count() // 16)))
    # Drawn by row, and copies once: a vector that many rows share is one routing object.
    sample = rows.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(n_cells).select("v", "dims").collect()
    routing = spark.sparkContext.broadcast(
        {d: np.unique(matrix([r["v"] for r in sample if r["dims"] == d]).reshape(-1, d), axis=0) for d in longest}
    )

    def with_cell(df: DataFrame, key: str, lift: bool) -> DataFrame:
        def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(2).to_numpy()
                cell = np.zeros(len(dims), np.int32)
                for d in np.unique(dims):
                    if len(routing.value[d]):
                        at = np.flatnonzero(dims == d)
                        found = batch.column(1).take(pa.array(at)).flatten().to_numpy().reshape(len(at), d)
                        most = longest[d]
                        own = lifted(found, most) if lift else np.column_stack((found.astype(float), np.zeros(len(at))))
                        cell[at] = distances(own, lifted(routing.value[d], most)).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [key, "v", "dims", "cell"])

        return df.select(key, "v", "dims").mapInArrow(per_batch, f"{key} long, v array<long>, dims int, cell int")

    celled = written(with_cell(rows, "vec_id", True), "cells")
    counts = celled.groupBy("dims", "cell").agg(F.ceil(F.count("*") / TREE_ROWS).alias("trees"))
    before = Window.partitionBy("dims").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # At most MOST_CELLS rows for each length of vectors; `first` is the number of trees in earlier cells.
    counts = written(counts.withColumn("first", F.coalesce(F.sum("trees").over(before), F.lit(0))), "counts")
    dealt = celled.join(F.broadcast(counts), ["dims", "cell"]).withColumn(
        "tree", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), "trees")
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        dims, cell, tree = (int(rows[c].iloc[0]) for c in ("dims", "cell", "tree"))
        rows = rows.sort_values("vec_id")
        nodes = tree_nodes(rows["vec_id"].to_numpy(), matrix(rows["v"]), longest[dims], seed=cell)
        return pd.DataFrame(nodes).assign(dims=dims, cell=cell, tree=tree)[list(PAGE)]

    schema = ", ".join(f"{n} {t}" for n, t in PAGE.items())
    pages = written(dealt.groupBy("dims", "cell", "tree").applyInPandas(build, schema), "pages")

    # First one tree of the query's own cell.
    placed = written(
        with_cell(asked, "query_id", False)
        .join(F.broadcast(counts), ["dims", "cell"], "left")
        .withColumn("tree", F.pmod(F.xxhash64("query_id"), F.coalesce("trees", F.lit(1)))),
        "queries",
    )

    def at_home(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        best = Best.of(len(queries), k, np.full(len(queries), np.iinfo(np.int64).min))
        if len(queries) and len(pages):
            for nodes in _opened(pages):
                search_tree(nodes, matrix(queries["v"]), queries["query_id"].to_numpy(), longest[int(pages["dims"].iloc[0])], best)
        full = np.where((best.scores > np.iinfo(np.int64).min).all(axis=1), best.scores[:, -1], np.iinfo(np.int64).min)
        return pd.DataFrame({"query_id": queries["query_id"], "floor": full})

    # A cell may draw many queries: they are dealt into blocks, each of which meets the tree.
    keys = ["dims", "cell", "tree"]
    blocks = F.ceil(F.count("*") / QUERIES_IN_GROUP).cast("int")
    homes = written(placed.groupBy(*keys).agg(blocks.alias("blocks")), "homes")
    mine = F.pmod(F.xxhash64("query_id", F.lit("block")), "blocks").cast("int")
    waiting = placed.join(homes, keys).select(*keys, mine.alias("block"), "query_id", "v").groupBy(*keys, "block")
    each = homes.select(*keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = pages.join(each, keys).groupBy(*keys, "block")
    floors = waiting.cogroup(met).applyInPandas(at_home, "query_id long, floor long")
    floored = written(placed.select("query_id", "v", "dims").join(floors, "query_id"), "floors")

    # Then blocks of queries against the groups of trees that they may reach.
    grouped = pages.join(F.broadcast(counts), ["dims", "cell"]).withColumn(
        "trees_no", F.expr(f"(first + tree) div {TREES_IN_GROUP}")
    )
    met = written(reachable(floored, grouped.where("parent < 0"), longest), "reachable")
    meeting = written(met.groupBy("dims", "trees_no").agg(blocks.alias("blocks")), "meeting")
    left = met.join(meeting, ["dims", "trees_no"]).withColumn("queries_no", mine)
    right = grouped.join(meeting, ["dims", "trees_no"]).withColumn(
        "queries_no", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(*PAGE, "trees_no", "queries_no")

    def everywhere(queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        best = Best.of(len(queries), k, queries["floor"].to_numpy(np.int64))
        if len(queries) and len(pages):
            wide, own = matrix(queries["v"]), queries["query_id"].to_numpy()
            trees = pages.assign(tree=pages["cell"].astype(str) + ":" + pages["tree"].astype(str))
            for nodes in _opened(trees):
                search_tree(nodes, wide, own, longest[int(pages["dims"].iloc[0])], best)
        return _answers(queries, best)

    both = ["dims", "trees_no", "queries_no"]
    answers = left.groupBy(*both).cogroup(right.groupBy(*both)).applyInPandas(everywhere, ANSWER)
    found = written(answers, "answers")
    # Spark keeps the first k of each query in every task before it shuffles.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


PAGE = {
    "dims": "int",
    "cell": "int",
    "tree": "long",
    "node": "int",
    "parent": "int",
    "center": "array<double>",
    "radius": "double",
    "up": "double",
    "ids": "array<long>",
    "vectors": "binary",
    "reach": "array<double>",
}
