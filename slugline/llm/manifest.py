"""Merkle manifest of a dataset: a content-addressed tree over its rows, and proofs out of it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from slugline.llm.common import written

# A stored record covers so many levels of a binary tree: a node and its up to 2^LEVELS children.
LEVELS = 8
# Repeated rows are numbered in runs of so many, and so many equal nodes share one copy of a record.
COPIES_AT_ONCE = 4096
USES_AT_ONCE = 64
# The number of the tree whose leaves are the other trees' tops.
TOP = -1

_NODE = "tree long, n_leaves long, rank long, digest string"
_RECORD = "digest string, depth int, children array<string>"


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sized(value: Column) -> Column:
    """A value as text with its number of bytes and a colon before it, `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[sized(value) for value in values]), 256)


def height(n: Column) -> Column:
    """Levels above n nodes until one remains."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def tree_levels(children: list[str], depth: int) -> list[list[str]]:
    """The children and the `depth` levels above: every two consecutive nodes become one, a last one alone as well."""
    levels = [children]
    for _ in range(depth):
        below = levels[-1]
        levels.append([digest_of(*below[k : k + 2]) for k in range(0, len(below), 2)])
    return levels


def unselected(levels: list[list[str]], slot: int) -> list[str]:
    """The node left aside at each step from the top of `levels` down to a child; '' where there is none."""
    aside = []
    for k in range(len(levels) - 2, -1, -1):
        other = (slot >> k) ^ 1
        aside.append(levels[k][other] if other < len(levels[k]) else "")
    return aside


def folded(leaf: str, rank: int, siblings: list[str]) -> str:
    """The top that a leaf and its siblings, the lowest first, lead to."""
    node = leaf
    for k, sibling in enumerate(siblings):
        node = digest_of(sibling, node) if rank >> k & 1 else digest_of(node, sibling)
    return node


def numbered(rows: DataFrame, group: list[str], order: list[str], n: str) -> DataFrame:
    """`rows` with `before`: the sum of `n` over earlier rows of the same group, in the order given.

    No two rows may be equal in `group` and `order`. Rows are dealt by ranges of these, so a group of
    any size is spread over tasks; the sums within a range and of the ranges before it add up. A
    written table fixes the ranges. One task sees the ranges' sums of a group, as many as
    shuffle partitions, and never the rows of one.
    """
    dealt = written(rows.repartitionByRange(*group, *order).withColumn("range_no", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range_no", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("range_no", *group).agg(F.sum(n).alias("sum"))
    starts = sums.select(
        F.col("range_no").alias("_no"),
        *[F.col(g).alias(f"_{g}") for g in group],
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"),
    )
    same = reduce(lambda met, g: met & F.col(g).eqNullSafe(F.col(f"_{g}")), group, F.col("range_no") == F.col("_no"))
    met = dealt.withColumn("inside", F.coalesce(F.sum(n).over(inside), F.lit(0))).join(starts, same)
    return met.select(*rows.columns, (F.col("start") + F.col("inside")).cast("long").alias("before"))


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, n_leaves, rank and the columns `build` was given; trees: tree, n_leaves, name, subroot.

    records: digest, depth, children, and uses, the number of nodes that have the digest. A record's
    digest follows from its children, `depth` levels below. The subroots are the children of the
    records of tree TOP, which end in `root`.
    """

    leaves: DataFrame
    trees: DataFrame
    records: DataFrame
    root: str | None


def build(leaves: DataFrame, name: str, order: str, digest: str) -> Manifest:
    """The manifest of `leaves`: a binary tree for each `name`, null among them, and one over the trees' tops.

    Leaves ascend by `order` (nulls first) in a tree, then by their other columns; trees ascend by
    name, bytewise and null first. Rows equal in all columns are leaves of their own with consecutive
    ranks. A lone leaf is its tree's subroot, a lone subroot is the root; an empty table has no root
    (None). The columns tree, n_leaves and rank are added and must be new.
    """
    others = [c for c in leaves.columns if c not in (name, order)]
    # Equal rows are counted before anything is dealt by value, so copies are no hot key.
    classes = written(leaves.groupBy(*leaves.columns).agg(F.count("*").alias("_n")), "leaf_classes")
    placed = numbered(classes, [name], [order, *others], "_n")
    sizes = classes.groupBy(name).agg(F.sum("_n").alias("n_leaves"), F.lit(1).alias("_one"))
    trees = written(numbered(sizes, [], [name], "_one").withColumnsRenamed({"before": "tree", name: "_name"}), "tree_sizes")
    of_tree = placed.join(trees.drop("_one"), F.col(name).eqNullSafe(F.col("_name"))).drop("_name")
    # The runs of a row that is repeated often are dealt anew before each becomes rows.
    runs = of_tree.withColumn("_start", F.explode(F.expr(f"sequence(0L, _n - 1, {COPIES_AT_ONCE}L)")))
    dealt = runs.repartition("tree", "before", "_start")
    rank = F.explode(F.expr(f"sequence(before + _start, before + least(_start + {COPIES_AT_ONCE}L, _n) - 1)"))
    ranked = written(dealt.select("tree", "n_leaves", rank.alias("rank"), *leaves.columns), "leaves")

    records, tops = _grown(ranked.select("tree", "n_leaves", "rank", F.col(digest).alias("digest")))
    named = written(trees.drop("_one").join(tops, "tree").withColumnsRenamed({"_name": name, "digest": "subroot"}), "trees")
    n_trees = named.count()
    over = named.selectExpr(f"{TOP}L AS tree", f"{n_trees}L AS n_leaves", "tree AS rank", "subroot AS digest")
    more, last = _grown(over)
    # Equal subtrees, in whatever tree, are one record.
    stored = records.union(more).groupBy("digest").agg(
        F.any_value("depth").alias("depth"), F.any_value("children").alias("children"), F.count("*").alias("uses")
    )
    found = last.head()
    return Manifest(ranked, named, written(stored, "records"), found["digest"] if found else None)


def _grown(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, tops (tree, digest)) above the leaves (tree, n_leaves, rank, digest) of trees."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("children"), batch.column("depth"), strict=True)
            tops = [tree_levels(c.as_py(), d.as_py())[-1][0] for c, d in pairs]
            kept = ["tree", "n_leaves", "rank", "depth", "children"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(tops, pa.string())], [*kept, "digest"])

    h = height(F.col("n_leaves"))
    tallest = nodes.agg(F.max(h)).head()[0] or 0
    tops, records = nodes.where(h == 0).select("tree", "digest"), nodes.sparkSession.createDataFrame([], _RECORD)
    for done in range(0, tallest, LEVELS):
        together = (
            nodes.where(h > done)
            .groupBy("tree", "n_leaves", F.shiftright("rank", LEVELS).alias("parent"))
            .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
            .select(
                "tree",
                "n_leaves",
                F.col("parent").alias("rank"),
                F.least(F.lit(LEVELS), h - done).alias("depth"),
                F.transform("nodes", lambda x: x["digest"]).alias("children"),
            )
        )
        level = written(
            together.mapInArrow(hashed, "tree long, n_leaves long, rank long, depth int, children array<string>, digest string"), "level"
        )
        records = records.union(level.select("digest", "depth", "children"))
        nodes = level.select("tree", "n_leaves", "rank", "digest")
        tops = tops.union(nodes.where(h <= done + LEVELS).select("tree", "digest"))
    return records, tops


def prove(manifest: Manifest, requests: DataFrame, altered: str) -> DataFrame:
    """`requests` with `siblings` and `folded_root`: the root that the digests in column `altered` lead to.

    Requests are rows of `manifest.leaves`, all of them or some, each once, with any further columns.
    `siblings` go from the leaf's level up to the root's, '' where a node was alone.

    Requests descend together: they are grouped by the leading digits of their ranks. Starting with
    the root, each hop looks up the digests of its nodes in the records, follows the next digit of
    every requested rank and appends what it leaves aside; paths are reversed at the end. Upper hops
    carry a row per requested subtree; a request meets its path in the last one, where up to
    2^LEVELS requests share a row. A digest of many nodes (copies of whole stretches) meets
    copies of its record, one for every USES_AT_ONCE of them, so that it is no hot key.
    """
    spark, trees = requests.sparkSession, manifest.trees
    added = StructType.fromDDL("siblings array<string>, folded_root string")
    out = StructType([*requests.schema.fields, *added.fields])
    if manifest.root is None:
        return spark.createDataFrame([], out)
    n_trees, tallest = trees.agg(F.count("*"), F.max(height(F.col("n_leaves")))).head()
    top_levels = (n_trees - 1).bit_length()
    root = spark.createDataFrame([(TOP, n_trees, 0, manifest.root, [])], f"{_NODE}, path array<string>")
    tree_wanted = requests.select("tree").distinct().selectExpr(f"{TOP}L AS tree", "tree AS rank")
    tops = _descended(manifest.records, root, tree_wanted, range(-(-top_levels // LEVELS) - 1, -1, -1))
    subroots = tops.selectExpr("rank AS tree", "0L AS rank", "digest", "path").join(trees.select("tree", "n_leaves"), "tree")
    wanted = requests.select("tree", "rank")
    lowest = _descended(manifest.records, subroots, wanted, range(-(-tallest // LEVELS) - 1, 0, -1))

    shared = ["tree", "rank", "path", "depth", "children"]
    lone = height(F.col("n_leaves")) == 0
    met = _looked_up(lowest.where(~lone), manifest.records).select(*shared)
    met = met.union(lowest.where(lone).selectExpr("tree", "rank", "path", "0 AS depth", "array(digest) AS children"))
    asked = requests.groupBy("tree", F.shiftright("rank", LEVELS).alias("rank")).agg(
        F.collect_list(F.struct(*requests.columns)).alias("requests")
    )
    names = requests.columns

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tree, path = batch.column("tree")[k].as_py(), batch.column("path")[k].as_py()
                levels = tree_levels(batch.column("children")[k].as_py(), batch.column("depth")[k].as_py())
                mine = batch.column("requests")[k].values
                siblings, roots = [], []
                for rank, leaf in zip(mine.field("rank").to_pylist(), mine.field(altered).to_pylist(), strict=True):
                    way = (path + unselected(levels, rank % (1 << LEVELS)))[::-1]
                    own = len(way) - top_levels
                    siblings.append(way)
                    roots.append(folded(folded(leaf, rank, way[:own]), tree, way[own:]))
                arrays = [*(mine.field(c) for c in names), pa.array(siblings, pa.list_(pa.string())), pa.array(roots, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*names, "siblings", "folded_root"])

    return met.join(asked, ["tree", "rank"]).mapInArrow(answered, out)


def _looked_up(nodes: DataFrame, records: DataFrame) -> DataFrame:
    """`nodes` with depth and children of their digests' records."""
    copies = F.ceil(F.col("uses") / USES_AT_ONCE).cast("int")
    often = records.where(copies > 1).select("digest", copies.alias("_copies"))
    spread = records.select("digest", "depth", "children", F.explode(F.sequence(F.lit(1), copies)).alias("_copy"))
    mine = F.pmod(F.xxhash64("tree", "rank"), F.coalesce("_copies", F.lit(1))) + 1
    dealt = nodes.join(often, "digest", "left").withColumn("_copy", mine.cast("int"))
    return dealt.join(spread, ["digest", "_copy"])


def _descended(records: DataFrame, nodes: DataFrame, wanted: DataFrame, hops: range) -> DataFrame:
    """`nodes` (.., path) moved down to those above `wanted` (tree, rank), hop by hop, with longer paths.

    Hop k reads digit k of the ranks, to the base of 2^LEVELS. A tree of fewer digits joins in later.
    """
    columns = ["tree", "n_leaves", "rank", "digest", "path"]

    def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                levels, slots = tree_levels(row["children"], row["depth"]), row["slots"]
                cells = {
                    "tree": pa.array([row["tree"]] * len(slots), pa.int64()),
                    "n_leaves": pa.array([row["n_leaves"]] * len(slots), pa.int64()),
                    "rank": pa.array([row["rank"] << LEVELS | slot for slot in slots], pa.int64()),
                    "digest": pa.array([row["children"][slot] for slot in slots], pa.string()),
                    "path": pa.array([row["path"] + unselected(levels, slot) for slot in slots], pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_pydict(cells)

    for hop in hops:
        joins_in = height(F.col("n_leaves")) > hop * LEVELS
        digit = F.shiftright("rank", hop * LEVELS).bitwiseAND(F.lit((1 << LEVELS) - 1)).cast("int")
        prefix = F.shiftright("rank", (hop + 1) * LEVELS)
        asked = wanted.groupBy("tree", prefix.alias("rank")).agg(F.collect_set(digit).alias("slots"))
        met = _looked_up(nodes.where(joins_in), records).join(asked, ["tree", "rank"])
        moved = met.select("tree", "n_leaves", "rank", "path", "depth", "children", "slots")
        waiting = nodes.where(~joins_in).select(*columns)
        nodes = written(moved.mapInArrow(followed, f"{_NODE}, path array<string>").union(waiting), "hop")
    return nodes
