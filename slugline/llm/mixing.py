"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from slugline.llm.common import WORD_PATTERN, written

# 2^64 divided by the golden ratio, odd: multiples of it modulo 2^64 are the golden-ratio points.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SLOTS_PER_CHUNK = 1 << 16
DOCS_PER_SHARD = 8192
MAX_SOURCES = 100_000
# A source has at least so many blocks, of fewer words than others' if it is small.
LEAST_BLOCKS = 256
COPIES_AT_ONCE = 64


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def water_fill(sizes: np.ndarray, weights: np.ndarray, share: float, epochs: float) -> np.ndarray:
    """Targets that share `share` of all tokens by weight, none above `epochs` times its source.

    What a full source cannot take is shared again by weight among the others until none is above.
    """
    limits = sizes * float(epochs)
    targets = np.zeros(len(sizes))
    budget, open_ = min(share * sizes.sum(), limits.sum()), limits > 0
    while open_.any():
        each = budget * weights * open_ / (weights * open_).sum()
        over = open_ & (each >= limits)
        if not over.any():
            return np.where(open_, each, targets)
        targets[over] = limits[over]
        budget -= limits[over].sum()
        open_ &= ~over
    return targets


@dataclass(frozen=True)
class Mixture:
    """blocks: (slot, source, piece of a document) as scheduled; taken: one row per document."""

    taken: DataFrame
    schedule: DataFrame


def mix(
    docs: DataFrame, weights: tuple[int, ...], share: float, epochs: int = 2, block_tokens: int = 64, seed: int = 0
) -> Mixture:
    """Schedule of token blocks from each source of `docs` (doc_id, text, source).

    Sources by code point, null last, take `weights` in turn; targets are those of `water_fill`.
    Each source's documents are put in the order of a hash and cut into blocks of `block_tokens`
    words, or fewer where that would be less than `LEAST_BLOCKS` blocks. Slot k of the mix looks up the golden-ratio point of k in the cumulative shares; the
    r-th slot of a source takes its block r modulo its number of blocks, never one more often
    than `epochs` times. `taken` has doc_id, source, size, source_size, target, taken and row_hash.

    A source is cut into shards by hash, and slots are ranked within chunks first, so neither a
    hot source nor the schedule is ever in one task. Shards end in a shorter block, which the
    number of slots allows for. Null texts have size 0 and take nothing; repeated rows count one
    by one; an empty table gives an empty mix. There is one driver row per source, at most
    `MAX_SOURCES`: beyond that it raises, since such a column is no source.
    """
    spark = docs.sparkSession
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = written(
        docs.select("doc_id", "source", token_count(F.col("text")).alias("size"), order.alias("row_hash")), "sizes"
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda row: (row["source"] is None, row["source"] or ""))
    sizes = np.array([row["source_size"] for row in found], float)
    targets = water_fill(sizes, np.array([weights[k % len(weights)] for k in range(len(found))], float), share, epochs)
    plan = spark.createDataFrame(
        [
            (
                k,
                row["source"],
                row["source_size"],
                float(targets[k]),
                -(-row["n_docs"] // DOCS_PER_SHARD),
                max(1, min(block_tokens, row["source_size"] // LEAST_BLOCKS)),
            )
            for k, row in enumerate(found)
        ],
        "source_no int, source string, source_size long, target double, n_shards long, block_words long",
    )
    # One row per source, at most MAX_SOURCES.
    known = sized.join(F.broadcast(plan), sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])

    # The token stream of a shard, in hash order.
    dealt = known.withColumn("shard", F.pmod(F.xxhash64("row_hash", F.lit(seed + 1)), "n_shards"))
    stream = Window.partitionBy("source_no", "shard").orderBy("row_hash", "doc_id", "size")
    placed = written(
        dealt.withColumn("row_no", F.row_number().over(stream)).withColumn(
            "stop", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0))
        ),
        "streams",
    )
    shards = placed.groupBy("source_no", "shard", "block_words").agg(F.max("stop").alias("tokens"))
    blocks = shards.withColumn("n_blocks", F.ceil(F.col("tokens") / F.col("block_words")))
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(blocks.withColumn("first_block", F.coalesce(F.sum("n_blocks").over(before), F.lit(0))), "shards")
    per_source = {
        row["source_no"]: row["n"]
        for row in offsets.groupBy("source_no").agg(F.sum("n_blocks").alias("n")).collect()
    }
    n_blocks = np.array([per_source.get(k, 0) for k in range(len(found))], np.int64)
    slots = np.divide(targets * n_blocks, sizes, out=np.zeros(len(found)), where=sizes > 0)
    limits = n_blocks * epochs
    schedule = _schedule(docs, slots, n_blocks, limits)

    fragments = (
        placed.where("size > 0")
        .join(offsets.select("source_no", "shard", "first_block"), ["source_no", "shard"])
        .selectExpr(
            "source_no",
            "shard",
            "row_no",
            "stop - size AS begin",
            "stop",
            "first_block",
            "block_words",
            "explode(sequence((stop - size) div block_words, (stop - 1) div block_words)) AS local",
        )
        .selectExpr(
            "source_no",
            "shard",
            "row_no",
            "first_block + local AS block",
            "least(stop, (local + 1) * block_words) - greatest(begin, local * block_words) AS words",
        )
    )
    times = schedule.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    used = (
        fragments.join(times, ["source_no", "block"])
        .groupBy("source_no", "shard", "row_no")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    taken = placed.join(used, ["source_no", "shard", "row_no"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "row_hash"
    )
    return Mixture(taken, schedule)


def _schedule(docs: DataFrame, slots: np.ndarray, n_blocks: np.ndarray, limits: np.ndarray) -> DataFrame:
    """(slot, source_no, block): which block each slot of the mix takes."""
    spark = docs.sparkSession
    total = int(round(slots.sum()))
    edges = np.cumsum(slots) / max(slots.sum(), 1e-300)

    @F.pandas_udf("int")
    def source_of(slot: pd.Series) -> pd.Series:
        point = ((slot.to_numpy().astype(np.uint64) + np.uint64(1)) * GOLDEN).astype(float) / 2.0**64
        return pd.Series(np.minimum(np.searchsorted(edges, point, "right"), len(edges) - 1).astype(np.int32))

    points = spark.range(total).select(F.col("id").alias("slot"), F.expr(f"id div {SLOTS_PER_CHUNK}").alias("chunk"))
    told = written(points.withColumn("source_no", source_of("slot")), "slots")
    counts = told.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("source_no", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("source_no", "chunk").orderBy("slot")
    limit_rows = [(k, int(n_blocks[k]), int(limits[k])) for k in range(len(slots))]
    bounds = spark.createDataFrame(limit_rows, "source_no int, n_blocks long, most long")
    return (
        told.withColumn("row", F.row_number().over(within))
        .join(base, ["source_no", "chunk"])
        .join(F.broadcast(bounds), "source_no")
        .withColumn("rank", F.col("base") + F.col("row") - 1)
        .where("rank < most")
        .selectExpr("slot", "source_no", "rank % n_blocks AS block")
    )


def repeated(docs: DataFrame, mixture: Mixture, seed: int = 0) -> DataFrame:
    """`docs` in the proportions of the mix: each row as often as its taken share says.

    The fraction beyond whole repeats is settled by the row's hash, so a source's expected words
    are what the mix takes. Documents without words appear once: they cost nothing. Columns stay.
    """
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("key"))
    chance = F.pmod(F.xxhash64("row_hash", F.lit(seed + 2)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + chance)).otherwise(F.lit(1))
    times = (
        mixture.taken.select(F.col("row_hash").alias("key"), share.cast("int").alias("times"))
        .groupBy("key")
        .agg(F.sum("times").alias("times"), F.count("*").alias("rows"))
    )
    drawn = written(times, "times")
    once = rows.join(drawn.where("rows = 1 AND times > 0").select("key", F.col("times").cast("int").alias("each")), "key")
    # Equal rows are one row that appears as often as all their draws together; the runs of its copies are dealt anew.
    same = rows.join(drawn.where("rows > 1 AND times > 0"), "key").groupBy("key").agg(
        F.any_value("row").alias("row"), F.any_value("times").alias("times")
    )
    run = F.explode(F.expr(f"sequence(0L, times - 1, {COPIES_AT_ONCE}L)"))
    runs = same.withColumn("start", run).repartition("key", "start")
    each = F.least(F.lit(COPIES_AT_ONCE), F.col("times") - F.col("start")).cast("int")
    both = once.select("row", "each").unionAll(runs.select("row", each.alias("each")))
    return both.selectExpr("row", "explode(array_repeat(0, each)) AS copy").select("row.*")
