"""Near-duplicate embeddings: random-hyperplane hashing, exact cosines, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slugline.llm.common import spanning_forest, written
from slugline.llm.components import connected_components

LEAST_BITS = 10
# Buckets hold about so many of unrelated classes; what of the links at the threshold may be missed.
BUCKET_ROWS = 64
MISSED = 0.0015
BLOCK_ROWS = 512
GROUP = ["label_key", "dims", "tbl", "sig", "left_block", "right_block"]


def usable(embedding: str = "embedding") -> Column:
    """Whether a vector is not null, has no null or non-finite component and is not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def vectors_of(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, all of one length, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def hash_shape(n: int, least: float) -> tuple[int, int]:
    """(tables, bits) for n classes: bits grow with log2(n), so buckets of unrelated classes stay small, and
    tables with them, so that a pair at the threshold agrees in one with a probability of 1 - MISSED."""
    bits = min(30, max(LEAST_BITS, (n // BUCKET_ROWS).bit_length()))
    agree = (1 - np.arccos(min(1.0, max(-1.0, least))) / np.pi) ** bits
    return (1 if agree >= 1 else int(np.ceil(np.log(MISSED) / np.log1p(-agree)))), bits


def signatures(vectors: np.ndarray, seed: int, tables: int, bits: int) -> np.ndarray:
    """One number of `bits` bits per table: on which side of each random plane a vector lies."""
    planes = np.random.default_rng((seed, vectors.shape[1])).normal(size=(tables * bits, vectors.shape[1]))
    sides = (vectors @ planes.T >= 0).reshape(len(vectors), tables, bits)
    return (sides << np.arange(bits)).sum(axis=2).astype(np.int32)


def _signed(classes: DataFrame, seed: int, tables: int, bits: int) -> DataFrame:
    """`classes` with the signature of every table, in one array."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("embedding"))
            lengths = column.value_lengths().to_numpy()
            sigs = np.zeros((len(column), tables), np.int32)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                sigs[at] = signatures(vectors_of(column.take(pa.array(at))), seed, tables, bits)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, sigs.size + 1, tables), pa.int32()), pa.array(sigs.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "sigs"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(per_batch, f"{fields}, sigs array<int>")


def link_block(vectors: np.ndarray, sigs: np.ndarray, sides: np.ndarray, tbl: int, least: float):
    """(left, right) rows of the new links of a block pair; sides: 0 left, 1 right, 2 both."""
    a, b = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    norms = np.linalg.norm(vectors, axis=1)
    cosines = (vectors[a] @ vectors[b].T) / np.outer(norms[a], norms[b])
    i, j = np.nonzero(cosines >= least)
    i, j = a[i], b[j]
    if (sides == 2).all():
        i, j = i[i < j], j[i < j]
    new = (sigs[i, :tbl] != sigs[j, :tbl]).all(axis=1)
    return i[new], j[new]


def _found(signed: DataFrame, least: float) -> DataFrame:
    """(a, b, n): links counted at each class (b null), and links that connect (n 0)."""
    spread = signed.select(
        "class",
        "n",
        "sigs",
        "embedding",
        F.xxhash64("label").alias("label_key"),
        F.size("embedding").alias("dims"),
        F.posexplode("sigs").alias("tbl", "sig"),
    )
    bucket = ["label_key", "dims", "tbl", "sig"]
    hot = spread.groupBy(*bucket).agg(F.count("*").alias("rows")).where(F.col("rows") > BLOCK_ROWS)
    blocks = hot.select(*bucket, F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = (
        spread.join(blocks, bucket, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", F.pmod(F.xxhash64("class", "tbl"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left_block", F.least("mine", "other"))
        .withColumn("right_block", F.greatest("mine", "other"))
        .withColumn(
            "side",
            F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1),
        )
    )

    def group_links(rows: pa.RecordBatch) -> list[tuple[int, int | None, int]]:
        if len(rows) < 2:
            return []
        column = dict(zip(rows.schema.names, rows.columns, strict=True))
        ids, n = column["class"].to_numpy(), column["n"].to_numpy()
        sigs = column["sigs"].flatten().to_numpy().reshape(len(rows), -1)
        tbl = column["tbl"][0].as_py()
        i, j = link_block(vectors_of(column["embedding"]), sigs, column["side"].to_numpy(), tbl, least)
        if not len(i):
            return []
        counts = np.bincount(i, n[j], len(rows)) + np.bincount(j, n[i], len(rows))
        told = [(int(ids[k]), None, int(counts[k])) for k in np.flatnonzero(counts)]
        return told + [(int(ids[p]), int(ids[q]), 0) for p, q in spanning_forest([(i, j)], len(rows))]

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

        rest = None  # the last group may go on in the next batch
        for batch in batches:
            rows = batch
            if rest is not None:
                rows = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            keys = np.column_stack([rows.column(k).to_numpy() for k in range(len(GROUP))])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist()]
            yield out([r for a, b in zip(bounds, bounds[1:]) for r in group_links(rows.slice(a, b - a))])
            rest = rows.slice(bounds[-1])
        if rest is not None:
            yield out(group_links(rest))

    dealt = placed.select(*GROUP, "side", "class", "n", "sigs", "embedding").repartition(*GROUP)
    return dealt.sortWithinPartitions(*GROUP).mapInArrow(per_partition, "a long, b long, n long")


def embedding_links(vectors: DataFrame, least: float = 0.93, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors` (vec_id, embedding, label).

    Vectors of one label whose cosine is at least `least` are linked when one of several sign
    hashes agrees, whose number and bits `hash_shape` takes from the number of classes; cosines are computed in double
    precision, so nothing below is linked. At the threshold a pair is found with a probability of 0.9985, above it with a higher one.
    Components are named by their smallest vec_id; n_links counts the other vectors linked.

    Equal vectors of a label are one class with a multiplicity, so copies are never paired. A
    bucket of more than `BLOCK_ROWS` classes is cut into blocks by hash, and each pair of its
    blocks is a group, so a hot bucket spreads over tasks; a pair that an earlier table found is
    not counted again. A group returns counts by class and the fewest links that connect what
    its links connect, not its pairs.

    Vectors that are null, zero, or not finite, and rows without a label, link with nothing, nor
    do vectors of different lengths. Repeated rows are vectors of their own. A null vec_id names
    no component that has another id. An empty table gives an empty one.
    """
    able = F.col("label").isNotNull() & usable()
    key = F.xxhash64("label", F.size("embedding"), "embedding")
    members = written(
        vectors.select(
            "vec_id", F.when(able, key).alias("class"), F.when(able, F.struct("label", "embedding")).alias("of")
        ),
        "members",
    )
    classes = members.where("class IS NOT NULL").groupBy("class").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.first("of").alias("of")
    )
    distinct = written(classes.select("class", "n", "first_id", "of.label", "of.embedding"), "vector_classes")
    signed = written(_signed(distinct, seed, *hash_shape(distinct.count(), least)), "signatures")
    found = written(_found(signed, least), "found")
    labels = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    degrees = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n_other"))
    named = (
        signed.select("class", "n", "first_id")
        .join(degrees, "class", "left")
        .join(labels.withColumnRenamed("id", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("smallest"))
    told = named.join(smallest, "component").select(
        "class", (F.col("n") - 1 + F.coalesce("n_other", F.lit(0))).alias("n_links"), "smallest"
    )
    component = F.coalesce("smallest", "vec_id")
    return members.select("vec_id", "class").join(told, "class", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
