"""Near duplicates by SimHash: fingerprints, multi-index Hamming search, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from slugline.llm.common import slices, written
from slugline.llm.components import connected_components

SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, width: int) -> int:
    """The 64-bit SimHash of a text's word shingles; a text without words has 0.

    Words are separated by ASCII white space, A-Z are lower-cased, repeats count. A text of
    fewer words than `width` is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1]))
    last = min(width, len(words)) - 1
    tally, total = np.zeros(64, np.int64), len(words) - last
    digest = xxhash.xxh64_intdigest
    firsts, lasts = starts[:total].tolist(), (ends[last:] - 1).tolist()
    for part in slices(total, HASHES_AT_ONCE):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(firsts[part], lasts[part], strict=True)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        tally += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(tally * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint of every whole text, as the long of the same bits."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(text.as_py(), width) for text in batch.column(2)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fp], ["doc_id", "text_key", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(per_batch, f"doc_id {key}, text_key long, fp long")


def hamming_links(prints: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(a, b): every two of the distinct fingerprints `fp` that differ in at most `max_bits` bits.

    Multi-index hashing: of `segments` parts of the 64 bits, one differs in at most
    max_bits // segments bits, so looking up a ball of that radius around each part in a
    table of that part finds every pair. Within a segment the radius is 0 or 1: with 1, the
    fingerprint that has a zero at the differing bit looks up the one that has a one there, so
    each pair needs one look-up. Complete distances are checked inside the join. A segment
    value that many fingerprints share is a skewed join key, which adaptive execution splits.
    """
    radius = max_bits // segments
    if radius > 1:
        raise ValueError("use more segments: the ball radius within a segment is at most 1")
    cuts = [round(64 * k / segments) for k in range(segments + 1)]
    part = ", ".join(
        f"struct({k} AS seg, {b - a} AS bits, shiftrightunsigned(fp, {a}) & {(1 << (b - a)) - 1}L AS value)"
        for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
    )
    parts = prints.selectExpr("fp", f"inline(array({part}))")
    near = "array(value)"
    if radius:
        zeros = "filter(sequence(0, bits - 1), i -> (shiftrightunsigned(value, i) & 1L) = 0L)"
        near = f"concat(array(value), transform({zeros}, i -> value | shiftleft(1L, i)))"
    probes = parts.selectExpr("fp AS a", "seg", f"explode({near}) AS value")
    tables = parts.selectExpr("fp AS b", "seg", "value")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    same = (F.col("p.seg") == F.col("t.seg")) & (F.col("p.value") == F.col("t.value"))
    pairs = probes.alias("p").join(tables.alias("t"), same & (F.col("a") != F.col("b")) & close)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) for every row of `docs` (doc_id, text).

    Rows whose fingerprints are linked by a chain of distances of at most `max_bits` form one
    component, named by its smallest doc_id. Copies share a fingerprint and are never paired.
    Null and blank texts have fingerprint 0 and link like any other; repeated rows stay;
    an empty table gives an empty one. A component of null ids only has a null name.
    """
    prints = written(fingerprints(docs, width), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    found = connected_components(hamming_links(classes.select("fp"), max_bits, segments))
    named = classes.join(found.withColumnRenamed("id", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    names = named.select("fp", "component").join(smallest, "component")
    return prints.join(names, "fp").select("doc_id", "text_key", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """The rows of `docs` that stay: of each component the smallest (doc_id, hash of the text).

    All columns stay as they are. Of repeated rows one stays. A null doc_id comes first.
    """
    return first_of_each(docs, near_duplicates(docs, width, max_bits, segments))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `docs` that have the smallest (doc_id, text_key) of a component of `found`."""
    row = F.struct("doc_id", "text_key")
    kept = found.groupBy("component").agg(F.min(row).alias("keep"))
    counts = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    of_kept = kept.select(F.col("keep.doc_id").alias("keep_id"), F.col("keep.text_key").alias("keep_key"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_key") == F.col("keep_key"))
    stays = written(counts.join(of_kept, same).select("keep_id", "keep_key", "n"), "stays")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))

    def of(keys: DataFrame) -> DataFrame:
        return rows.join(keys.hint("shuffle_hash"), same, "left_semi")

    single = of(stays.where("n = 1")).select("row.*")
    if stays.where("n > 1").isEmpty():
        return single
    return single.unionByName(of(stays.where("n > 1")).dropDuplicates(["doc_id", "text_key"]).select("row.*"))


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
