"""Fingerprints and Hamming links against plain Python."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from slugline.llm import simhash
from slugline.llm.components import connected_components


def plain_fingerprint(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(ids, links):
    name = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    return name


def test_fingerprints_of_odd_texts():
    source = random.Random(1)
    words = ["Ab", "ba", "É", "x y", " ", "z" * 500]
    texts = [None, "", " \n\t", "one", "one two", *(" \x0b".join(source.choices(words, k=n)) for n in (3, 4, 50, 700))]
    for width in (3, 5):
        assert [simhash.fingerprint_of(t, width) for t in texts] == [plain_fingerprint(t, width) for t in texts]


def test_spark_hash_is_the_same(spark):
    (row,) = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).collect()
    assert row.h % 2**64 == xxhash.xxh64_intdigest("a b ç".encode(), 42)


def test_links_are_all_pairs_within_the_distance(spark):
    source = random.Random(2)
    prints = {0, 2**64 - 1}
    for _ in range(40):
        center = source.getrandbits(64)
        for flips in (0, 1, 2, 3, 4):
            prints.add(center ^ sum({1 << source.randrange(64) for _ in range(flips)}))
    prints = [p - 2**64 if p >= 2**63 else p for p in prints]
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    for segments in (2, 3, 4):
        assert {tuple(r) for r in simhash.hamming_links(frame, 3, segments).collect()} == want
    found = {r.id: r.component for r in connected_components(simhash.hamming_links(frame, 3, 2)).collect()}
    whole = groups(prints, want)
    assert found == {i: whole[i] for pair in want for i in pair}


def test_components_of_long_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(found.values()) == {0, 100} and len(found) == 61 + 60


def test_a_hub_that_adaptive_execution_splits(spark):
    """One id with most links, over the limits from which a join's partition counts as skewed."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        links = spark.range(1, 40_000).selectExpr("CAST(7 AS LONG) AS a", "10 + id AS b")
        chain = spark.range(50).selectExpr("40010 + id AS a", "40009 + id AS b")
        apart = spark.createDataFrame([(90_000, 90_001), (90_001, 90_002)], "a long, b long")
        found = connected_components(links.union(chain).union(apart))
        told = {r.component: r["count"] for r in found.groupBy("component").count().collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert told == {7: 1 + 39_999 + 50, 90_000: 3}


def test_pieces_of_a_long_text_have_the_same_shingles(monkeypatch):
    text = " ".join(f"Word{k % 31}" for k in range(500))
    for at_once in (1, 7, 499, 1 << 16):
        monkeypatch.setattr(simhash, "HASHES_AT_ONCE", at_once)
        assert {simhash.fingerprint_of(text, width) == plain_fingerprint(text, width) for width in (1, 3, 5)} == {True}


def test_documents_of_every_kind(spark):
    text = " ".join(f"word{k}" for k in range(400))
    rows = [
        (1, text, "a"), (9, text, "b"), (9, text, "b"), (4, text + " tail", "c"), (5, "other words here now", "d"),
        (6, None, "e"), (7, "", "f"), (8, " \n", "g"), (None, text, "h"), (None, "quite another text of some length", "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("component", F.lit(1))
    found = simhash.near_duplicates(docs, 5).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id or -1) for r in found) == sorted(
        [(False, 1, 1), (False, 9, 1), (False, 9, 1), (False, 4, 1), (False, 5, 5), (False, 6, 6), (False, 7, 6),
         (False, 8, 6), (True, 0, 1), (True, 0, -1)]
    )
    kept = simhash.one_of_each(docs, 5)
    assert kept.columns == docs.columns
    assert sorted(r.fp for r in kept.collect()) == ["d", "e", "h", "i"]
    assert simhash.one_of_each(docs.limit(0), 5).count() == 0
    twice = docs.where("doc_id = 9")
    assert simhash.one_of_each(twice, 5).count() == 1
