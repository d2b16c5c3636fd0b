"""Mixing: targets, schedule and what each document gives."""

import numpy as np
from pyspark.sql import functions as F

from slugline.llm import mixing


def test_water_fill():
    sizes, weights = np.array([100.0, 10, 1000, 0]), np.array([3.0, 1, 2, 3])
    targets = mixing.water_fill(sizes, weights, 1.0, 2)
    assert np.allclose(targets, [200, 20, 890, 0])
    assert np.allclose(mixing.water_fill(sizes, weights, 9.0, 2), 2 * sizes)
    assert mixing.water_fill(np.array([]), np.array([]), 1.5, 2).tolist() == []


def test_mix_of_uneven_sources(spark):
    rows = [(k, "w " * (k % 97), ("a", "b", "é", "Z")[(k > 1800) + (k > 2500) + (k > 2900)]) for k in range(3000)]
    rows += [(5000, "w " * 60_000, "a"), (5001, None, "a"), (5002, "", None), (5003, "x y", None), (None, "p q r", "b")]
    rows += [(7, "w " * 7, "a")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(-1))
    mixture = mixing.mix(docs, (3, 1, 2), 1.5)
    found = mixture.taken.toPandas()
    assert len(found) == len(rows)
    assert (found.taken <= 2 * found["size"]).all() and (found.taken >= 0).all()
    for _, part in found.groupby("source", dropna=False):
        total = part["size"].sum()
        assert part.source_size.iloc[0] == total and part.target.iloc[0] <= 2 * total + 1e-6
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 64 * 6
    assert abs(found.groupby("source", dropna=False).target.first().sum() - 1.5 * found["size"].sum()) < 1e-3
    again = mixing.mix(docs.repartition(5), (3, 1, 2), 1.5).taken.toPandas()
    key = ["row_hash", "taken"]
    assert sorted(map(tuple, found[key].values.tolist())) == sorted(map(tuple, again[key].values.tolist()))
    copies = mixing.repeated(docs, mixture)
    assert copies.columns == docs.columns
    sizes = copies.select(mixing.token_count(F.col("text")).alias("n")).toPandas().n.sum()
    assert abs(sizes - found.taken.sum()) < 0.05 * found.taken.sum()


def test_schedule_against_a_plain_loop(spark):
    rows = [(k, "w " * (1 + k % 13), "abc"[k % 7 % 3]) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixture = mixing.mix(docs, (3, 1, 2), 1.5)
    found = mixture.taken.toPandas()
    sizes = found.groupby("source")["size"].sum()
    targets = found.groupby("source").target.first()
    per_block = {s: max(1, min(64, n // mixing.LEAST_BLOCKS)) for s, n in sizes.items()}
    n_blocks = {s: -(-n // per_block[s]) for s, n in sizes.items()}
    slots = [targets[s] * n_blocks[s] / sizes[s] for s in "abc"]
    edges, taken, plan = np.cumsum(slots) / sum(slots), dict.fromkeys("abc", 0), []
    for slot in range(round(sum(slots))):
        point = float((slot + 1) * 0x9E3779B97F4A7C15 % 2**64) / 2.0**64
        source = "abc"[min(int(np.searchsorted(edges, point, "right")), 2)]
        if taken[source] < 2 * n_blocks[source]:
            plan.append((slot, "abc".index(source), taken[source] % n_blocks[source]))
        taken[source] += 1
    assert sorted(map(tuple, mixture.schedule.select("slot", "source_no", "block").collect())) == plan
    assert (abs(found.groupby("source").taken.sum() - targets) <= 64).all()


def test_small_sources_come_near_their_targets(spark):
    rows = [(k, "w " * 50, "big") for k in range(500)] + [(900 + k, "a b c d e", "tiny") for k in range(4)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), (1, 3), 1.5).taken.toPandas()
    tiny = found[found.source == "tiny"]
    assert tiny.target.iloc[0] == 40 and abs(tiny.taken.sum() - 40) <= 4


def test_repeated_rows_appear_as_often_as_they_are_drawn(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 2)
    rows = [(1, "w " * 40, "a")] * 5 + [(2, "x y", "a")] * 3 + [(3, "z", "b"), (4, None, "b"), (4, None, "b"), (None, "q r", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("mine") for c in ("key", "times", "row", "copy", "each")})
    draws = [264, 264, 264, 264, 264 - 5]
    mixture = mixing.mix(docs, (3, 1, 2), 1.5)
    hashed = {r.doc_id: r.row_hash for r in mixture.taken.collect()}
    told = [(hashed[1], 40, t) for t in draws] + [(hashed[2], 2, 0), (hashed[2], 2, 1), (hashed[2], 2, 0), (hashed[3], 1, 2)]
    told += [(hashed[4], 0, 0)] * 2 + [(hashed[None], 2, 4)]
    taken = spark.createDataFrame(told, "row_hash long, size long, taken long")
    copies = mixing.repeated(docs, mixing.Mixture(taken, mixture.schedule))
    n = {k: copies.where(F.col("doc_id").eqNullSafe(F.lit(k))).count() for k in (1, 2, 3, 4, None)}
    chance = lambda k: taken.where(f"row_hash = {hashed[k]}").select((F.pmod(F.xxhash64("row_hash", F.lit(2)), F.lit(1 << 20)) / F.lit(float(1 << 20)))).head()[0]
    assert n[1] == sum(int(t / 40 + chance(1)) for t in draws) and n[2] == sum(int(t / 2 + chance(2)) for t in (0, 1, 0))
    assert n[1] >= 30 and (n[3], n[4], n[None]) == (2, 2, 2) and copies.columns == docs.columns


def test_nothing_to_mix(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    mixture = mixing.mix(docs, (3, 1, 2), 1.5)
    assert mixture.taken.count() == 0 and mixing.repeated(docs, mixture).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], docs.schema)
    assert [r.taken for r in mixing.mix(blank, (3, 1, 2), 1.5).taken.collect()] == [0, 0]
    assert mixing.repeated(blank, mixing.mix(blank, (3, 1, 2), 1.5)).count() == 2
