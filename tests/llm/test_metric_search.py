"""Exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slugline.llm import metric_search as M


def brute(rows, asked, k):
    told = []
    for q, qv in {q: v for q, v in asked}.items():
        scores = [(-int(np.dot(qv, v)), i) for i, v in rows if i != q and len(v) == len(qv)]
        told += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(told)


@pytest.mark.parametrize("clustered", [False, True])
def test_against_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(M, "TREE_ROWS", 100)
    monkeypatch.setattr(M, "QUERIES_IN_GROUP", 16)
    monkeypatch.setattr(M, "TREES_IN_GROUP", 3)
    monkeypatch.setattr(M, "ROOT_BYTES", 6000)
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(5)
    vectors = rng.integers(-9, 10, (900, 6))
    if clustered:
        vectors = vectors[rng.integers(0, 8, 900)] * 20 + rng.integers(-2, 3, (900, 6))
    vectors[300:600] = vectors[0]  # copies and ties
    rows = [(k, [int(x) for x in v]) for k, v in enumerate(vectors)] + [(950, [1, 2]), (951, [3, -1]), (952, [5])]
    frame = spark.createDataFrame([*rows, (960, None), (None, [1] * 6), (961, [])], "vec_id long, v array<long>")
    asked = [r for r in rows if r[0] % 40 == 0 or r[0] > 949]
    found = M.top_products(frame, frame.where("vec_id % 40 = 0 OR vec_id > 949"), k=7)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, asked, 7)


def test_triangle_inequality_saves_distances():
    rng = np.random.default_rng(1)
    vectors = (rng.integers(-100, 100, (40, 4))[rng.integers(0, 40, 3000)] * 50 + rng.integers(-3, 4, (3000, 4))).astype(np.int64)
    most = int((vectors**2).sum(axis=1).max())
    nodes = M.tree_nodes(np.arange(3000), vectors, most, seed=1)
    for node in nodes:
        node["matrix"] = np.frombuffer(node["vectors"], np.int64).reshape(len(node["ids"]), 4)
    queries = vectors[:50]
    best = M.Best.of(50, 5, np.full(50, np.iinfo(np.int64).min))
    computed = M.search_tree(nodes, queries, np.arange(50), most, best)
    scores = queries @ vectors.T
    scores[np.arange(50), np.arange(50)] = np.iinfo(np.int64).min
    assert (best.scores == np.sort(scores, axis=1)[:, ::-1][:, :5]).all()
    assert computed < 50 * 3000 / 3


@pytest.mark.parametrize("root_bytes", [M.ROOT_BYTES, 200])
def test_queries_reach_few_trees_of_clustered_rows(spark, root_bytes):
    """Groups that are passed over hold no row that reaches the floor, and on clustered data most are."""
    rng = np.random.default_rng(8)
    middles = rng.integers(-2000, 2000, (30, 5))
    parts = [middles[k] + rng.integers(-5, 6, (40, 5)) for k in range(30)]
    most = int(max((p**2).sum(axis=1).max() for p in parts))
    roots = []
    for k, part in enumerate(parts):
        root = M.tree_nodes(np.arange(40), part, most, seed=k)[0]
        roots.append((5, k // 2, [float(x) for x in root["center"]], root["radius"]))
    frame = spark.createDataFrame(roots, "dims int, trees_no long, center array<double>, radius double").withColumn("v", F.lit(1))
    every = np.vstack(parts)
    rows = []
    for q in range(0, len(every), 15):
        rows.append((q, [int(x) for x in every[q]], 5, int(np.sort(every @ every[q])[-10])))
    rows += [(5000, [1] * 5, 5, int(np.iinfo(np.int64).min)), (5001, [3, 4], 2, 0)]
    queries = spark.createDataFrame(rows, "query_id long, v array<long>, dims int, floor long")
    met = {(r.query_id, r.trees_no) for r in M.reachable(queries, frame, {5: most, 2: 25}, root_bytes).collect()}
    for q, v, d, floor in rows[:-2]:
        for group in range(15):
            if (np.vstack(parts[2 * group : 2 * group + 2]) @ np.array(v)).max() >= floor:
                assert (q, group) in met
    assert sum(q == 5000 for q, _ in met) == 15 and not any(q == 5001 for q, _ in met)
    assert len(met) - 15 < len(rows) * 15 / 3
    assert M.reachable(queries, frame.limit(0), {5: most}).count() == 0


def test_other_columns_of_any_name(spark):
    rows = spark.createDataFrame([(k, [k % 5, -k]) for k in range(30)], "vec_id long, v array<long>")
    plain = sorted(tuple(r) for r in M.top_products(rows, rows.where("vec_id < 4"), k=3).collect())
    names = ["query_id", "dims", "square", "cell", "tree", "trees", "first", "floor", "rank", "score", "block", "blocks", "trees_no"]
    odd = rows.withColumns({n: F.lit("mine") for n in names})
    assert sorted(tuple(r) for r in M.top_products(odd, odd.where("vec_id < 4"), k=3).collect()) == plain


def test_scaling_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.01]), (2, [nan, 1.0]), (3, [1.0, None]), (4, None), (5, [inf, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", M.scaled("e", 64).alias("v"))
    assert [r.v for r in frame.orderBy("vec_id").collect()] == [[32, -1], None, None, None, None]
    assert M.top_products(frame, frame).count() == 0
    assert M.top_products(frame.limit(0), frame.limit(0)).count() == 0
    assert M.top_products(frame.withColumn("vec_id", F.col("vec_id") + 1), frame.limit(0)).count() == 0
