"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slugline.llm import embedding_links as E


def brute(rows, least):
    def fine(v):
        return v is not None and None not in v and np.isfinite(v).all() and any(v)

    able = [(i, np.float32(v).astype(float), label) for i, v, label in rows if label is not None and fine(v)]
    links = {i: set() for i, *_ in rows}
    for a, va, la in able:
        for b, vb, lb in able:
            if a < b and la == lb and len(va) == len(vb) and va @ vb / (np.linalg.norm(va) * np.linalg.norm(vb)) >= least:
                links[a].add(b)
                links[b].add(a)
    name = {i: i for i in links}
    for _ in links:
        changed = False
        for i, others in links.items():
            low = min([name[i], *(name[o] for o in others)])
            changed |= low != name[i]
            name[i] = low
        if not changed:
            break
    return sorted((i, len(links[i]), name[i], name[i] == i) for i in links)


@pytest.mark.parametrize("block_rows", [512, 8])
def test_against_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(E, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(25):
        center, label = rng.normal(size=16), int(rng.integers(0, 3))
        rows += [(center + rng.normal(size=16) * rng.choice([0.01, 0.1]), label) for _ in range(12)]
        rows += [(center, label)] * 3
    rows = [(k, [float(x) for x in v], label) for k, (v, label) in enumerate(rows)]
    nan = float("nan")
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [nan] * 16, 1), (903, [None] * 16, 1), (904, rows[0][1], None), (905, [1.0, 2.0], 1), (906, [2.0, 4.0], 1), (907, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("class", F.lit(1))
    found = sorted(tuple(r) for r in E.embedding_links(frame, 0.93).collect())
    want = brute(rows, 0.93)
    pairs = sum(w[1] for w in want)
    assert sum(f[1] for f in found) >= 0.97 * pairs and all(f[1] <= w[1] for f, w in zip(found, want, strict=True))
    assert sum(f == w for f, w in zip(found, want, strict=True)) >= 0.9 * len(want)


@pytest.mark.parametrize("n", [1, 10**5, 10**7, 10**9])
def test_recall_at_the_threshold(n):
    tables, bits = E.hash_shape(n, 0.93)
    assert (tables, bits) == (20, 10) if n == 1 else bits >= np.log2(n / E.BUCKET_ROWS) - 1
    rng = np.random.default_rng(5)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    off = rng.normal(size=(3000, 64))
    off -= (off * a).sum(axis=1, keepdims=True) * a
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * off
    same = (E.signatures(a, 11, tables, bits) == E.signatures(b, 11, tables, bits)).any(axis=1)
    assert same.mean() > 0.99
    # Unrelated vectors rarely meet: as often as buckets of about BUCKET_ROWS of n say.
    unrelated = (E.signatures(a, 11, tables, bits) == E.signatures(off[::-1], 11, tables, bits)).mean()
    assert unrelated <= 4 * max(1 / 2**E.LEAST_BITS, E.BUCKET_ROWS / n)


def test_ids_repeat_or_lack(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted(map(str, (tuple(r) for r in E.embedding_links(frame).collect())))
    assert found == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, True), (None, 0, None, True)]))
    assert E.embedding_links(frame.limit(0)).count() == 0
