"""Context-tree weighting against plain recursion."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from slugline.llm import context_tree as C

TEXTS = [
    (0, "The cat. the cat sat", True), (1, "the dog sat\n", True), (2, "the cats sat", False), (3, None, True),
    (4, "", False), (5, "zzz é", False), (1, "the dog sat\n", True), (None, "a  b", False),
]


def plain_scores():
    grams = {k: [g for t in [C.lower_bytes(text)] for b in [b"\0" * C.DEPTH + t + b"\0"] for g in zip(*(b[i:] for i in range(C.DEPTH + 1)))] for k, (_, text, _) in enumerate(TEXTS)}
    counts = {}
    for k, (_, _, learn) in enumerate(TEXTS):
        for gram in grams[k] if learn else ():
            for step in range(8):
                prefix, bit = (256 | gram[-1]) >> (8 - step), gram[-1] >> (7 - step) & 1
                for depth in range(C.DEPTH + 1):
                    counts.setdefault((gram[C.DEPTH - depth : -1], prefix), [0, 0])[bit] += 1

    def kt(pair):
        a, b = pair
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    children = {}
    for context, prefix in counts:
        if context:
            children.setdefault((context[1:], prefix), []).append((context, prefix))

    def weighted(node):
        if len(node[0]) == C.DEPTH:
            return kt(counts[node])
        return math.log(0.5) + np.logaddexp(kt(counts[node]), sum(map(weighted, children.get(node, []))))

    def chance(gram, step):
        prefix, bit = (256 | gram[-1]) >> (8 - step), gram[-1] >> (7 - step) & 1
        below = None
        for depth in range(C.DEPTH, -1, -1):
            node = (gram[C.DEPTH - depth : -1], prefix)
            if node not in counts:
                own = 0.5
            else:
                own = (counts[node][bit] + 0.5) / (sum(counts[node]) + 1)
            if below is not None:
                share = math.exp(math.log(0.5) + kt(counts[node]) - weighted(node))
                own = share * own + (1 - share) * below
            below = own if node in counts else None
            last = own
        return last

    return [sum(math.log10(chance(g, s)) for g in grams[k] for s in range(8)) for k in range(len(TEXTS))]


@pytest.mark.parametrize(("entries", "share"), [(2_000_000, 1), (7, 1 << 40), (0, 20)])
def test_scores(spark, monkeypatch, entries, share):
    monkeypatch.setattr(C, "TABLE_ENTRIES", entries)
    monkeypatch.setattr(C, "HOT_SHARE", share)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, learn boolean")
    docs = docs.selectExpr("*", "'x' AS row_no", "1 AS words", "2 AS n_bytes", "3 AS score", "4 AS known")
    found = C.score_texts(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = sorted(zip((t[0] for t in TEXTS), plain_scores(), strict=True), key=key)
    got = sorted(((r.doc_id, r.score) for r in found), key=key)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-9)
    words = [re.findall(r"[^\x20\x09-\x0D]+", C.lower_bytes(t).decode()) + ["\n"] for _, t, _ in TEXTS]
    c = Counter(w for ws, (_, _, learn) in zip(words, TEXTS, strict=True) if learn for w in ws)
    total, distinct = sum(c.values()), len(c)
    base = [sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in ws) for ws in words]
    rows = sorted(zip((t[0] for t in TEXTS), base, words, strict=True), key=key)
    for row, (_, score, ws) in zip(sorted(found, key=lambda r: key(r)), rows, strict=True):
        assert math.isclose(row.base_score, score, rel_tol=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), total)


def test_bytes_share_one(spark):
    grams = np.array([int.from_bytes(b"abcde" + bytes([s]), "big") for s in range(256)])
    counts = np.where(grams & 255 == ord("f"), 9, np.where(grams & 255 == ord("g"), 2, 0))
    levels = C.subtree(grams, counts, C.TOP)
    levels[1] = levels[2].shorter(1)
    levels[0] = levels[1].shorter(0)
    assert math.isclose((10 ** C.log10_predictions(grams, levels)).sum(), 1, rel_tol=1e-9)


def test_long_texts_and_empty_tables(spark, monkeypatch):
    texts = [b"ab cd" * 30, b"", b"x" * 70, b"y"]
    whole = [np.concatenate([g[o == k] for g, o in C.gram_blocks(texts)]).tolist() for k in range(4)]
    monkeypatch.setattr(C, "BLOCK_BYTES", 11)
    assert [np.concatenate([g[o == k] for g, o in C.gram_blocks(texts)]).tolist() for k in range(4)] == whole
    assert [len(w) for w in whole] == [len(t) + 1 for t in texts]
    none = spark.createDataFrame([], "doc_id long, text string, learn boolean")
    assert C.score_texts(none).count() == 0
    untaught = spark.createDataFrame([(1, "ab", False)], none.schema)
    (row,) = C.score_texts(untaught).collect()
    assert math.isclose(row.score, 24 * math.log10(0.5)) and row.train_tokens == row.n_known == 0
