"""Spelling variants against a plain search for every edit."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from slugline.llm import spelling as S

ALPHABET = [chr(code) for code in S.LETTERS]


def plain_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = crc % len(run)
            counts[run[:at] + run[at + 1 :] if crc % 97 == 0 else run] += 1
    return counts


def plain_variants(n):
    near = {}
    for word in n:
        edits = {word[:k] + word[k + 1 :] for k in range(len(word))}
        edits |= {word[:k] + c + word[k + cut :] for k in range(len(word) + 1) for c in ALPHABET for cut in (0, 1)}
        near[word] = [w for w in edits if w in n and w != word]
    form = {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    root = {}
    for word in n:
        root[word] = word
        while form[root[word]]:
            root[word] = form[root[word]]
    return {w: (n[w], form[w], n[form[w]] if form[w] else None, len(near[w]), root[w]) for w in n}


def vocabulary(seed, size):
    source = random.Random(seed)
    syllables = ["le", "aux", "re", "mé", "an", "on", "ti", "x", "eu", "ÿ", "×"]
    return {"".join(source.choices(syllables, k=source.randint(1, 4))): source.randint(1, 60) for _ in range(size)}


def found(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    return {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in S.spelling_variants(words).collect()}


def test_words_of_odd_texts(spark):
    docs = [(1, "Naïve naïve NAÏVE\nÀb×c÷d"), (2, None), (3, ""), (None, "word wörd ẞ ſ word"), (4, "x1y_z"), (5, "Ab " * 3000), (1, "Naïve")]
    docs += [(k, f"planted words {k} of many kinds") for k in range(200)] + [(9, "q" * 200_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.word: r.n for r in S.word_counts(frame).collect()} == plain_counts(docs)
    assert S.word_counts(frame.limit(0)).count() == 0
    clashing = frame.selectExpr("*", "1 AS word", "2 AS n", "3 AS run", "4 AS crc")
    assert S.word_counts(clashing).count() == len(plain_counts(docs))


def test_variants_in_one_cell_and_in_many(spark, monkeypatch):
    n = vocabulary(1, 2500)
    # Words of the same letters, which no border parts, and a chain of forms.
    n |= {"".join(w): 5 for w in ("abcde", "abced", "abdce", "acbde", "bacde", "edcba", "abcdee", "abcd")}
    n |= {"chain": 3, "chains": 6, "chainss": 12, "chainsss": 100, "zhain": 6}
    want = plain_variants(n)
    assert found(spark, n) == want and want["chain"][4] == "chainsss"
    for name, value in (("CELL_WORDS", 40), ("QUERIES_AT_ONCE", 60), ("LEAF_WORDS", 5), ("SAMPLE", 1000)):
        monkeypatch.setattr(S, name, value)
    assert found(spark, n) == want


def test_many_words_of_the_same_letters(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL_WORDS", 25)
    source = random.Random(4)
    n = {}
    while len(n) < 150:
        n["".join(source.sample("abcdef", 6))] = len(n) + 1
    n |= {word[:-1]: 1 for word in list(n)[:40]}
    assert found(spark, n) == plain_variants(n)


def test_very_long_words_ties_and_none(spark):
    long = "ab" * 3000
    n = {long: 1, long + "c": 2, long[:-1] + "x": 2, "tie": 1, "tia": 2, "tib": 2, "": 4}
    want = plain_variants({w: c for w, c in n.items() if len(w) < 10})
    got = found(spark, n)
    assert {w: got[w] for w in want} == want and got["tie"][1] == "tia"
    assert got[long] == (1, long[:-1] + "x" if long[:-1] + "x" < long + "c" else long + "c", 2, 2, got[long][1])
    assert found(spark, {"alone": 1}) == {"alone": (1, None, None, 0, "alone")}
    assert S.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_boxes_prune_and_lose_nothing():
    words = [w for w in vocabulary(7, 4000) if len(w) == 6]
    counts = S.letter_counts(S.codes_of(words)).astype(int)
    apart = np.abs(counts[:, None] - counts[None]).sum(axis=2)
    for budget in (1, 2):
        pairs = [p for a, b in S.box_search(counts.astype(np.int16), counts.astype(np.int16), budget) for p in zip(a, b, strict=True)]
        assert sorted(pairs) == sorted(zip(*np.nonzero(apart <= budget), strict=True))
        tree = S.borders_of(counts, 16)
        own = {cell: set(rows) for cell, rows in S.routed(tree, counts, 0)}
        assert sum(map(len, own.values())) == len(words) and len(own) > 4
        asked = {cell: set(rows) for cell, rows in S.routed(tree, counts, budget)}
        assert all(a in asked[cell] for cell, rows in own.items() for b in rows for a in np.flatnonzero(apart[b] <= budget))
        assert sum(map(len, asked.values())) < len(own) * len(words)
