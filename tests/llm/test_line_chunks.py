"""Line dedup against a plain loop."""

import hashlib
import random

from pyspark.sql import functions as F

from slugline.llm import line_chunks as L


def plain_chunks(text, long_words, one_in):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    words = [len([w for w in x.replace("\t", " ").split(" ") if w]) for x in lines]
    chunks, start = [], 0
    for i in range(len(lines)):
        rolled = (hashes[i] + (hashes[i - 1] if i else 0) * L.WEIGHT) % one_in == 0
        following = words[i + 1] if i + 1 < len(lines) else 0
        if i == len(lines) - 1 or rolled or words[i] >= long_words or following >= long_words:
            total = sum(words[start : i + 1])
            if total >= long_words or (i > start and total > 0):
                chunks.append((start, i, "\n".join(lines[start : i + 1])))
            start = i + 1
    for i in range(len(lines)):
        total, stop = words[i], i
        while total < long_words and stop + 1 < len(lines):
            stop += 1
            total += words[stop]
        if words[i] and total >= long_words and max(words[i : stop + 1]) < long_words:
            chunks.append((i, stop, "\n".join(lines[i : stop + 1])))
    return chunks


def plain_dedup(rows, long_words=50, one_in=2):
    first = {}
    cut = {(d, t): plain_chunks(t, long_words, one_in) for d, t in rows if t is not None}
    for (d, _), chunks in cut.items():
        for start, _, chunk in chunks:
            place = (d is not None, d or 0, start)
            if chunk not in first or place < first[chunk]:
                first[chunk] = place
    told = []
    for d, t in rows:
        if t is None:
            told.append((d, None, 0))
            continue
        gone = set()
        for start, stop, chunk in cut[d, t]:
            if first[chunk] != (d is not None, d or 0, start):
                gone.update(range(start, stop + 1))
        stay = [line for i, line in enumerate(t.split("\n")) if i not in gone]
        told.append((d, "\n".join(stay), len(gone)))
    return told


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "", r[2]))


def test_against_a_plain_loop(spark):
    source = random.Random(9)
    lines = [" ".join(source.choices("abcdefgh", k=source.randrange(5))) for _ in range(40)] + ["w " * 55 + str(k) for k in range(3)]
    passage = [f"line {k} of a passage" for k in range(12)]
    rows = []
    for k in range(120):
        body = source.choices(lines, k=source.randrange(12))
        rows.append((k, "\n".join(body + passage * (k % 3 == 0) + source.choices(lines, k=2))))
    rows += [(500, None), (501, ""), (502, "\n\n\n"), (503, "x" * 300_000), (None, "\n".join(passage)), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lost", F.lit(1)).withColumn("key", F.lit(2))
    found = [(r.row.doc_id, r.text, r.n_removed) for r in L.remove_repeated_chunks(docs).collect()]
    assert order(found) == order(plain_dedup(rows))
    assert sum(n for _, _, n in found) > 100


def test_long_passages_go_wherever_they_stand(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(k, f"start {k} one\n{passage}\nend {k}") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.row.doc_id: r.text for r in L.remove_repeated_chunks(docs).collect()}
    assert passage in found[0] and not any(passage in found[k] for k in range(1, 5))
    assert all(f"end {k}" in found[k] and f"start {k} one" in found[k] for k in range(5))


def test_passages_of_short_lines_go_wherever_they_stand(spark):
    passages = [[f"p{p} line {k} " + "w " * size for k in range(n)] for p, (n, size) in enumerate([(2, 23), (3, 15), (9, 4)])]
    rows = []
    for k in range(30):
        rows.append((k, "\n".join([f"start {k}", *passages[k % 3], f"end {k} one", f"end {k} two"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.row.doc_id: r.text for r in L.remove_repeated_chunks(docs).collect()}
    for k in range(30):
        assert all(line in found[k] for line in (f"start {k}", f"end {k} one", f"end {k} two"))
        left = sum(line in found[k].split("\n") for line in passages[k % 3])
        assert left == (len(passages[k % 3]) if k < 3 else 0), k


def test_every_line_stays_somewhere(spark):
    source = random.Random(4)
    lines = [f"line {k} " + "w " * source.randrange(30) for k in range(12)]
    rows = [(k, "\n".join(source.choices(lines, k=source.randrange(1, 12)))) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = L.remove_repeated_chunks(docs).collect()
    assert {x for _, t in rows for x in t.split("\n")} == {x for r in found for x in r.text.split("\n") if x}


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert L.remove_repeated_chunks(docs).count() == 0


def test_no_python_on_the_way(spark, small):
    plan = L.remove_repeated_chunks(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_equal_or_null_ids_but_other_texts_are_other_documents(spark):
    passage = " ".join(f"word{k}" for k in range(60))
    rows = [(None, f"{passage}\nend {k}") for k in range(4)] + [(7, f"{passage}\nend {k}") for k in range(4, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.text, r.n_removed) for r in L.remove_repeated_chunks(docs).collect()]
    assert sorted(n for _, n in found) == [0] + [1] * 7 and sum(passage in text for text, _ in found) == 1
    assert all(any(f"end {k}" in text for text, _ in found) for k in range(8))
