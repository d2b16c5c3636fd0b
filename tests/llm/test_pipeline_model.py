"""The pipeline, stage by stage, against plain loops over the same documents."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_line_chunks import plain_dedup
from test_simhash import groups, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from slugline.llm import langid, mixing
from slugline.llm.common import written
from slugline.llm.queries import SHARE, WEIGHTS

KEPT = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark, small):
    """The smallest table with copies, near copies, passages that repeat, and texts without a language."""
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select(*KEPT).collect()]
    passage = "\n".join(f"passage line {k} " + " ".join(f"word{k}x{j}" for j in range(9)) for k in range(8))
    more = []
    for k, (_, text, lang, source, _) in enumerate(docs[:60]):
        words = (text or "").split(" ")
        if k % 3 == 0:
            more.append((text, lang, source))
        elif k % 3 == 1:
            words[len(words) // 2] = "changed"
            more.append((" ".join(words), lang, "elsewhere"))
        else:
            more.append((f"{text}\n{passage}\nend {k}", lang, source))
    more += [(None, "en", None), ("", "de", "web"), ("12 34 --", "en", "web"), ("?", None, None), ("½", "fr", "web")]
    last = max(r[0] for r in docs)
    rows = docs + [(last + 1 + k, t, lang, source, len(t or "")) for k, (t, lang, source) in enumerate(more)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), passage


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select(*KEPT).collect()), key=lambda r: r[0])


def test_every_stage_against_a_plain_version(spark, small, tmp_path):
    made, passage = planted(spark, small)
    made.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def step(name, frame):
        return written(stages[name](spark, frame, str(tmp_path)), f"model_{name}")

    # Language: what the fitted model does not reject stays, as it is.
    model = langid.fit_languages(docs)
    told = step("language", docs)
    before, after = rows_of(docs), rows_of(told)
    assert after == [r for r in before if not model.predict(r[1])[2]]
    assert len(before) - 8 <= len(after) <= len(before) - 5

    # Lines: the chunks a plain loop removes, n_chars with them.
    cut = step("repeated_lines", told)
    texts = {d: t for d, t, _ in plain_dedup([(r[0], r[1]) for r in after])}
    want = [(d, texts[d], lang, source, len(texts[d])) for d, _, lang, source, _ in after]
    after = rows_of(cut)
    assert after == want and sum(passage in r[1] for r in after) == 1

    # Near copies: the smallest id of each component of fingerprints three bits apart.
    apart = step("near_copies", cut)
    prints = {r[0]: plain_fingerprint(r[1], 3) for r in after}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    whole = groups(ids, links)
    want = [r for r in after if whole[r[0]] == r[0]]
    after = rows_of(apart)
    assert after == want and len(links) >= 15

    # Mixing: targets by hand, and each document as often as its taken share says, rounded either way.
    mixed = step("mixed_sources", apart)
    sizes = Counter()
    for _, text, _, source, _ in after:
        sizes[source] += len([w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [WEIGHTS[k % 3] for k in range(len(names))]
    budget, targets, open_ = SHARE * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        each = {s: budget * w / sum(v for n, v in zip(names, weights) if n in open_) for s, w in zip(names, weights) if s in open_}
        over = {s for s in open_ if each[s] >= 2 * sizes[s]}
        for s in over or open_:
            targets[s] = float(2 * sizes[s]) if over else each[s]
        budget -= sum(targets[s] for s in over)
        open_ = open_ - over if over else set()
    taken = {r.doc_id: r for r in mixing.mix(apart, WEIGHTS, SHARE).taken.collect()}
    assert all(abs(r.target - targets[r.source]) < 1e-6 for r in taken.values())
    times = Counter(r[0] for r in rows_of(mixed))
    for r in taken.values():
        share = r.taken / r["size"] if r["size"] else 1
        assert math.floor(share) <= times[r.doc_id] <= math.ceil(share)
    by_id = {r[0]: r for r in after}
    assert all(r == by_id[r[0]] for r in rows_of(mixed))

    # Packing: every id of every copy in one piece, sequences full from their start.
    packed = stages["packed"](spark, mixed, str(tmp_path)).toPandas()
    whole_ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, n in times.items():
        length = len(whole_ids.encode(by_id[doc_id][1], add_special_tokens=False).ids) + 1
        pieces = packed[packed.doc_id == doc_id]
        covered = np.zeros(length, int)
        for start, size in zip(pieces.start, pieces.length, strict=True):
            covered[start : start + size] += 1
        assert (covered == n).all() and (pieces.doc_tokens == length).all()
    assert set(packed.doc_id) == set(times)
    for _, held in packed.sort_values("offset").groupby("sequence_id"):
        assert held.offset.tolist() == [0, *held.length.cumsum()[:-1]] and held.length.sum() <= 2048

    # The whole run gives the same pieces.
    again = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in again} == packed.groupby("doc_id").length.sum().to_dict()
