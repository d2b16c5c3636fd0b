"""Packing: first-fit decreasing against a plain loop, and an exact round trip of the ids."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slugline.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_first_fit_decreasing(lengths):
    room, bins, offsets = [], {}, {}
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = next((k for k, r in enumerate(room) if r >= lengths[item]), len(room))
        room += [20] * (at == len(room))
        bins[item], offsets[item] = at, 20 - room[at]
        room[at] -= lengths[item]
    found = packing.first_fit_decreasing(np.array(lengths), 20)
    assert found[0].tolist() == [bins[k] for k in range(len(lengths))]
    assert found[1].tolist() == [offsets[k] for k in range(len(lengths))]


def texts():
    source = random.Random(3)
    odd = ["<|endoftext|>", "it's", "x y", "é", "́", "12 34", "\x1c", " ", "日本", "!?..", "ÉÀ", "\x85", "a\x0bb"]
    return [None, "", " \n ", *("".join(source.choices([*odd, " ", "\n", "\t ", "word"], k=n)) for n in (5, 40, 900, 3000))]


def test_word_by_word_gives_the_tokenizer_s_ids():
    whole, tokens = Tokenizer.from_file(FILE), packing.WordTokens(FILE)
    for text in texts():
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(tokens.ids(text or ""), "<u4").tolist() == want


def test_plain_texts_are_the_model_s_alone(monkeypatch):
    """Letters with accents, digits and runs of marks: each unit is asked for once, whatever stands around it."""

    class NoWords:
        def encode_batch_fast(self, words, add_special_tokens):
            assert not list(words)
            return []

    source, whole, tokens = random.Random(5), Tokenizer.from_file(FILE), packing.WordTokens(FILE)
    monkeypatch.setattr(tokens, "tokenizer", NoWords())
    signs = [c for c in map(chr, range(32, 256)) if packing.PLAIN.fullmatch(c)]
    assert set("AÀÖØÞßàöøÿz09 !'|~") <= set(signs) and not set("<ªµº×÷\xa0") & set(signs)
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    for size in (1, 7, 60, 2000):
        text = "".join(source.choices([*signs, *"'' \t\n", "'s", "'LL", "Élan!!", "straße,", "l'été"], k=size))
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(tokens.units) <= 50


def test_long_texts_are_cut_at_blanks(monkeypatch):
    whole, tokens = Tokenizer.from_file(FILE), packing.WordTokens(FILE)
    monkeypatch.setattr(packing, "CHARS_AT_ONCE", 16)
    for text in texts()[3:]:
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(spark):
    rows = [*enumerate(texts()), (3, texts()[3]), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("group", F.lit("x"))
    found = packing.pack(docs, FILE, capacity=128, group_rows=4).toPandas()
    whole = Tokenizer.from_file(FILE)
    for doc_id, text in enumerate(texts()):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        mine = found[found.doc_id == doc_id].sort_values("start")
        if doc_id == 3:
            mine = mine.drop_duplicates("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        for piece in mine.itertuples():
            part = np.array(ids[piece.start : piece.start + piece.length], "<u4")
            assert len(part) == piece.length and zlib.crc32(part.tobytes()) == piece.ids_crc32
    for _, pieces in found.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        ends = pieces.length.cumsum()
        assert pieces.offset.tolist() == [0, *ends[:-1]] and ends.iloc[-1] <= 128
        used = int(ends.iloc[-1])
        assert (pieces.padding == (0 if used & (used - 1) == 0 else 128 - used)).all()
    assert packing.pack(docs.limit(0), FILE).count() == 0
