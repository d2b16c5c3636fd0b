"""Packing documents into training sequences: first-fit decreasing in random groups."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from slugline.llm.common import written

END_ID = 1
GROUP_ROWS = 16384
CACHED_WORDS = 400_000
CHARS_AT_ONCE = 1 << 20
BLANKS = re.compile("[ \t\n\r]")

# Texts of these signs alone stay as they are when normalised, but for case, and hold no special token (`<`).
# There the tokenizer's own pattern cuts units out of the lower-cased text, and a unit is the model's alone.
LETTERS, MARKS = "a-zß-öø-ÿ", r"!-/:;=-@\[-`{-~"
PLAIN = re.compile(rf"[ \t\n\r0-9A-ZÀ-ÖØ-Þ{LETTERS}{MARKS}]*")
UNITS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[{MARKS}]+")
# The model reads bytes as signs: these stand for themselves, the others for those from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = dict(zip([b for b in range(256) if b not in SHOWN], range(256, 512), strict=False))


class _UnitIds(dict[str, bytes]):
    """Ids by unit, asked of the model when a unit is first looked up."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        signs = unit if unit.isascii() else unit.encode().decode("latin-1").translate(BYTE_SIGNS)
        ids = [token.id for token in self.model.tokenize(signs)]
        self[unit] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class WordTokens:
    """Ids of texts by units, or by words where a text holds other signs than `PLAIN` ones.

    The tokenizer never looks across a blank, so a unit's or a word's ids are reused. A cache is
    emptied when it holds `CACHED_WORDS` entries, which bounds its memory.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.units = _UnitIds(self.tokenizer.model)
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        if len(text) <= CHARS_AT_ONCE:
            return self._some(text)
        parts, start = [], 0
        while start < len(text):
            blank = BLANKS.search(text, start + CHARS_AT_ONCE)
            end = blank.start() if blank else len(text)
            parts.append(self._some(text[start:end]))
            start = end
        return b"".join(parts)

    def _some(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            return self._plain(text)
        known = self.known
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = list(map(known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            fresh = list({words[k] for k in missing})
            if len(known) + len(fresh) > CACHED_WORDS:
                known.clear()
            told = self._fresh(fresh)
            known.update(told)
            for k in missing:
                found[k] = told[words[k]]
        return b"".join(found)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, UNITS.findall(text.lower())))

    def _fresh(self, words: list[str]) -> dict[str, bytes]:
        told = {word: self._plain(word) for word in words if PLAIN.fullmatch(word)}
        rest = [word for word in words if word not in told]
        for word, encoded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            told[word] = np.array(encoded.ids, "<u4").tobytes()
        return told


@lru_cache(maxsize=1)
def word_tokens(tokenizer_file: str) -> WordTokens:
    """One for all tasks of a worker process, so that later ones find the units of earlier ones."""
    return WordTokens(tokenizer_file)


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document cut every `capacity` ids.

    A document ends with one end id of its own, so a null or empty text is one piece of length 1.
    The ids themselves stay in the task.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long"
    end = np.array([END_ID], "<u4").tobytes()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = word_tokens(tokenizer_file)
        for batch in batches:
            owner, rows = [], []
            for k, text in enumerate(batch.column(1)):
                ids = tokens.ids(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    owner.append(k)
                    rows.append((start, len(part) // 4, zlib.crc32(part), total))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 4
            named = [batch.column(0).take(pa.array(owner, pa.int64())), *columns]
            yield pa.RecordBatch.from_arrays(named, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(per_batch, schema)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length: the longest first, each into the first bin with room.

    A tournament tree holds the room of every bin, the larger of two children in their parent;
    the way down that turns left whenever there is room enough on the left ends at the first bin.
    Equal lengths go in the order given.
    """
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - room[node]
        room[node] -= need
        node //= 2
        while node:
            largest = max(room[2 * node], room[2 * node + 1])
            if room[node] == largest:
                break
            room[node] = largest
            node //= 2
    return bins, offsets


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The pieces of all documents with their place: adds sequence_id, offset and padding.

    Documents are cut every `capacity` ids; full pieces are sequences already. The rest is
    dealt by a hash into groups of about `group_rows`, whatever source or length it has, and
    packed within each group, so a group's memory does not grow with the table. A sequence is
    padded to `capacity` unless its ids are a power of two; `padding` repeats that number on each
    of its pieces. Repeated rows are packed one by one; an empty table gives an empty one.
    """
    pieces = written(token_pieces(docs, tokenizer_file, capacity), "pieces")
    groups = max(1, -(-pieces.where(F.col("length") < capacity).count() // group_rows))
    # Repeated rows would share a hash, so their number in the written table goes in as well.
    spread = F.xxhash64("doc_id", "ids_crc32", F.monotonically_increasing_id())
    salted = pieces.withColumn("group", F.pmod(spread, F.lit(groups)))
    names = [*pieces.columns, "sequence_id", "offset", "padding"]
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long, padding long"

    def per_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        used = np.bincount(bins, weights=rows["length"]).astype(np.int64)[bins]
        group = int(rows["group"].iloc[0])
        padding = np.where(used & (used - 1) == 0, 0, capacity - used)
        return rows.assign(sequence_id=(group << 32) + bins, offset=offsets, padding=padding)[names]

    rest = salted.where(F.col("length") < capacity).groupBy("group").applyInPandas(per_group, schema)
    full = pieces.where(F.col("length") == capacity).select(
        *pieces.columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("padding"),
    )
    return full.unionByName(rest.select(*names))
