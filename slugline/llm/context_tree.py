"""Language-model scores by context-tree weighting over bytes, and a word-count baseline."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from slugline.llm.common import slices, written
from slugline.llm.mixing import token_count

DEPTH = 5  # bytes of context; a gram is these and the byte they predict
TOP = 2  # contexts of so many bytes stay together in a task
BLOCK_BYTES = 1 << 19
# Rows of an Arrow batch whose texts are Python objects at a time.
ROWS_AT_ONCE = 256
WORDS_HELD = 1 << 17
# Entries of a look-up table that go to every task, about 50 MB; the rest is joined.
TABLE_ENTRIES = 2_000_000
# An ending with more than this part of all grams is dealt by one byte more.
HOT_SHARE = 1024


def lower_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def sum_by_key(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    if not len(keys):
        return keys, *counts
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], *(np.add.reduceat(count[order], starts) for count in counts)


# --- grams -------------------------------------------------------------------------------------


def grams_of(data: np.ndarray) -> np.ndarray:
    gram = np.zeros(max(0, len(data) - DEPTH), np.int64)
    for k in range(DEPTH + 1):
        gram = gram << 8 | data[k : len(data) - DEPTH + k]
    return gram


def gram_blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, number of the text of each): one gram per byte and one for the end of a text.

    A text follows zero bytes and ends with one. Short texts share a block, long ones fill several.
    """
    pad, waiting, size = b"\x00" * DEPTH, [], 0

    def block() -> tuple[np.ndarray, np.ndarray]:
        parts = [pad + texts[k] + b"\x00" for k in waiting]
        data = np.frombuffer(b"".join(parts), np.uint8)
        # The last DEPTH grams that start in a text reach into the next one.
        owner = np.repeat(waiting, [len(part) for part in parts])
        room = np.concatenate([np.arange(len(part), 0, -1) for part in parts]) > DEPTH
        gram = grams_of(np.concatenate((data, np.zeros(DEPTH, np.uint8))))
        return gram[room], owner[room]

    for k, text in enumerate(texts):
        if len(text) > BLOCK_BYTES:
            data = np.frombuffer(pad + text + b"\x00", np.uint8)
            for part in slices(len(data) - DEPTH, BLOCK_BYTES):
                gram = grams_of(data[part.start : part.stop + DEPTH])
                yield gram, np.full(len(gram), k)
            continue
        waiting.append(k)
        size += len(text)
        if size > BLOCK_BYTES:
            yield block()
            waiting, size = [], 0
    if waiting:
        yield block()


def counted_texts(rows: DataFrame) -> DataFrame:
    """(gram, word, n, seen) of `rows` (text, learn), partly counted: grams with a null word, words with gram -1.

    `n` counts the texts to learn from, `seen` all of them. Both kinds come from one reading of the texts.
    """

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.array([], np.int64)
        held, size = [(none, none, none)], 0
        words: Counter[bytes] = Counter()
        learnt: Counter[bytes] = Counter()

        def words_out() -> Iterator[pa.RecordBatch]:
            names = list(words)
            for part in slices(len(names), 1 << 16):
                mine = names[part]
                n, seen = [learnt[w] for w in mine], [words[w] for w in mine]
                arrays = [pa.array(np.full(len(mine), -1)), pa.array(mine, pa.binary()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, _COUNTED)
            words.clear()
            learnt.clear()

        for batch in batches:
            for part in (batch.slice(k, ROWS_AT_ONCE) for k in range(0, batch.num_rows, ROWS_AT_ONCE)):
                learn = np.array(part.column(1).to_pylist(), bool)
                texts = [lower_bytes(t.as_py()) for t in part.column(0)]
                for text, learns in zip(texts, learn.tolist(), strict=True):
                    found = text.split()
                    words.update(found)
                    if learns:
                        learnt.update(found)
                    if len(words) > WORDS_HELD:
                        yield from words_out()
                for grams, owner in gram_blocks(texts):
                    # The lowest bit tells whether a text is learnt from, so one sort counts both.
                    seen, n = np.unique(grams << 1 | learn[owner], return_counts=True)
                    held.append((seen >> 1, np.where(seen & 1 == 1, n, 0), n))
                    size += len(seen)
                    if size > 2 * BLOCK_BYTES:
                        held, size = [sum_by_key(*map(np.concatenate, zip(*held, strict=True)))], 0
        yield from words_out()
        keys, n, seen = sum_by_key(*map(np.concatenate, zip(*held, strict=True)))
        for part in slices(len(keys), 1 << 16):
            arrays = [pa.array(keys[part]), pa.nulls(len(keys[part]), pa.binary()), pa.array(n[part]), pa.array(seen[part])]
            yield pa.RecordBatch.from_arrays(arrays, _COUNTED)

    partial = rows.select("text", "learn").mapInArrow(per_partition, "gram long, word binary, n long, seen long")
    return partial.groupBy("gram", "word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


_COUNTED = ["gram", "word", "n", "seen"]


# --- the tree ----------------------------------------------------------------------------------
# A node is a context of d bytes together with the bits of the next byte read so far, numbered
# 1 << j | prefix for j bits. Its key is context << 8 | number, the nearest byte lowest, so the
# context one byte shorter is the same number without its highest byte.


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving the argument up by eight."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - np.log(np.prod([x + k for k in range(8)], axis=0))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


@dataclass(frozen=True)
class Nodes:
    keys: np.ndarray  # ascending
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray  # log weighted probability
    own: np.ndarray  # share of the node's own estimate in it, against its children's
    children: np.ndarray  # log weighted probability of all children together

    @classmethod
    def of(cls, keys, zeros, ones, children=None) -> Nodes:
        kt = log_kt(zeros, ones)
        if children is None:
            return cls(keys, zeros, ones, kt, np.ones(len(keys)), np.zeros(len(keys)))
        weighted = np.log(0.5) + np.logaddexp(kt, children)
        return cls(keys, zeros, ones, weighted, np.exp(np.log(0.5) + kt - weighted), children)

    def shorter(self, depth: int) -> Nodes:
        """The nodes of contexts of `depth` bytes above these, which are one byte longer."""
        keys, at = np.unique(self.keys & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        total = [np.bincount(at, x, len(keys)) for x in (self.zeros, self.ones, self.weighted)]
        return Nodes.of(keys, *total)


def path(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node number, bit) of the eight steps to each symbol."""
    steps = np.arange(7, -1, -1)
    return (256 | symbols[:, None]) >> (steps + 1), (symbols[:, None] >> steps) & 1


def deepest(grams: np.ndarray, counts: np.ndarray) -> Nodes:
    node, bit = path(grams & 255)
    keys, at = np.unique(((grams >> 8)[:, None] << 8 | node).ravel(), return_inverse=True)
    totals = [np.bincount(at, np.where(bit == b, counts[:, None], 0).ravel(), len(keys)) for b in (0, 1)]
    return Nodes.of(keys, *totals)


def subtree(grams: np.ndarray, counts: np.ndarray, top: int) -> dict[int, Nodes]:
    """The nodes of all depths from DEPTH down to `top`."""
    levels = {DEPTH: deepest(grams, counts)}
    for depth in range(DEPTH - 1, top - 1, -1):
        levels[depth] = levels[depth + 1].shorter(depth)
    return levels


def log10_predictions(grams: np.ndarray, levels: dict[int, Nodes]) -> np.ndarray:
    """Log10 probability of the byte of each gram after its context.

    At each bit, a node mixes its own estimate with that of the next longer context by the
    share its count history gives them. A context never seen has no estimate and takes no share.
    """
    node, bit = path(grams & 255)
    chance = None
    for depth in range(DEPTH, -1, -1):
        nodes = levels[depth]
        keys = (((grams >> 8) & ((1 << 8 * depth) - 1))[:, None] << 8) | node
        at = np.minimum(np.searchsorted(nodes.keys, keys.ravel()), max(0, len(nodes.keys) - 1)).reshape(keys.shape)
        zeros, ones = nodes.zeros[at], nodes.ones[at]
        kt = (np.where(bit == 0, zeros, ones) + 0.5) / (zeros + ones + 1)
        own = nodes.own[at]
        chance = kt if chance is None else np.where(seen, own * kt + (1 - own) * chance, kt)  # noqa: F821
        seen = zeros + ones > 0
    return np.log10(chance).sum(axis=1)


def _gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """gram, n, seen and hot of all rows of a task."""
    kinds = (np.int64, np.int64, np.int64, bool)
    held = [[b.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "n", "seen", "hot")] for b in batches]
    held = held or [[np.array([]) for _ in kinds]]
    return tuple(np.concatenate(x).astype(kind) for x, kind in zip(zip(*held, strict=True), kinds, strict=True))


def ending(gram: Column, depth: int) -> Column:
    """The nearest `depth` bytes of a gram's context."""
    return F.shiftright(gram, 8).bitwiseAND(F.lit((1 << 8 * depth) - 1))


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, log10p, seen) for every gram of `counts` (gram, n, seen); grams of count 0 get one as well.

    Grams whose contexts end in the same TOP bytes are in one task, which holds their part of the
    tree. An ending that has more than a `HOT_SHARE`-th of all grams is dealt by one byte more, and
    the nodes of TOP bytes above its parts are summed by Spark: at most HOT_SHARE endings of 255 nodes. So are
    the upper levels of all: at most 255 nodes for each of 256 bytes. Only these two sums reach the driver.
    """
    spark = counts.sparkSession
    held = written(counts, "grams")
    sizes = held.groupBy(ending(F.col("gram"), TOP).alias("ending")).agg(F.count("*").alias("n"))
    hot = sizes.where(F.col("n") * HOT_SHARE > held.count()).select("ending").collect()
    far, near = ending(F.col("gram"), TOP + 1), ending(F.col("gram"), TOP)
    # At most HOT_SHARE rows.
    marks = spark.createDataFrame([(row["ending"], True) for row in hot], "ending long, hot boolean")
    dealt = held.withColumn("ending", near).join(F.broadcast(marks), "ending", "left")
    split = F.coalesce("hot", F.lit(False))
    together = dealt.select("gram", "n", "seen", split.alias("hot"), F.when(split, far).otherwise(near).alias("place")).repartition("hot", "place")
    together = written(together, "dealt").repartition("hot", "place")
    sums = "key long, depth int, zeros double, ones double, weighted double"

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n, _, is_hot = _gathered(batches)
        for mine, top in ((is_hot, TOP + 1), (~is_hot, TOP)):
            nodes = subtree(grams[mine], n[mine], top)[top] if mine.any() else None
            for part in slices(len(nodes.keys) if nodes else 0, 1 << 16):
                values = [pa.array(x[part]) for x in (nodes.keys, nodes.zeros, nodes.ones, nodes.weighted)]
                depth = pa.array(np.full(len(values[0]), top, np.int32))
                yield pa.RecordBatch.from_arrays([values[0], depth, *values[1:]], ["key", "depth", "zeros", "ones", "weighted"])

    tops = written(together.mapInArrow(upper, sums), "upper_nodes")
    totals = [F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]

    def summed(depth: int) -> Nodes:
        """The nodes one byte above the stored ones of `depth`."""
        short = F.col("key").bitwiseAND(F.lit((1 << 8 * depth) - 1))
        rows = tops.where(F.col("depth") == depth).groupBy(short.alias("key")).agg(*totals).orderBy("key").toPandas()
        return Nodes.of(*(rows[c].to_numpy() for c in ("key", "zeros", "ones", "weighted")))

    two = summed(TOP + 1)
    parts = [summed(TOP), two.shorter(TOP - 1)]
    one = _united(parts)
    # Plain values, because a broadcast cannot carry classes to workers that lack this package.
    shallow = spark.sparkContext.broadcast({d: astuple(nodes) for d, nodes in ((2, two), (1, one), (0, one.shorter(0)))})

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n, seen, is_hot = _gathered(batches)
        known = {depth: Nodes(*values) for depth, values in shallow.value.items()}
        for mine, top in ((is_hot, TOP + 1), (~is_hot, TOP)):
            own, own_seen = grams[mine], seen[mine]
            levels = {**known, **subtree(own, n[mine], top)} if mine.any() else {}
            for part in slices(len(own), 1 << 16):
                arrays = [own[part], log10_predictions(own[part], levels), own_seen[part]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["gram", "log10p", "seen"])

    return together.mapInArrow(told, "gram long, log10p double, seen long")


def _united(parts: list[Nodes]) -> Nodes:
    """The nodes of one depth whose children are in several parts of the tree."""
    keys, at = np.unique(np.concatenate([p.keys for p in parts]), return_inverse=True)
    # Log weighted probabilities of children add up; a node's own estimate is made anew of all counts.
    children = [p.children for p in parts]
    zeros, ones, below = (
        np.bincount(at, np.concatenate(x), len(keys))
        for x in ([p.zeros for p in parts], [p.ones for p in parts], children)
    )
    return Nodes.of(keys, zeros, ones, below)


# --- words -------------------------------------------------------------------------------------


def word_table(words: DataFrame) -> tuple[DataFrame, int]:
    """(hash, n, seen) of `words` (word, n, seen), and the seed of a hash that tells all words apart."""
    spark = words.sparkSession
    total = words.count()
    for salt in range(100):
        hashed = words.select(F.xxhash64(F.lit(salt), "word").alias("hash"), "n", "seen")
        if hashed.select("hash").distinct().count() == total:
            seed = spark.range(1).select(F.xxhash64(F.lit(salt))).head()[0]
            return hashed, seed & (2**64 - 1)
    raise ValueError("no seed tells all words apart")


# --- looking up --------------------------------------------------------------------------------

def most_seen(entries: DataFrame, at_most: int) -> float:
    """The least `seen` of the entries that one broadcast holds: those seen most, no more than `at_most`.

    Entries are counted in steps of a sixteenth of a doubling, so the driver gets a few hundred rows.
    """
    step = F.floor(F.log2(F.col("seen").cast("double")) * 16)
    steps = entries.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("seen").alias("least")).collect()
    held, least = 0, float("inf")
    for row in sorted(steps, key=lambda row: -row["step"]):
        held += row["n"]
        if held > at_most:
            break
        least = row["least"]
    return least


def broadcast_table(entries: DataFrame) -> Broadcast:
    """(hash table, bits of its homes) of (key, value), which `most_seen` has bounded."""
    got = entries.toArrow()
    table = hash_table(got.column("key").to_numpy(), got.column("value").to_numpy())
    return entries.sparkSession.sparkContext.broadcast((table, slot_bits(max(1, len(got)))))


Table = tuple[np.ndarray, np.ndarray]  # slots of keys and of values; an empty slot is (-1, 0)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def homes(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.view(np.uint64) * GOLDEN) >> np.uint64(64 - bits)).astype(np.int64)


def slot_bits(n: int) -> int:
    return max(4, (2 * n - 1).bit_length())


def hash_table(keys: np.ndarray, values: np.ndarray) -> Table:
    """Distinct keys by linear probing in the order of their homes; no value is 0."""
    bits = slot_bits(max(1, len(keys)))
    home = homes(keys, bits)
    order = np.argsort(home, kind="stable")
    run = np.arange(len(keys))
    place = np.maximum.accumulate(home[order] - run) + run if len(keys) else run
    size = max(1 << bits, int(place[-1]) + 1 if len(keys) else 0) + 1
    slots, told = np.full(size, -1, np.int64), np.zeros(size, values.dtype)
    slots[place], told[place] = keys[order], values[order]
    return slots, told


def look_up(wanted: np.ndarray, table: Table, bits: int) -> np.ndarray:
    """The value of each wanted key, 0 where the table lacks it."""
    slots, told = table
    values = np.zeros(len(wanted), told.dtype)
    left, at = np.arange(len(wanted)), homes(wanted, bits)
    while len(left):
        value = told[at]
        hit = slots[at] == wanted[left]
        values[left[hit]] = value[hit]
        on = ~hit & (value != 0)
        left, at = left[on], at[on] + 1
    return values


def misses(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """For each of n texts, its keys and how often it has them, as two list columns."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))) if len(keys) else keys
    times = np.diff(np.concatenate((first, [len(keys)]))) if len(keys) else keys
    offsets = pa.array(np.searchsorted(owner[first] if len(keys) else owner, np.arange(n + 1)).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (keys[first] if len(keys) else keys, times))


def looked_up(rows: DataFrame, words: DataFrame, grams: DataFrame, seed: int, base: float) -> DataFrame:
    """`rows` (row_no, .., text) without text, with known, known_score and score out of one reading of the texts.

    The entries seen most, TABLE_ENTRIES of each table at most, go to every task. What a text has of
    others is handed on in lists, and met by the rest of the tables in shuffled joins. Those keys
    are rare, so they are no hot keys, and few, unless nearly every key is; the sums are the same at any size.
    """
    word_least, gram_least = most_seen(words, TABLE_ENTRIES), most_seen(grams, TABLE_ENTRIES)
    often = F.col("seen") >= F.lit(word_least)
    # A word's value is its count plus one, as 0 means that the table lacks it.
    held_words = broadcast_table(words.where(often).select(F.col("hash").alias("key"), (F.col("n") + 1).alias("value")))
    held_grams = broadcast_table(grams.where(F.col("seen") >= F.lit(gram_least)).select(F.col("gram").alias("key"), F.col("log10p").alias("value")))
    kept = [c for c in rows.columns if c != "text"]
    lists = ["gram_keys", "gram_times", "word_keys", "word_times"]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(
        [f"{c} {fields[c]}" for c in kept] + [f"{c} double" for c in ("known", "known_score", "score")] + [f"{c} array<long>" for c in lists]
    )

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for part in (batch.slice(k, ROWS_AT_ONCE) for k in range(0, batch.num_rows, ROWS_AT_ONCE)):
                texts = [lower_bytes(t) for t in part.column("text").to_pylist()]
                n = len(texts)
                score, known, known_score = np.zeros(n), np.zeros(n), np.zeros(n)
                none = np.array([], np.int64)
                rare, rare_words = [(none, none)], [(none, none)]
                for keys, owner in gram_blocks(texts):
                    found = look_up(keys, *held_grams.value)
                    score += np.bincount(owner, found, n)
                    rare.append((keys[found == 0], owner[found == 0]))
                for k, text in enumerate(texts):
                    split = text.split()
                    for some in slices(len(split), WORDS_HELD):
                        keys = np.array([digest(w, seed) for w in split[some]], np.uint64).view(np.int64)
                        counts = look_up(keys, *held_words.value)
                        known[k] += (counts > 1).sum()
                        known_score[k] += np.log10(counts[counts > 1] / base).sum()
                        lacked = keys[counts == 0]
                        rare_words.append((lacked, np.full(len(lacked), k)))
                both = [misses(*map(np.concatenate, zip(*pairs, strict=True)), n) for pairs in (rare, rare_words)]
                arrays = [*(part.column(c) for c in kept), *map(pa.array, (known, known_score, score)), *both[0], *both[1]]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "known", "known_score", "score", *lists])

    first = written(rows.select(*kept, "text").mapInArrow(per_batch, schema), "first_sums")

    def rest(keys: str, times: str) -> DataFrame:
        return first.select("row_no", F.explode(F.arrays_zip(keys, times)).alias("x")).select("row_no", f"x.{keys}", f"x.{times}").toDF("row_no", "key", "times")

    times = F.col("times")
    more_score = (
        rest("gram_keys", "gram_times")
        .join(grams.where(F.col("seen") < F.lit(gram_least)).select(F.col("gram").alias("key"), "log10p"), "key")
        .groupBy("row_no")
        .agg(F.sum(times * F.col("log10p")).alias("more_score"))
    )
    more_words = (
        rest("word_keys", "word_times")
        .join(words.where(~often & (F.col("n") > 0)).select(F.col("hash").alias("key"), "n"), "key")
        .groupBy("row_no")
        .agg(F.sum(times).alias("more_known"), F.sum(times * F.log10((F.col("n") + 1) / F.lit(base))).alias("more_known_score"))
    )
    whole = first.join(more_score, "row_no", "left").join(more_words, "row_no", "left")
    added = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("known", "known_score", "score")}
    return whole.withColumns(added).select(*kept, *added)


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of all whole texts of `docs` (doc_id, text, learn), learnt from rows with `learn`.

    Returns doc_id, learn, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.
    `score` is the log10 probability of the text, A-Z in lower case, and of its end under the
    weighted context tree; `base_score` that of its words and end with counts plus one. Counts
    are over all rows with `learn`. Null texts are empty and have one token, the end. Repeated
    rows are scored, and learnt, one by one. With nothing to learn from, every bit is even. Other columns don't
    matter, whatever their names. Texts are read twice, once to count and once to score, at any size.
    """
    rows = docs.select("doc_id", "learn", "text")
    counted = written(counted_texts(rows), "counted")
    words, seed = word_table(counted.where("word IS NOT NULL"))
    learnt = words.where("n > 0")
    n_words, distinct = learnt.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    ends = rows.where("learn").count()
    train_tokens, vocabulary = n_words + ends, distinct + (ends > 0)
    base = float(train_tokens + vocabulary + 1)
    scores = written(gram_scores(counted.where("word IS NULL").select("gram", "n", "seen")), "gram_scores")

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    numbered = rows.withColumns({"n_bytes": n_bytes, "words": token_count(F.col("text")), "row_no": F.monotonically_increasing_id()})
    sums = looked_up(numbered, words, scores, seed, base)
    unknown = F.col("words") - F.col("known")
    end_known = int(ends > 0)
    return sums.select(
        "doc_id",
        "learn",
        (F.col("words") + 1).cast("long").alias("n_tokens"),
        (F.col("known") + end_known).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("known_score") - unknown * float(np.log10(base)) + float(np.log10((ends + 1) / base))).alias("base_score"),
        F.col("score"),
        (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
