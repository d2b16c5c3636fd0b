"""Spelling variants: words one edit apart by k-d trees over letter counts, grouped under frequent forms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slugline.llm.common import lower_ascii, slices, written

# What a word is made of, and the letters left once A-Z are lower-cased.
WORD = r"[A-Za-zÀ-ÿ]+"
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
# Words of one cell and queries that meet it at a time; words of a leaf of the tree inside a task.
CELL_WORDS = 4096
QUERIES_AT_ONCE = 32768
LEAF_WORDS = 192
# Words from which the cells' borders are taken.
SAMPLE = 65_536


def word_counts(docs: DataFrame, one_in: int = 97) -> DataFrame:
    """(word, n): the words of all whole texts of `docs` (doc_id, text), with their counts.

    A run of letters whose CRC-32, with the doc_id before it, `one_in` divides loses the code point at
    that number modulo its length. A null doc_id counts as empty. Counts are
    aggregated before the shuffle, so a word that is everywhere is no hot key.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    crc = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run").cast("binary"))
    at = (F.col("crc") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    seen = runs.select("run", crc.alias("crc"))
    word = F.when(F.col("crc") % one_in == 0, cut).otherwise(F.col("run"))
    return seen.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


# --- vectors and trees -------------------------------------------------------------------------

_SLOT = np.full(256, -1, np.int16)
_SLOT[LETTERS] = np.arange(len(LETTERS))


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n, length = codes.shape
    kind = np.int16 if length < 2**14 else np.int32
    counts = np.zeros((n, len(LETTERS)), kind)
    for part in slices(n, max(1, (1 << 22) // max(1, length))):
        own = np.arange(part.stop - part.start)[:, None] * len(LETTERS) + _SLOT[codes[part]]
        counts[part] = np.bincount(own.ravel(), minlength=(part.stop - part.start) * len(LETTERS)).reshape(-1, len(LETTERS))
    return counts


def split_of(counts: np.ndarray) -> tuple[int, int] | None:
    """(letter, count): those with at most this count go left. The most even split of all letters, if there is one."""
    best, found = 0, None
    for letter in np.argsort(-counts.var(axis=0))[:12].tolist():
        column = counts[:, letter]
        for border in np.unique(column)[:-1].tolist():
            left = int((column <= border).sum())
            even = min(left, len(column) - left)
            if even > best:
                best, found = even, (letter, int(border))
    return found


def borders_of(counts: np.ndarray, cells: int, first: int = 0) -> list | int:
    """A k-d tree of at most `cells` cells: nested [letter, count, left, right], or the number of a cell."""
    split = split_of(counts) if cells > 1 and len(counts) > 1 else None
    if split is None:
        return first
    low = counts[:, split[0]] <= split[1]
    half = cells // 2
    return [*split, borders_of(counts[low], half, first), borders_of(counts[~low], cells - half, first + half)]


def routed(tree: list | int, counts: np.ndarray, budget: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows): the rows whose distance to the cell's box is at most `budget`; 0 finds their own cells.

    The distance grows by what lies between a row and each border it crosses; of several borders
    of one letter, the furthest counts.
    """
    none = np.zeros(len(counts), np.int64)
    waiting = [(tree, np.arange(len(counts)), none, {})]
    while waiting:
        node, rows, spent, crossed = waiting.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows
            continue
        letter, border, left, right = node
        value = counts[rows, letter].astype(np.int64)
        before = crossed.get(letter, none[rows])
        for child, beyond in ((left, value - border), (right, border + 1 - value)):
            away = np.maximum(np.maximum(beyond, 0), before)
            total = spent - before + away
            near = total <= budget
            carried = {known: marks[near] for known, marks in crossed.items()}
            waiting.append((child, rows[near], total[near], {**carried, letter: away[near]}))


def box_search(points: np.ndarray, queries: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers of all pairs of count vectors at L1 distance of at most `budget`.

    A k-d tree over the points, walked by all queries at once: at each node, those further than
    `budget` from the box that its points fill are pruned.
    """
    waiting = [(np.arange(len(points)), np.arange(len(queries)))]
    while waiting:
        here, asking = waiting.pop()
        if not len(here) or not len(asking):
            continue
        mine = points[here]
        low, high = mine.min(axis=0), mine.max(axis=0)
        keep = []
        for part in slices(len(asking), 1 << 13):
            q = queries[asking[part]]
            keep.append((np.maximum(low - q, 0) + np.maximum(q - high, 0)).sum(axis=1) <= budget)
        asking = asking[np.concatenate(keep)]
        split = split_of(mine) if len(here) > LEAF_WORDS else None
        if split is not None:
            left = mine[:, split[0]] <= split[1]
            waiting += [(here[left], asking), (here[~left], asking)]
            continue
        # Counts in unary: the letters two words share are a product of their rows.
        letters = np.repeat(np.arange(len(high)), high)
        steps = np.concatenate([np.arange(1, top + 1) for top in high]).astype(high.dtype)
        sizes, room = mine.sum(axis=1), max(1, len(steps))
        for block in slices(len(here), max(1, (1 << 24) // room)):
            p = (mine[block][:, letters] >= steps).astype(np.float32).T
            for part in slices(len(asking), max(1, (1 << 18) // room)):
                q = queries[asking[part]]
                shared = (q[:, letters] >= steps).astype(np.float32) @ p
                a, b = np.nonzero(shared >= (q.sum(axis=1)[:, None] + sizes[block] - budget) / 2)
                yield asking[part][a], here[block][b]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether leaving out one letter of the longer word gives the shorter one, letter order included."""
    length = short.shape[1]
    front = np.logical_and.accumulate(short == long[:, :length], axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    edge = np.ones((len(short), 1), bool)
    return (np.hstack((edge, front)) & np.hstack((back, edge))).any(axis=1)


def near_pairs(points: list[str], queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers of words one edit apart; the points are as long as the queries or one longer."""
    p, q = codes_of(points), codes_of(queries)
    longer = p.shape[1] - q.shape[1]
    for a, b in box_search(letter_counts(p), letter_counts(q), 1 if longer else 2):
        for part in slices(len(a), 1 << 16):
            check = one_inserted if longer else one_replaced
            good = check(q[a[part]], p[b[part]])
            yield a[part][good], b[part][good]


# --- the search over all words -----------------------------------------------------------------


def cell_borders(words: DataFrame, sample: int = SAMPLE) -> dict[int, list | int]:
    """A routing tree for each word length that needs one: cells of about CELL_WORDS words.

    Borders come from about `sample` words chosen by hash, the only rows that reach the driver. They decide
    which task does what, not what is found. At most about a cell for every eight words of the sample.
    """
    sizes = {row["length"]: row["count"] for row in words.groupBy("length").count().where(f"count > {CELL_WORDS}").collect()}
    if not sizes:
        return {}
    share = min(1.0, sample / sum(sizes.values()))
    steps = 1 << 30
    chosen = words.where(F.col("length").isin(*sizes) & (F.pmod(F.xxhash64("word"), F.lit(steps)) < int(share * steps)))
    held: dict[int, list[str]] = {}
    for row in chosen.select("length", "word").limit(2 * sample).collect():
        held.setdefault(row["length"], []).append(row["word"])
    return {
        length: borders_of(letter_counts(codes_of(sorted(found))), min(-(-sizes[length] // CELL_WORDS), max(1, len(found) // 8)))
        for length, found in held.items()
    }


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n): every two distinct words one edit apart, in both directions, with the count of `near`.

    `words` (word, n) are distinct. One edit changes letter counts by an L1 distance of 1, or 2 for
    a replaced letter, so words of each length look for words of the same length within 2 and of
    the next length within 1. Cells of a k-d tree for each length are dealt to tasks; a word
    looks in every cell whose box is near enough. In a task a tree over the cell's words is
    searched by boxes, and letter order is verified. A cell that has more than CELL_WORDS words (letter
    counts that many words share) is dealt into blocks, and its queries into parts: each meets every block.
    """
    rows = written(words.select("word", "n", F.char_length("word").alias("length")), "words")
    borders = cell_borders(rows)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(2).to_numpy()
            for own in np.unique(length).tolist():
                mine = np.flatnonzero(length == own)
                counts = letter_counts(codes_of(batch.column(0).take(pa.array(mine)).to_pylist()))
                for role, target, budget in (("point", own, 0), ("query", own, 2), ("query", own + 1, 1)):
                    for cell, at in routed(borders.get(target, 0), counts, budget):
                        if len(at):
                            taken = [batch.column(k).take(pa.array(mine[at])) for k in (0, 1)]
                            size = len(at)
                            fixed = [pa.array(np.full(size, v, np.int32)) for v in (target, cell)]
                            arrays = [*fixed, pa.array([role == "query"] * size), *taken]
                            yield pa.RecordBatch.from_arrays(arrays, ["target", "cell", "asks", "word", "n"])

    placed = written(rows.mapInArrow(places, "target int, cell int, asks boolean, word string, n long"), "placed")
    sizes = placed.groupBy("target", "cell").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("asks")) / CELL_WORDS)).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if("asks") / QUERIES_AT_ONCE)).cast("int").alias("parts"),
        F.count_if(~F.col("asks")).alias("points"),
    )
    known = placed.join(written(sizes.where("points > 0"), "cells"), ["target", "cell"])
    deal = F.xxhash64("word")
    task = ["target", "cell", "block", "part"]
    points = known.where(~F.col("asks")).withColumn("block", F.pmod(deal, "blocks").cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    queries = known.where("asks").withColumn("part", F.pmod(deal, "parts").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "n": pa.array([], pa.int64())})]

        def linked(words: list[str], near: list[str], n: np.ndarray) -> None:
            arrays = [pa.array(words, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())]
            found.append(pa.Table.from_arrays(arrays, ["word", "near", "n"]))

        held, held_n = left.column("word").to_pylist(), left.column("n").to_numpy()
        asked, asked_n = right.column("word").to_pylist(), right.column("n").to_numpy()
        lengths = np.array([len(word) for word in asked])
        for length in np.unique(lengths).tolist() if held else ():
            mine = np.flatnonzero(lengths == length)
            for a, b in near_pairs(held, [asked[k] for k in mine]):
                a = mine[a]
                queries, points = [asked[k] for k in a], [held[k] for k in b]
                linked(queries, points, held_n[b])
                if length < len(held[0]):
                    linked(points, queries, asked_n[a])
        return pa.concat_tables(found)

    mine, asking = [*task, "word", "n"], [*(f"of_{c}" for c in task), "word", "n"]
    left = points.select(*mine).groupBy(*task)
    right = queries.select(*mine).toDF(*asking).groupBy(*asking[: len(task)])
    grouped = left.cogroup(right)
    return grouped.applyInArrow(searched, "word string, near string, n long")


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, form, form_n, n_near, root) for each of the distinct `words` (word, n).

    A word's form is the near word of the largest n, the smallest in code-point order among equals, if
    that n is at least `ratio` times, and more than once, its own; `root` is where forms lead in the end, the word itself
    if it has none. Counts at least double from form to form, so chains are short; a word has at
    most a few hundred near words by its length, so none is a hot key. An empty table gives an empty one.
    """
    held = written(words.select("word", "n"), "spellings")
    best = F.min(F.struct((-F.col("n")).alias("minus"), F.col("near").alias("near")))
    told = near_words(held).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = held.join(told, "word", "left")
    frequent = -F.col("best.minus") >= ratio * F.col("n")
    formed = written(
        joined.select(
            "word",
            "n",
            F.when(frequent, F.col("best.near")).alias("form"),
            F.when(frequent, -F.col("best.minus")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ),
        "forms",
    )
    # Each round, what a word leads to leads on to what that one leads to.
    paths = formed.where("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:
        on = paths.select(F.col("word").alias("to"), F.col("to").alias("further"))
        paths = written(paths.join(on, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "paths")
        if paths.where("moved").limit(1).count() == 0:
            break
        paths = paths.select("word", "to")
    return formed.join(paths.select("word", F.col("to").alias("root")), "word", "left").withColumn("root", F.coalesce("root", "word"))
