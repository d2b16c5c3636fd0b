"""URL filters: a cascade of Bloom filters that is exact over a known set of keys."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from slugline.llm.common import lower_ascii, written

FIRST_RATE = 0.5**0.5
NEXT_RATE = 0.5
MAX_LEVELS = 64
# Bytes of filters that one broadcast may hold; a larger cascade is split into shards by key hash.
BROADCAST_BYTES = 64 << 20


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule as host + path, verdict) of the longest of `rules` (verdict, host, path) that fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


# A level of a cascade: its bits, 64 in a word, and the number of its hash functions. Plain values,
# because a broadcast cannot carry classes to workers that lack this package.
Level = tuple[np.ndarray, int]


def _bits(n_keys: int, rate: float) -> tuple[int, int]:
    """(words of 64 bits, hashes) for so many keys at a rate of false positives."""
    bits = max(64, math.ceil(n_keys * math.log(1 / rate) / math.log(2) ** 2))
    return -(-bits // 64), max(1, round(math.log2(1 / rate)))


def positions(first: np.ndarray, second: np.ndarray, level: int, n_words: int, n_hashes: int) -> np.ndarray:
    """Bit positions of keys with two 64-bit hashes, one row per hash function."""
    with np.errstate(over="ignore"):
        a, b = first.astype(np.uint64), second.astype(np.uint64) | np.uint64(1)
        rows = []
        for k in range(n_hashes):
            x = (a + np.uint64(level * 0x632BE5AB + k + 1) * b) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            rows.append((x ^ (x >> np.uint64(32))) % np.uint64(n_words * 64))
    return np.array(rows)


def passes(level: Level, at: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    words, n_hashes = level
    found = positions(first, second, at, len(words), n_hashes)
    return ((words[found >> np.uint64(6)] >> (found & np.uint64(63))) & np.uint64(1)).all(axis=0)


def listed(levels: list[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that lacks it tells by its number."""
    answer = np.full(len(first), len(levels) % 2 == 1)
    inside = np.arange(len(first))
    for at, level in enumerate(levels):
        through = passes(level, at, first[inside], second[inside])
        answer[inside[~through]] = at % 2 == 1
        inside = inside[through]
    return answer


def _hashed(keys: DataFrame) -> DataFrame:
    listed = F.coalesce("listed", F.lit(False)).alias("listed")
    return keys.where("key IS NOT NULL").select(
        "key", listed, F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit("second")).alias("h2")
    )


def _filter_of(keys: DataFrame, level: int, n_keys: int, rate: float) -> Level:
    """A level that holds `keys`: bits are set in tasks, joined by word, and only words come back."""
    n_words, n_hashes = _bits(n_keys, rate)

    @F.pandas_udf("array<long>")
    def where(h1: pd.Series, h2: pd.Series) -> pd.Series:
        found = positions(h1.to_numpy(np.int64), h2.to_numpy(np.int64), level, n_words, n_hashes)
        return pd.Series(list(found.T.astype(np.int64)))

    bits = keys.select(F.explode(where("h1", "h2")).alias("bit"))
    word = F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))")
    rows = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(word.alias("word")).toPandas()
    words = np.zeros(n_words, np.uint64)
    words[rows["at"].to_numpy(np.int64)] = rows["word"].to_numpy(np.int64).view(np.uint64)
    return words, n_hashes


def _through(level: Broadcast, at: int):
    """Whether keys with two hashes pass a level."""

    @F.pandas_udf("boolean")
    def through(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(passes(level.value, at, h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return through


def _told(levels: Broadcast):
    """Whether keys with two hashes are listed."""

    @F.pandas_udf("boolean")
    def told(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(listed(levels.value, h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return told


def build_cascade(universe: DataFrame) -> list[Level]:
    """Filters for `universe` (key, listed): distinct keys, all that will ever be asked.

    Level 1 holds the listed keys, level 2 the unlisted ones that pass level 1, level 3 the
    listed ones that pass level 2, and so on until none passes: then every key of the universe
    is told rightly. The sets are found by Spark; the driver sees filter words alone.
    """
    return _cascade(written(_hashed(universe), "universe"))


def _cascade(keys: DataFrame) -> list[Level]:
    """Filters for stored keys with their hashes."""
    spark = keys.sparkSession
    inside, outside = keys.where("listed"), keys.where("NOT listed")
    levels: list[Level] = []
    n_inside, n_outside = inside.count(), outside.count()
    rate = min(0.5, FIRST_RATE * n_inside / n_outside) if n_outside else 0.5
    while n_inside:
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys of the universe share both hashes")
        levels.append(_filter_of(inside, len(levels), n_inside, rate))
        through = _through(spark.sparkContext.broadcast(levels[-1]), len(levels) - 1)
        wrong = written(outside.where(through("h1", "h2")), "passing")
        inside, outside, n_inside, rate = wrong, inside, wrong.count(), NEXT_RATE
    return levels


def add_listed(rows: DataFrame, universe: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(row, listed): all columns of `rows` in a struct, and whether the row's key is listed in `universe` (key, listed).

    No join: the cascade goes to the tasks. Its size is estimated from the number of listed keys;
    beyond `broadcast_bytes` keys are split by hash into shards, each with a cascade of its own,
    and the rows go through them one after the other. `universe` is evaluated once and stored. Null keys
    are not listed, nor are keys whose `listed` is null. Keys outside the universe get an answer without a
    promise. Repeated rows stay; empty tables stay empty. Keys may be of any length, only their hashes are
    kept. Columns of `rows` may have any names, as they stay in the struct; further ones of `universe` are ignored.
    """
    spark = rows.sparkSession
    keys = written(_hashed(universe), "universe")
    n_all, n_listed = keys.agg(F.count("*"), F.count_if("listed")).head()
    n_words, _ = _bits(n_listed, min(0.5, FIRST_RATE * max(n_listed, 1) / max(n_all - n_listed, 1)))
    shards = max(1, -(-n_words * 16 // broadcast_bytes))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards))
    told = rows.select(F.struct("*").alias("row"), F.col(key).alias("key"))
    for k in range(shards):
        tell = _told(spark.sparkContext.broadcast(_cascade(keys.where(shard == k))))
        mine = F.coalesce(shard == k, F.lit(False)) & F.col("key").isNotNull()
        answer = tell(F.xxhash64("key"), F.xxhash64("key", F.lit("second"))) & mine
        told = told.withColumn("listed", F.col("listed") | answer if k else answer)
        if k + 1 < shards:
            told = written(told, "told")
    return told.select("row", "listed")
