"""What several operators share: reading, cutting lineage, document keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slugline.session import scratch_path

# The pattern of a word everywhere in this package: a run without ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the folder all executors share: later steps survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def remainder(key: Column | str, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; a null key counts as empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(modulus))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(n: int, size: int) -> Iterator[slice]:
    for start in range(0, n, size):
        yield slice(start, min(n, start + size))


def spanning_forest(links: Iterable[tuple[np.ndarray, np.ndarray]], n: int) -> list[tuple[int, int]]:
    """Of all links among n rows, the fewest that connect the same rows."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for left, right in links:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
    return kept
