"""Many small files: a partitioned write whose cost per file is that of the file alone.

Hadoop without its native library starts a `chmod` process for every local file and for its checksum file, which
takes longer than writing a file of few rows. Here tasks write such files with Arrow, which starts none.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from slugline.sources.files import NO_VALUE

# Rows a task may hold back for a file; larger files are few, and Spark's writer streams them.
MOST_ROWS = 10_000
# Fixed value: what Spark replaces in the folder name of a partition value.
_UNSAFE = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def partition_folder(keys: Iterable[str], values: Iterable[str | None]) -> str:
    """The folder of a partition below its table, named as Spark names it."""
    names = [_UNSAFE.sub(lambda found: f"%{ord(found[0]):02X}", value) if value else NO_VALUE for value in values]
    return "/".join(f"{key}={name}" for key, name in zip(keys, names))


def _runs(batch: pa.RecordBatch, keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """A batch cut where a key changes, with the keys of each piece."""
    changes = np.zeros(batch.num_rows, dtype=bool)
    for key in keys:
        codes = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changes[1:] |= codes[1:] != codes[:-1]
    for start, stop in pairwise([0, *np.flatnonzero(changes).tolist(), batch.num_rows]):
        if start < stop:
            yield tuple(batch.column(key)[start].as_py() for key in keys), batch.slice(start, stop - start)


def cut_shards(
    batches: Iterable[pa.RecordBatch], keys: tuple[str, ...], rows_per_file: int
) -> Iterator[tuple[tuple, pa.Table]]:
    """(keys, rows) of each file: rows arrive partition by partition, and every file but a partition's last is full."""
    held, waiting, n_waiting = None, [], 0
    for batch in batches:
        for values, piece in _runs(batch, keys):
            if values != held and waiting:
                yield held, pa.Table.from_batches(waiting)
                waiting, n_waiting = [], 0
            held = values
            waiting.append(piece)
            n_waiting += piece.num_rows
            if n_waiting >= rows_per_file:
                rows = pa.Table.from_batches(waiting).combine_chunks()
                full = n_waiting - n_waiting % rows_per_file
                for start in range(0, full, rows_per_file):
                    yield held, rows.slice(start, rows_per_file)
                waiting, n_waiting = rows.slice(full).to_batches(), n_waiting - full
    if n_waiting:
        yield held, pa.Table.from_batches(waiting)


def _merge(source: str, target: str) -> None:
    """Move what lies in a folder into another, whole folders where that has none of the name."""
    for name in os.listdir(source):
        if os.path.isdir(f"{target}/{name}"):
            _merge(f"{source}/{name}", f"{target}/{name}")
        else:
            os.rename(f"{source}/{name}", f"{target}/{name}")


def write_shards(rows: DataFrame, keys: tuple[str, ...], root: str, rows_per_file: int) -> None:
    """Append `rows`, sorted by `keys` within each task, to the table in the local folder `root`.

    The folder must be one that driver and executors share. Every attempt of a task writes below a folder of its own
    under a name that readers skip. Only when all tasks are done, the driver moves what the successful attempts
    have written into the table; until then, and after a failure, the table holds nothing of it. Pages carry checksums.
    """
    staged = f"{root}/_shards-{uuid.uuid4().hex}"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        written_last = None
        for number, (values, shard) in enumerate(cut_shards(batches, keys, rows_per_file)):
            folder = f"{staged}/{attempt}/{partition_folder(keys, values)}"
            if folder != written_last:
                os.makedirs(folder, exist_ok=True)
                written_last = folder
            with pa.OSFile(f"{folder}/part-{number:06d}-{attempt}.snappy.parquet", "wb") as file:
                pq.write_table(shard.drop_columns(list(keys)), file, store_schema=False, write_page_checksum=True)
        if written_last is not None:
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    stored = [name for name in rows.columns if name not in keys]
    texts = rows.select(*stored, *[F.col(key).cast("string").alias(key) for key in keys])
    os.makedirs(staged)
    try:
        for done in texts.mapInArrow(write, "attempt string").collect():
            _merge(f"{staged}/{done.attempt}", root)
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    open(f"{root}/_SUCCESS", "w").close()
    rows.sparkSession.catalog.refreshByPath(root)
