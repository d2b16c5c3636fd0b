"""Writing the event table: Hive-partitioned Parquet under `service/api/dt`."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from slugline.functions.partitions import partition_value
from slugline.operators.shards import MOST_ROWS, write_shards
from slugline.schema import EVENT_COLUMNS, PARTITION_COLUMNS, QUARANTINE_SCHEMA, REQUIRED_COLUMNS
from slugline.sources.files import delete_folder, exists, local_path, make_folder, move_folder

# The two tables one ingest run fills, as the first partition level under its root.
TABLE_COLUMN = "table"
EVENTS, QUARANTINE = "events", "quarantine"
QUARANTINE_COLUMNS = tuple(name for name in QUARANTINE_SCHEMA.names if name not in EVENT_COLUMNS)
BATCH_COLUMN = "ingest_batch"
# Holds a folder for each batch number that was begun; readers skip names with an underscore.
BEGUN = "_begun_batches"


def table_root(base: str, prefix: str) -> str:
    """The folder of a table below a bucket or folder; slashes around the prefix do not matter."""
    return f"{base.rstrip('/')}/{prefix.strip('/')}"


def _required(name: str) -> Column:
    """The column, failing the write on the first NULL; checked while writing, in the same pass."""
    column = F.col(name)
    return F.when(column.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(column)


def spread_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Lay rows out for a partitioned write.

    Rebalancing brings a partition's rows together so that small partitions make one file each,
    while adaptive execution cuts a partition that outgrows the advisory size into as many tasks
    as it needs: a partition holding a third of all rows is written by many tasks. Within a task
    rows are sorted by kind and content, which gives the Parquet row groups narrow ranges to
    skip by and long runs to encode.
    """
    balanced = rows.hint("rebalance", *keys)
    return balanced.sortWithinPartitions(*keys, "event_kind", "content_id")


def _write(
    rows: DataFrame, root: str, mode: str, keys: tuple[str, ...], rows_per_file: int | None, overwrite: str = "static"
) -> None:
    """Write rows laid out by `spread_rows`; small files appended to a local folder are written as shards."""
    writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
    if rows_per_file is not None:
        folder = local_path(rows.sparkSession, root) if mode == "append" and 0 < rows_per_file <= MOST_ROWS else None
        if folder is not None:
            return write_shards(rows, keys, folder, rows_per_file)
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*keys).parquet(root)


def stored_values() -> dict[str, Column]:
    """Path values of service and api, and the checks of required columns, as replacements."""
    values = {name: partition_value(F.col(name)) for name in ("service", "api")}
    return values | {name: _required(name) for name in REQUIRED_COLUMNS}


def write_events(
    events: DataFrame, root: str, *, mode: str = "append", rows_per_file: int | None = None
) -> int:
    """Write events below `root` and return how many; `mode="overwrite"` replaces whatever the table held.

    The path values of service and api are escaped, with `unknown` for NULL, and are what every
    reader sees; the values as sent stay in `raw_payload`. Without any event it raises, and the
    table stays as it was. The events are counted while they are written, so their plan
    runs once: a replacement is written beside the table and takes its place only if it holds something.
    """
    counted = Observation()
    rows = events.select(*EVENT_COLUMNS).withColumns(stored_values())
    rows = spread_rows(rows.observe(counted, F.count(F.lit(1)).alias("events")), *PARTITION_COLUMNS)
    replaces = mode == "overwrite"
    target = f"{root.rstrip('/')}-{uuid.uuid4().hex}" if replaces else root
    _write(rows, target, "append" if replaces else mode, PARTITION_COLUMNS, rows_per_file)
    n_events = _observed(counted, "events")
    if replaces:
        _take_place(events, target, root, n_events > 0)
    if not n_events:
        raise ValueError("no events to write")
    return n_events


def _observed(counted: Observation, name: str) -> int:
    """A count taken during a write that has succeeded."""
    try:
        return counted.get[name]
    except Py4JJavaError:
        # Input that Spark knows to be empty leaves no plan to observe, and so an empty row of metrics.
        return 0


def _take_place(events: DataFrame, staged: str, root: str, wanted: bool) -> None:
    spark = events.sparkSession
    if not wanted:
        return delete_folder(spark, staged)
    earlier = f"{staged}-replaced"
    if exists(spark, root):
        move_folder(spark, root, earlier)
    move_folder(spark, staged, root)
    delete_folder(spark, earlier)


def write_deliveries(
    deliveries: DataFrame,
    root: str,
    *,
    mode: str = "append",
    batch_id: int | None = None,
    rows_per_file: int | None = None,
) -> None:
    """Write classified deliveries in one pass: events and quarantine are sibling tables.

    Both outcomes leave in one job, so the input is read, verified and parsed once and nothing is
    cached. With a `batch_id` the rows land in folders of that batch only, and replaying
    the batch replaces exactly those folders; a number that was never begun has none, so its rows are
    appended, and the driver need not replace folder by folder. Appends to one root must not
    overlap. `mode="overwrite_partitions"` replaces the partitions that get rows and no others.
    """
    accepted = F.col("reject_reason").isNull()
    values = {name: partition_value(F.col(name)) for name in ("service", "api")}
    values["received_at"] = _required("received_at")
    values[TABLE_COLUMN] = F.when(accepted, EVENTS).otherwise(QUARANTINE)
    keys = (TABLE_COLUMN, *PARTITION_COLUMNS)
    rows = deliveries.select(*EVENT_COLUMNS, *QUARANTINE_COLUMNS).withColumns(values)
    rows = spread_rows(rows, *keys)
    overwrite = "static"
    if mode == "overwrite_partitions":
        mode, overwrite = "overwrite", "dynamic"
    if batch_id is not None:
        rows = rows.withColumn(BATCH_COLUMN, F.lit(batch_id))
        keys = (*keys, BATCH_COLUMN)
        if _begun_before(deliveries.sparkSession, root, batch_id):
            # What an interrupted append had ready is not yet in the table; the next append would bring it in.
            delete_folder(deliveries.sparkSession, f"{root.rstrip('/')}/_temporary")
            mode, overwrite = "overwrite", "dynamic"
        else:
            mode = "append"
    _write(rows, root, mode, keys, rows_per_file, overwrite)


def _begun_before(spark: SparkSession, root: str, batch_id: int) -> bool:
    """Whether a batch of this number may have left files below `root`; notes that it has begun now.

    Tables without any note hold batches of unknown numbers.
    """
    notes = f"{root.rstrip('/')}/{BEGUN}"
    note = f"{notes}/{batch_id}"
    unknown = exists(spark, root) and not exists(spark, notes)
    begun = unknown or exists(spark, note)
    make_folder(spark, note)
    return begun


def events_root(root: str) -> str:
    """Where `write_deliveries` puts the events of `root`."""
    return f"{root}/{TABLE_COLUMN}={EVENTS}"


def quarantine_root(root: str) -> str:
    """Where `write_deliveries` puts the rejected records of `root`."""
    return f"{root}/{TABLE_COLUMN}={QUARANTINE}"
