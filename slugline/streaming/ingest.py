"""Continuous ingest: a stream of landed webhooks to the event and quarantine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from slugline.operators.dedup import first_deliveries
from slugline.operators.ingest import classify_deliveries
from slugline.operators.sink import write_deliveries
from slugline.session import pin_session

# Fixed value: the state store that keeps its keys on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_ingest(
    raw_stream: DataFrame,
    secret: bytes,
    root: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    drop_repeated_within: str | None = None,
) -> StreamingQuery:
    """Start the stream; by default it takes what is there and stops.

    Ingest itself keeps no state: the business day comes from the receive time, so there is nothing to
    wait for. A micro-batch writes both tables in one job, into folders carrying its number. If
    it is interrupted, Spark replays it with the same input and number, and the replay
    replaces those folders, so every delivery that lands once is stored once.

    With `drop_repeated_within`, such as "7 days", a delivery that lands again within that time is
    stored once as well. Its digests are the only state, kept on disk and in the checkpoint. A stream goes on
    from its checkpoint only with the setting it was begun with.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # Streams run with adaptive execution off; the write's rebalancing needs it.
        pin_session(batch.sparkSession)
        write_deliveries(batch, root, batch_id=batch_id)

    if drop_repeated_within is not None:
        raw_stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        raw_stream = first_deliveries(raw_stream, drop_repeated_within)
    return (
        classify_deliveries(raw_stream, secret)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
