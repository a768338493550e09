"""Stream form of the daily jobs: each new or corrected archive is cleaned and put into its table.

The keyed updates are idempotent, so a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from panelwright.plans.vendor import Feed, VendorJobs
from panelwright.sources.archive import stream_daily
from panelwright.specs import TableSpec
from panelwright.store import Change, PanelStore


def start_upsert(
    store: PanelStore,
    table: TableSpec,
    stream: DataFrame,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    insert: bool = True,
    unique: bool = False,
) -> StreamingQuery:
    """Take up everything newer than the checkpoint, then stop (``availableNow``)."""

    def put(batch: DataFrame, _batch_id: int) -> None:
        store.apply(table, [Change(clean(batch), insert, unique=unique)])

    return (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_feed(jobs: VendorJobs, feed: Feed, checkpoint: str, log: str = "") -> StreamingQuery:
    """``start_upsert`` of a vendor feed from its daily archives; ``log``, a mounted folder that belongs to the checkpoint,
    keeps what has been read, so that offsets stay short."""
    stream = stream_daily(jobs.spark, jobs.archive_root, feed.data, log, origin=not feed.unique)
    return start_upsert(jobs.store, feed.table, stream, checkpoint, feed.clean, feed.insert, feed.unique)
