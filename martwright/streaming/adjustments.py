"""Off-cycle adjustments as a stream.

Each micro-batch is reduced to the latest version per key and stored under its batch id, so a
replayed batch overwrites its own folder and nothing is counted twice. The base table is not
rewritten per batch: readers merge the log on read, and :func:`compact` folds it in when wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.adjustments import apply_adjustments, latest_updates
from ..session import discard
from ..sources.files import write_mart

BATCH = "batch_id"


def log_adjustments(
    updates: DataFrame, log_path: str, checkpoint: str, key: str, version: str, tie: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the query that stores streamed updates; ``available_now`` drains the source and ends."""

    def store(batch: DataFrame, batch_id: int) -> None:
        latest = latest_updates(batch, key, version, tie)
        latest.write.mode("overwrite").parquet(f"{log_path}/{BATCH}={batch_id}")

    writer = updates.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_state(base: DataFrame, log: DataFrame, key: str, version: str, tie: str | None = None) -> DataFrame:
    """Base table with the logged updates merged in."""
    return apply_adjustments(base, log.drop(BATCH), key, version, tie)


def compact(
    base: DataFrame, log: DataFrame, path: str, key: str, version: str, tie: str | None = None
) -> int | None:
    """Write the merged table to a new folder; the last batch that it holds, None for an empty log.

    Batches that arrive meanwhile are left out. Once readers use the new folder, :func:`trim`
    removes what it holds from the log.
    """
    last = log.agg(F.max(BATCH)).first()[0]
    held = log.filter(F.col(BATCH) <= last) if last is not None else log.limit(0)
    write_mart(current_state(base, held, key, version, tie), path)
    return last


def trim(log: DataFrame, log_path: str, last: int) -> None:
    """Delete the batches up to ``last`` from the log folder."""
    for row in log.select(BATCH).filter(F.col(BATCH) <= last).distinct().toLocalIterator():
        discard(log.sparkSession, f"{log_path}/{BATCH}={row[0]}")
