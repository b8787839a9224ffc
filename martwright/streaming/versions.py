"""Out-of-order versions and withdrawals as a keyed state of the stream.

The stream keeps, per key, the version it let through last. An update that comes too late, because a newer version of its key
was already let through, goes no further, so the log holds each key's versions in rising order and does not grow with
replays and corrections that are out of date on arrival. A withdrawal is a version as any other; it stays in the state and the
log, so that an older update that comes after it does not bring the row back.

The state of a key is dropped once the key was silent for ``keep``. It only thins the log: a late version that passes after
that still loses against the newer one when :func:`state_of` merges the log on read. So nothing is lost, however late
it comes, and the state is bounded by the keys seen within ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.adjustments import apply_adjustments, latest_updates
from .adjustments import BATCH

# How each type of version or tie is told apart as a long.
AS_LONG = {
    "timestamp": F.unix_micros, "date": F.unix_date, "long": F.col, "integer": F.col, "short": F.col, "byte": F.col,
}
LEAST = -(2**63)  # a missing version or tie comes before all others
# A row travels as JSON text: pandas columns would turn whole numbers beside a NULL into binary fractions.
EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "true",
}
RANKED = "_key string, _v long, _t long, _arrived timestamp, _row string"


def _as_long(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    if kind not in AS_LONG:
        raise ValueError(f"{name} is {kind}; versions and ties are whole numbers, dates or timestamps")
    return F.coalesce(AS_LONG[kind](name).cast("long"), F.lit(LEAST))


def _best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The latest version of each key within a batch, before the shuffle: a hot key brings one row a batch."""
    for rows in batches:
        yield rows.sort_values(["_v", "_t"], kind="stable").drop_duplicates("_key", keep="last")


def rising_versions(updates: DataFrame, key: str, version: str, tie: str | None = None, keep: str = "7 days") -> DataFrame:
    """The streamed updates that are newer than all of their key that were let through before.

    Of each key at most one row a micro-batch passes: the one of largest version, then of largest ``tie``. Versions and ties are
    whole numbers, dates or timestamps; a missing one comes before all others. Of equal ones only the first passes.
    Updates without a key name no row and are left out. To be written in ``update`` mode.
    """
    millis = int(pd.Timedelta(keep).total_seconds() * 1000)
    if millis < 1:
        raise ValueError("keep must be positive")
    # The watermark runs on the time of arrival: no row is ever late, and it passes a key that was silent for ``keep``.
    ranked = updates.filter(F.col(key).isNotNull()).select(
        F.to_json(F.struct(key), EXACT).alias("_key"), _as_long(updates, version).alias("_v"),
        (_as_long(updates, tie) if tie else F.lit(0).cast("long")).alias("_t"), F.current_timestamp().alias("_arrived"),
        F.to_json(F.struct(*updates.columns), EXACT).alias("_row"),
    )

    def newer(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, arrived = None, state.getCurrentWatermarkMs() + 1
        for rows in batches:
            arrived = max(arrived, int(rows["_arrived"].max().timestamp() * 1000))
            row = rows.sort_values(["_v", "_t"], kind="stable").tail(1)
            rank = (int(row["_v"].iloc[0]), int(row["_t"].iloc[0]))
            if best is None or rank > best[0]:
                best = rank, row
        if best is not None and (not state.exists or best[0] > tuple(state.get)):
            state.update(best[0])
            yield best[1]
        state.setTimeoutTimestamp(arrived)

    latest = ranked.mapInPandas(_best, RANKED).withWatermark("_arrived", f"{millis} milliseconds")
    passed = latest.groupBy("_key").applyInPandasWithState(
        newer, RANKED, "v long, t long", "update", GroupStateTimeout.EventTimeTimeout
    )
    return passed.select(F.from_json("_row", updates.schema, EXACT).alias("_row")).select("_row.*")


def log_versions(
    updates: DataFrame, log_path: str, checkpoint: str, key: str, version: str, tie: str | None = None,
    keep: str = "7 days", available_now: bool = True,
) -> StreamingQuery:
    """Start the query that stores rising versions, each micro-batch in its own folder; a replayed batch overwrites its own."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log_path}/{BATCH}={batch_id}")

    rising = rising_versions(updates, key, version, tie, keep)
    writer = rising.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def state_of(
    base: DataFrame, log: DataFrame, key: str, version: str, tie: str | None = None, withdrawn: str | None = None
) -> DataFrame:
    """The base table with the logged versions merged in, without the rows whose latest version is a withdrawal.

    ``withdrawn`` names the log's boolean column that marks withdrawals; NULL marks none. A withdrawal that is older than the
    base row takes nothing away. A base without the column has no withdrawn rows of its own.
    """
    updates = log.drop(BATCH)
    if withdrawn is None:
        return apply_adjustments(base, updates, key, version, tie)
    marked = base if withdrawn in base.columns else base.withColumn(withdrawn, F.lit(False))
    merged = apply_adjustments(marked, updates, key, version, tie)
    return merged.filter(~F.coalesce(F.col(withdrawn), F.lit(False))).select(*base.columns)


def thinned(log: DataFrame, key: str, version: str, tie: str | None = None) -> DataFrame:
    """The log's latest version per key, withdrawals included: what a compacted log has to keep."""
    return latest_updates(log, key, version, tie)


__all__ = ["log_versions", "rising_versions", "state_of", "thinned"]
