"""Current state from a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.schemas import DELETE

RECORD_POSITION = ("topic", "partition", "offset")


def latest_changes(
    changes: DataFrame, keys: Sequence[str] = ("uuid",), order: Sequence[str] = ("offset",)
) -> DataFrame:
    """The last change of each key, deletes included.

    One shuffle.  The maximum is an aggregate, so each map task reduces its
    rows to one per key before the exchange; a key that holds a large share of
    the log, or a replayed block of records, costs one row per map task.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in changes.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    columns = [F.col(f"`{c}`") for c in order]
    position = columns[0] if len(columns) == 1 else F.struct(*columns)
    latest = changes.groupBy(*keys).agg(F.max_by(row, position).alias("_latest"))
    return latest.select(*keys, "_latest.*").select(*changes.columns)


def drop_deleted(latest: DataFrame) -> DataFrame:
    return latest.where(~F.col("operation").eqNullSafe(DELETE))


def current_state(
    changes: DataFrame, keys: Sequence[str] = ("uuid",), order: Sequence[str] = ("offset",)
) -> DataFrame:
    """The rows that are live after all changes.

    ``order`` must order one key's changes totally.  Records keyed by the row
    key share a partition, so ``offset`` does; unkeyed records need a sequence
    column, or the record timestamp before the offset.
    """
    return drop_deleted(latest_changes(changes, keys, order))


def fold_changes(
    latest: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = ("uuid",),
    order: Sequence[str] = ("offset",),
) -> DataFrame:
    """Bring earlier :func:`latest_changes` up to date with newer ones.

    A periodic job reads the last result and the new part of the log, not the
    whole log.  The new part is reduced to one row per key and joined; both
    sides have unique keys, so no key can be hot.  Where ``latest`` is a table
    bucketed by the keys (``save_bucketed``), only the new part is shuffled.

    Deletes stay in the result so that a late replay of an older change cannot
    bring a row back; :func:`drop_deleted` gives the live rows.  Keys must not
    be NULL.
    """
    keys, order = list(keys), list(order)
    columns = latest.columns
    newer = latest_changes(changes.select(*columns), keys, order)
    old = latest.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_old"))
    new = newer.select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("_new"))
    both = old.join(new, keys, "full_outer")

    def position(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.`{c}`") for c in order])

    replaced = F.col("_old").isNull() | (
        F.col("_new").isNotNull() & (position("_new") > position("_old"))
    )
    row = F.when(replaced, F.col("_new")).otherwise(F.col("_old"))
    return both.select(*keys, row.alias("_row")).select(*keys, "_row.*").select(*columns)


def dedupe_replays(
    records: DataFrame, position: Sequence[str] = RECORD_POSITION, within: str | None = None
) -> DataFrame:
    """One of each record delivered more than once.

    On a batch this is exact.  On a stream ``within`` bounds the state: copies
    that arrive within that delay of the record time are removed, and the
    stream engine discards records older than the watermark, so it has to
    exceed the longest lag between partitions.  Where that is unknown, land
    the stream as it is and use the batch form on the log.
    """
    if not records.isStreaming:
        return records.dropDuplicates(list(position))
    if within is None:
        raise ValueError("a stream needs `within`, the delay that bounds its state")
    return records.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(list(position))
