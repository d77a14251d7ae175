"""Streaming sinks.

A checkpoint location is always required: without it a restart forgets what it
has read.  All sinks append.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from changeflow.operators.layout import DATE_PARTS, add_date_parts, spread

EVENT_TRIGGER = "30 seconds"    # fixed value: event queries
METRICS_TRIGGER = "60 seconds"  # fixed value: metrics queries
ROWS = "batch_rows"
BATCH_COLUMNS = ("query_id", "batch_id")


def set_trigger(
    writer: DataStreamWriter, every: str | None = None, once: bool = False
) -> DataStreamWriter:
    """``every``: a processing-time interval.  ``once``: read what is there, in
    as many batches as the source bounds ask for, and end.  Neither: start the
    next batch as soon as the last one is done."""
    if once:
        return writer.trigger(availableNow=True)
    if every:
        return writer.trigger(processingTime=every)
    return writer


def _start(
    writer: DataStreamWriter, checkpoint: str, name: str | None, every: str | None, once: bool
) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return set_trigger(writer, every, once).start()


def count_rows(df: DataFrame) -> DataFrame:
    """Count each batch's rows while they pass; no job of its own."""
    return df.observe(ROWS, F.count("*").alias("rows"))


def batch_row_counts(landed: DataFrame) -> DataFrame:
    """Rows of every landed batch (query_id, batch_id, rows), however many there are.

    Reads the partition columns only.
    """
    return landed.groupBy("query_id", "batch_id").agg(F.count("*").alias("rows"))


def recent_row_counts(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch id, rows) of the latest batches that read something.

    Spark keeps the progress of the last 100 batches only.
    """
    counts = []
    for progress in query.recentProgress:
        observed = (progress.get("observedMetrics") or {}).get(ROWS)
        if observed is not None and observed["rows"] > 0:
            counts.append((progress["batchId"], observed["rows"]))
    return counts


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
    every: str | None = None,
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Native append sink, exactly once.

    Do not mix it with batch appends on one path: readers of a native file sink
    follow its own log and do not see other files.
    """
    writer = count_rows(df).writeStream.format(fmt).option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return _start(writer, checkpoint, name, every, once)


def append_stream_by_date(
    df: DataFrame,
    path: str,
    checkpoint: str,
    column: str = "timestamp",
    fmt: str = "parquet",
    every: str | None = EVENT_TRIGGER,
    once: bool = False,
    name: str | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """As :func:`append_stream`, partitioned by year, month and day.

    ``files`` gathers each day's rows into at most that many files per batch,
    at the price of a shuffle; without it the plan has none.
    """
    dated = add_date_parts(df, column)
    if files:
        dated = spread(dated, DATE_PARTS, files)
    return append_stream(dated, path, checkpoint, fmt, DATE_PARTS, every, once, name)


def running_query_id(batch: DataFrame) -> str:
    """Id of the query that called a batch function.

    It is the same after a restart from the same checkpoint and another for a
    new checkpoint, whose batch ids start at 0 again.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query_id is None:
        raise RuntimeError("not called from a streaming query: its id is unknown")
    return query_id


def write_batch(
    batch: DataFrame, path: str, query_id: str, batch_id: int, entity: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Land one micro-batch so that landing it again changes nothing.

    A failed batch is delivered again with the same id and rows.  Parquet: the
    ids are the leading partition columns and a write replaces exactly the
    partitions it carries.  Delta: the table remembers the last batch id per
    query and ignores a repeated one.
    """
    if fmt == "delta":
        writer = batch.write.format("delta").mode("append")
        writer = writer.option("txnAppId", query_id).option("txnVersion", str(batch_id))
        columns = list(entity)
    else:
        batch = batch.withColumns(
            {"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("long")}
        )
        writer = batch.write.format(fmt).mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        columns = [*BATCH_COLUMNS, *entity]
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)


def append_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    entity: Sequence[str] = ("robot_id",),
    fmt: str = "parquet",
    every: str | None = None,
    once: bool = False,
    name: str | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """Land each micro-batch partitioned by entity key, once per batch id.

    One job per batch: an empty batch writes nothing, and the rows are counted
    on their way (:func:`batch_row_counts`).
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = spread(batch, entity, files) if files and entity else batch
        write_batch(rows, path, running_query_id(batch), batch_id, entity, fmt)

    writer = count_rows(df).writeStream.foreachBatch(land)
    return _start(writer, checkpoint, name, every, once)


@dataclass(frozen=True)
class Target:
    """One table of a split stream: which rows, shaped how, landed where."""

    path: str
    select: Callable[[DataFrame], DataFrame]
    entity: Sequence[str] = field(default_factory=tuple)
    files: int | None = None


def split_batches(
    df: DataFrame,
    targets: Sequence[Target],
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Land one stream in several tables, each batch read and decoded once.

    The batch is kept (memory, then disk) while its tables are written; its
    size is bounded by the source's per-trigger limit.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        query_id = running_query_id(batch)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target in targets:
                rows = target.select(batch)
                if target.files and target.entity:
                    rows = spread(rows, target.entity, target.files)
                write_batch(rows, target.path, query_id, batch_id, target.entity, fmt)
        finally:
            batch.unpersist()

    writer = count_rows(df).writeStream.foreachBatch(land)
    return _start(writer, checkpoint, name, every, once)
