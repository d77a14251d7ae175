"""Differences of cumulative counters on a stream, the last reading of each host kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.metrics import counter_delta_by_time
from changeflow.streaming.sinks import BATCH_COLUMNS, _start, count_rows, running_query_id, write_batch
from changeflow.streaming.whole import read_or_empty

_IDS = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]


def _kept(spark: SparkSession, kept: str, schema: T.StructType, query_id: str, batch_id: int) -> DataFrame:
    """The readings kept by the last batch before this one, a row per host."""
    rows = read_or_empty(spark, kept, T.StructType([*schema.fields, *_IDS]))
    earlier = rows.where((F.col("query_id") == query_id) & (F.col("batch_id") < batch_id))
    last = earlier.agg(F.max("batch_id")).first()[0]
    return earlier.where(F.col("batch_id") == last).select(*schema.fieldNames())


def land_deltas(
    batch: DataFrame, path: str, kept: str, query_id: str, batch_id: int, counters: Sequence[str],
    host: str = "hostname", order: Sequence[str] = ("timestamp",), width: int = 3600, fmt: str = "parquet",
) -> None:
    """Land one batch with its differences, and what the next one needs.

    The kept readings take part as samples that are not landed again.  A batch that is
    delivered again starts from the same readings, those of an earlier batch, and
    replaces both of its own writes.
    """
    names = [host, *order, *counters]
    schema = T.StructType([f for f in batch.schema.fields if f.name in names])
    carried = _kept(batch.sparkSession, kept, schema, query_id, batch_id).withColumn("_kept", F.lit(True))
    together = batch.withColumn("_kept", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    found = counter_delta_by_time(together, counters, host, order, width)
    write_batch(found.where(~F.col("_kept")).drop("_kept"), path, query_id, batch_id, (), fmt)
    reading = F.struct(*[c for c in schema.fieldNames() if c != host])
    last = together.groupBy(host).agg(F.max_by(reading, F.struct(*order)).alias("_last"))
    rows = last.select(host, "_last.*").select(*schema.fieldNames())
    write_batch(rows.coalesce(1), kept, query_id, batch_id)  # a row per host


def stream_counter_delta(
    df: DataFrame, path: str, kept: str, checkpoint: str, counters: Sequence[str], host: str = "hostname",
    order: Sequence[str] = ("timestamp",), width: int = 3600, fmt: str = "parquet", every: str | None = None,
    once: bool = False, name: str | None = None,
) -> StreamingQuery:
    """Land a stream of samples with ``<counter>_delta``, across batch borders.

    The same rows as the batch form where samples arrive in order; one that is late is
    compared with the samples of its batch before it in time.  ``kept`` holds one row per
    host and batch.  A batch is read twice: for its differences, and for the readings.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        land_deltas(batch, path, kept, running_query_id(batch), batch_id, counters, host, order, width, fmt)

    return _start(count_rows(df).writeStream.foreachBatch(land), checkpoint, name, every, once)


def read_deltas(
    spark: SparkSession, path: str, schema: T.StructType, counters: Sequence[str]
) -> DataFrame:
    """The landed samples (``schema``) with their differences."""
    added = [T.StructField(f"{c}_delta", schema[c].dataType) for c in counters]
    return read_or_empty(spark, path, T.StructType([*schema.fields, *added, *_IDS])).drop(*BATCH_COLUMNS)
