"""Differences of cumulative counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.session import work_folder


def counter_delta(
    samples: DataFrame,
    counters: Sequence[str],
    host: str = "hostname",
    order: Sequence[str] = ("timestamp",),
    slices: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Add ``<counter>_delta``: the reading minus the host's previous reading.

    A host's first reading gives NULL.  ``order`` should tell one host's
    samples apart; add the offset where timestamps repeat.  Batch only.

    A window per host would put one host's whole history into one task.  The
    samples are range-partitioned by host and order instead, so a busy host
    spreads over many slices of about equal size, and each slice computes its
    own differences.  Only the first row of a slice needs a value from outside:
    the last row of the slice before it.  There is one such row per slice, so
    the table broadcast for it is bounded by the number of slices.

    The slices are written to the shared folder once: computing them again for
    the second use could draw other bounds.
    """
    if samples.isStreaming:
        raise ValueError("counter_delta works on batches")
    spark = samples.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [host, *order]
    ranged = samples.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id())
    in_slice = Window.partitionBy("_slice").orderBy(*keys)
    head = F.row_number().over(in_slice) == 1
    same_host = F.lag(host).over(in_slice).eqNullSafe(F.col(host))
    marked = ranged.select(
        "*",
        head.alias("_head"),
        F.lead(F.lit(True)).over(in_slice).isNull().alias("_tail"),
        *[
            F.when(~head & same_host, F.col(c) - F.lag(c).over(in_slice)).alias(f"{c}_delta")
            for c in counters
        ],
    )
    path = folder or work_folder(spark, "counter-delta")
    marked.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)

    by_slice = Window.orderBy("_slice")  # one row per slice, at most n
    carried = stored.where("_tail").select(
        F.lead("_slice").over(by_slice).alias("_slice"),
        F.col(host).alias("_host"),
        *[F.col(c).alias(f"_{c}") for c in counters],
    )
    joined = stored.join(F.broadcast(carried.where(F.col("_slice").isNotNull())), "_slice", "left")
    continues = F.col("_head") & F.col("_host").eqNullSafe(F.col(host)) & (F.col("_slice") > 0)
    return joined.select(
        *samples.columns,
        *[
            F.when(continues, F.col(c) - F.col(f"_{c}"))
            .otherwise(F.col(f"{c}_delta"))
            .alias(f"{c}_delta")
            for c in counters
        ],
    )


def _time_bucket(samples: DataFrame, column: str, width: int) -> Column:
    """Which span of ``width`` seconds (or units of a number) a value is in; never falls as it rises."""
    kind = samples.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampNTZType):  # counted without a zone, where clocks go back
        seconds = F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)")
    elif isinstance(kind, T.TimestampType):
        seconds = F.unix_seconds(value)
    else:
        seconds = value
    return F.floor(seconds / F.lit(width)).cast("bigint")


def counter_delta_by_time(
    samples: DataFrame,
    counters: Sequence[str],
    host: str = "hostname",
    order: Sequence[str] = ("timestamp",),
    width: int = 3600,
) -> DataFrame:
    """The same as :func:`counter_delta` in one shuffle of the samples, without a write.

    Samples are dealt by host and span of ``width`` seconds of the first ``order``
    column, so a busy host spreads over as many tasks as it has spans; choose a width
    whose samples of one host fit a task.  A span's first sample needs the last
    reading of the host's span before it, however many empty ones lie between: the
    last readings are combined before their shuffle and carried on by a window over
    spans, one small row each.  Where a single instant holds very many samples of a host,
    :func:`counter_delta` splits them, at the price of a second pass.
    """
    if samples.isStreaming:
        raise ValueError("counter_delta_by_time works on batches; see streaming.deltas")
    # Keys without NULLs, so that the join finds the rows where the window left them.
    keys = ["_host", "_unnamed", "_span"]
    span = F.coalesce(_time_bucket(samples, order[0], width), F.lit(-(1 << 62)))
    spanned = samples.select(
        "*", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
        F.col(host).isNull().alias("_unnamed"), span.alias("_span"),
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(within) == 1
    marked = spanned.select(
        "*", first.alias("_first"), *[F.lag(c).over(within).alias(f"_before_{c}") for c in counters]
    )
    last = spanned.groupBy(*keys).agg(
        F.max_by(F.struct(*counters), F.struct(*order)).alias("_last")
    )
    spans = Window.partitionBy("_host", "_unnamed").orderBy("_span")
    carried = last.select(*keys, F.lag("_last").over(spans).alias("_carried")).where(F.col("_carried").isNotNull())
    joined = marked.join(carried, keys, "left")
    deltas = [
        (F.col(c) - F.when(F.col("_first"), F.col(f"_carried.`{c}`")).otherwise(F.col(f"_before_{c}"))).alias(f"{c}_delta")
        for c in counters
    ]
    return joined.select(*samples.columns, *deltas)
