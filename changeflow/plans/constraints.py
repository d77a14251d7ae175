"""Constraint checks kept up to date fold by fold.

Every version of the kept state (``plans.live``) names the batches that it folded
and the buckets that it rewrote; the version before it is still there.  So what a
fold brought can be checked at any time after it, from its batches and the earlier
rows of the buckets that it touched: nothing else is read.  The counts of a version
are one small partition; counting it again replaces it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.quality import check_length, check_not_null
from changeflow.plans.live import VERSIONS, newer_rows, state_at
from changeflow.schemas import DELETE, INSERT
from changeflow.streaming.whole import read_or_empty

NOT_NULL, LENGTH, UNIQUE = "not_null", "length", "unique"
COUNTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("rule", "column")]
    + [T.StructField(c, T.LongType()) for c in ("violations", "version")]
)
#: Offsets of a key that are put in order in one task.
SPAN = 1 << 20


def repeated_inserts(rows: DataFrame, before: DataFrame, key: str, order: str = "offset", span: int = SPAN) -> DataFrame:
    """The inserts of keys that are there already: the change before is no delete.

    ``before`` has the last earlier change of each key.  Changes up to that one are
    late copies and are left out; so are copies of one position.  The changes
    of a key are put in order by spans of offsets, and each span's last operation is
    combined before it is sent, so a busy key is spread over tasks.
    """
    known = before.select(key, F.col("operation").alias("_known"), F.col(order).alias("_upto"))
    once = rows.groupBy(key, order).agg(F.min("operation").alias("operation"))
    fresh = once.join(known, key, "left").where(F.col("_upto").isNull() | (F.col(order) > F.col("_upto")))
    fresh = fresh.withColumn("_span", F.floor(F.col(order) / span))
    last = fresh.groupBy(key, "_span").agg(F.max_by("operation", order).alias("_last"))
    carried = last.select(key, "_span", F.lag("_last").over(Window.partitionBy(key).orderBy("_span")).alias("_carried"))
    within = F.lag("operation").over(Window.partitionBy(key, "_span").orderBy(order))
    previous = F.coalesce(within, "_carried", "_known")
    found = fresh.join(carried, [key, "_span"]).withColumn("_previous", previous)
    return found.where((F.col("operation") == INSERT) & (F.col("_previous") != DELETE)).select(key, order)


def count_version(
    spark: SparkSession, root: str, table: str, state: str, version: int, required: Sequence[str],
    limits: Mapping[str, int], key: str = "uuid",
) -> DataFrame:
    """The violations that one fold brought: rule, column, violations."""
    found = read_or_empty(spark, f"{state}/versions", VERSIONS).where(F.col("version").isin(version - 1, version))
    rows_of = {r.version: r for r in found.collect()}  # two rows
    now, earlier = rows_of[version], rows_of.get(version - 1)
    new = newer_rows(spark, root, table, dict(earlier.folded) if earlier else {}, dict(now.folded))
    touched = {b for b, v in now.written.items() if v == version}
    kept = {b: v for b, v in (earlier.written if earlier else {}).items() if b in touched}
    again = repeated_inserts(new.where(F.col(key).isNotNull()), state_at(spark, root, table, state, kept), key)
    return (
        check_not_null(new, required).select(F.lit(NOT_NULL).alias("rule"), "column", "violations")
        .unionByName(check_length(new, limits).select(F.lit(LENGTH).alias("rule"), "column", "violations"))
        .unionByName(again.agg(
            F.lit(UNIQUE).alias("rule"), F.lit(key).alias("column"), F.count(F.lit(1)).alias("violations")
        ))
    )


def check_folded(
    spark: SparkSession, root: str, table: str, state: str, counts: str, required: Sequence[str],
    limits: Mapping[str, int], key: str = "uuid",
) -> list[int]:
    """Count every fold that was not counted yet; gives the versions counted now."""
    done = read_or_empty(spark, counts, COUNTS).agg(F.max("version")).first()[0]
    versions = read_or_empty(spark, f"{state}/versions", VERSIONS).select("version")
    if done is not None:
        versions = versions.where(F.col("version") > done)
    waiting = sorted(r.version for r in versions.collect())
    for version in waiting:
        found = count_version(spark, root, table, state, version, required, limits, key)
        found.coalesce(1).write.mode("overwrite").parquet(f"{counts}/version={version}")
    return waiting


def read_checks(spark: SparkSession, counts: str) -> DataFrame:
    """The violations of all counted folds: rule, column, violations."""
    return read_or_empty(spark, counts, COUNTS).groupBy("rule", "column").agg(F.sum("violations").alias("violations"))
