"""Closed batches in a catalog table, later ones in the landed log, read as one.

Every micro-batch leaves small files.  A compaction writes the rows of a range of
closed batches into the table that ``init_tables`` made, as partitions of a range id of
its own, and then records the range.  A range that was not recorded is in no reader's
view: a compaction that failed half way leaves nothing behind but unused files, and
the next one takes the same batches under another id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.layout import rebalance
from changeflow.schemas import change_log_schema
from changeflow.sources.tables import init_tables
from changeflow.streaming.sinks import BATCH_COLUMNS
from changeflow.streaming.whole import LANDED, LOG, TABLE, read_or_empty, read_whole, whole_ids

RANGES, RANGE = "ranges", "range_id"
RECORDED = T.StructType(
    [T.StructField(c, T.StringType()) for c in (TABLE, RANGE, "query_id")]
    + [T.StructField(c, T.LongType()) for c in ("first_batch", "last_batch")]
)


def compacted_schema(table: str) -> T.StructType:
    """A table's change log with the ids of its batch and range."""
    ids = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    return T.StructType([*change_log_schema(table).fields, *ids, T.StructField(RANGE, T.StringType())])


def init_compacted(
    spark: SparkSession, names: dict[str, str], root: str, partitions: Sequence[str] = ("robot_id",)
) -> list[str]:
    """Create the catalog tables (``names``: table to catalog name) that do not exist yet."""
    declared = {name: (compacted_schema(t), [RANGE, *partitions]) for t, name in names.items()}
    return init_tables(spark, declared, root)


def recorded_ranges(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/{RANGES}", RECORDED).where(F.col(TABLE) == table)


def _open(spark: SparkSession, root: str, table: str, ids: DataFrame) -> DataFrame:
    """Of batch ids those that no recorded range holds."""
    last = recorded_ranges(spark, root, table).groupBy("query_id").agg(F.max("last_batch").alias("closed"))
    return ids.join(last, "query_id", "left").where(
        F.col("closed").isNull() | (F.col("batch_id") > F.col("closed"))
    ).drop("closed")


def compact_batches(
    spark: SparkSession, root: str, table: str, name: str, upto: int | None = None
) -> DataFrame | None:
    """Move whole batches (up to id ``upto``) that no range holds yet into the catalog table.

    Gives the recorded range, a row per query; None if there was nothing to do.  The
    landed log stays as it is.
    """
    ids = _open(spark, root, table, whole_ids(spark, root))
    if upto is not None:
        ids = ids.where(F.col("batch_id") <= upto)
    # One row per batch; collected into one per query, so that batches landing meanwhile stay open.
    spans = ids.groupBy("query_id").agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"))
    found = spans.collect()
    if not found:
        return None
    own = uuid.uuid4().hex
    record = spark.createDataFrame(
        [(table, own, r.query_id, r.first_batch, r.last_batch) for r in found], RECORDED
    ).coalesce(1)
    rows = read_whole(spark, root, table).join(
        F.broadcast(record.select("query_id", "first_batch", "last_batch")), "query_id"  # a row per query
    ).where(F.col("batch_id").between(F.col("first_batch"), F.col("last_batch")))
    columns = spark.table(name).columns
    partitions = [f.name for f in spark.catalog.listColumns(name) if f.isPartition]
    shaped = rebalance(rows.withColumn(RANGE, F.lit(own)).select(*columns), partitions)
    shaped.write.mode("append").insertInto(name)
    record.write.mode("append").parquet(f"{root}/{RANGES}")
    return record


def read_log(spark: SparkSession, root: str, table: str, name: str) -> DataFrame:
    """Every row of whole batches once: recorded ranges, and the batches after them."""
    ranges = recorded_ranges(spark, root, table).select(RANGE).distinct()
    closed = spark.table(name).join(ranges, RANGE, "left_semi").drop(RANGE)
    later = read_whole(spark, root, table).join(
        _open(spark, root, table, whole_ids(spark, root)), list(BATCH_COLUMNS), "left_semi"
    )
    return closed.unionByName(later.select(*closed.columns))


def files_to_read(spark: SparkSession, root: str) -> int:
    """Files of the landed log, whole or not."""
    return len(read_or_empty(spark, f"{root}/{LOG}", LANDED).inputFiles())
