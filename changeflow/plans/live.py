"""The current state of a table, kept up to date batch by batch.

State rows are the latest change of each key, in buckets of the key's hash.  A fold
reads the whole batches that landed since the last one and the state of the buckets
that have a key among them, writes these buckets under a new version, and last
writes one row: which version each bucket is at, and up to which batch the log is
in.  Readers follow the last such row, so they see a fold whole or not at all, and
a fold that failed is done again from the same point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.layout import rebalance
from changeflow.operators.state import drop_deleted, fold_changes, latest_changes
from changeflow.session import work_folder
from changeflow.streaming.whole import LANDED, LOG, TABLE, landed_columns, read_or_empty, whole_ids

BUCKET = "bucket"
VERSIONS = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("buckets", T.IntegerType()),
    T.StructField("written", T.MapType(T.IntegerType(), T.LongType())),
    T.StructField("folded", T.MapType(T.StringType(), T.LongType())),
])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def current_version(spark: SparkSession, state: str):
    """The last version's row: buckets' versions and folded batches; None before the first."""
    rows = read_or_empty(spark, f"{state}/versions", VERSIONS).orderBy(F.desc("version")).limit(1).collect()
    return rows[0] if rows else None


def _newer_than(folded: Mapping[str, int]) -> Column:
    """Batches after the folded ones: a condition on partition columns alone."""
    known = [F.col("query_id") == q for q in folded]
    later = [(F.col("query_id") == q) & (F.col("batch_id") > b) for q, b in folded.items()]
    other = ~reduce(lambda a, b: a | b, known) if known else F.lit(True)
    return reduce(lambda a, b: a | b, later, other)


def newer_rows(
    spark: SparkSession, root: str, table: str, folded: Mapping[str, int], upto: Mapping[str, int] | None = None
) -> DataFrame:
    """A table's rows of whole batches after ``folded`` (query id to batch id), and not after ``upto`` if given.

    Other folders are not read.
    """
    wanted = _newer_than(folded)
    if upto is not None:
        wanted = wanted & ~_newer_than(upto)
    log = read_or_empty(spark, f"{root}/{LOG}", LANDED).where((F.col(TABLE) == table) & wanted)
    ids = whole_ids(spark, root).where(wanted)
    return log.join(ids, ["query_id", "batch_id"], "left_semi").select(*landed_columns(table))


def _state_rows(spark: SparkSession, state: str, schema: T.StructType, written: Mapping[int, int]) -> DataFrame:
    """The rows of some buckets at their versions."""
    if not written:
        return spark.createDataFrame([], schema)
    paths = [f"{state}/rows/version={v}/{BUCKET}={b}" for b, v in sorted(written.items())]
    found = spark.read.schema(schema).option("basePath", f"{state}/rows").parquet(*paths)
    return found.select(*schema.fieldNames())


def _schema(spark: SparkSession, root: str, table: str) -> T.StructType:
    rows = newer_rows(spark, root, table, {}).drop("query_id", "batch_id").schema
    return T.StructType([*rows.fields, T.StructField(BUCKET, T.IntegerType())])


def fold_landed(
    spark: SparkSession, root: str, table: str, state: str, keys: Sequence[str] = ("uuid",),
    order: Sequence[str] = ("offset",), buckets: int = 64,
) -> int:
    """Bring the state up to the whole batches of the log; gives its version.

    ``buckets`` counts for a new state only; an existing one keeps its number.  Give
    as many that a bucket is a file or two.  Keys must not be NULL: changes without
    one are left out.
    """
    now = current_version(spark, state)
    written, folded = (dict(now.written), dict(now.folded)) if now else ({}, {})
    n, version = (now.buckets, now.version + 1) if now else (buckets, 0)
    # Fixed before rows are read: batches that land meanwhile wait for the next fold.
    ends = whole_ids(spark, root).where(_newer_than(folded)).groupBy("query_id").agg(F.max("batch_id").alias("b"))
    reached = {r.query_id: r.b for r in ends.collect()}
    if not reached:
        return version - 1
    within = reduce(lambda a, b: a | b, [(F.col("query_id") == q) & (F.col("batch_id") <= b) for q, b in reached.items()])
    schema = _schema(spark, root, table)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = newer_rows(spark, root, table, folded).where(within & known).drop("query_id", "batch_id")
    staged = work_folder(spark, "newer")
    latest_changes(rows, keys, order).withColumn(BUCKET, bucket_of(keys, n)).write.partitionBy(BUCKET).parquet(staged)
    new = read_or_empty(spark, staged, schema)
    changed = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most n
    old = _state_rows(spark, state, schema, {b: written[b] for b in changed if b in written})
    merged = fold_changes(old, new, keys, order)
    rebalance(merged, [BUCKET]).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{state}/rows/version={version}")
    written.update(dict.fromkeys(changed, version))
    row = [(version, n, written, {**folded, **reached})]
    spark.createDataFrame(row, VERSIONS).coalesce(1).write.mode("append").parquet(f"{state}/versions")
    return version


def state_at(spark: SparkSession, root: str, table: str, state: str, written: Mapping[int, int]) -> DataFrame:
    """The last change of each key, deletes included, of buckets at their versions."""
    return _state_rows(spark, state, _schema(spark, root, table), written)


def read_state(spark: SparkSession, root: str, table: str, state: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The live rows, with their bucket; of the given buckets only, if any are.

    Deleted keys stay in the state, so that a late copy of an older change cannot
    bring a row back; they are left out here.
    """
    now = current_version(spark, state)
    written = dict(now.written) if now else {}
    if buckets is not None:
        written = {b: v for b, v in written.items() if b in set(buckets)}
    return drop_deleted(_state_rows(spark, state, _schema(spark, root, table), written))
