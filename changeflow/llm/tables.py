"""Helpers of the operators: columns, digests, written intermediate tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import partial, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.session import work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z only.  The built-in lower case does it for texts of ASCII alone."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Lets Spark remove a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of an Arrow batch that goes to a Python worker; Spark's own default is 64 MB.
BATCH_BYTES, BATCH_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Lets the session send whole texts to Python in batches of ``BATCH_BYTES`` at most.

    A smaller setting of the session stays.
    """
    own = spark.conf.get(BATCH_SETTING)
    number = own[:-1] if own.endswith("b") else own
    if not number.isdigit() or not 0 < int(number) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


#: What this worker keeps from one task to the next: a function that drops it, by its purpose.
_KEPT: dict[str, Callable[[], None]] = {}


def keep(purpose: str, drop: Callable[[], None]) -> None:
    """This worker keeps something for the tasks of a purpose; ``drop`` frees it."""
    _KEPT[purpose] = drop


def drop_others(purpose: str) -> None:
    """Drops what this worker keeps for the tasks of other purposes."""
    others = [p for p in _KEPT if p != purpose]
    for other in others:
        _KEPT.pop(other)()
    if others:
        hand_back()


def hand_back() -> None:
    """This worker's free memory goes back."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def handing_back(
    task: Callable[[Iterator], Iterator] | None = None, purpose: str = ""
) -> Callable[[Iterator], Iterator]:
    """The function of a Python worker's batches; when they end, the worker's free memory goes back.

    Workers are used again, and an executor's next task, of whatever kind, has to
    live beside what its workers have kept.  So a task first drops what was kept
    for tasks of another ``purpose``.
    """
    if task is None:
        return partial(handing_back, purpose=purpose)

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        drop_others(purpose)
        try:
            yield from task(batches)
        finally:
            hand_back()

    return run


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table, written to the shared folder and read back: computed once, lineage cut.

    Nothing reads the shuffle files of the write again, so they go when it ends.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def heavy_keys(df: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Keys with more than one in ``share`` of the rows; so there are fewer than ``share``.

    One row per key: the key and ``n``.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.join(F.broadcast(total)).where(F.col("n") * share > F.col("total")).select(key, "n")
