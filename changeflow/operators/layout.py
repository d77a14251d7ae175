"""Partition columns, and how rows are spread over files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE_PARTS = ("year", "month", "day")


def add_date_parts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Partition columns year, month and day of the event time."""
    return df.select(
        "*",
        F.year(column).alias("year"),
        F.month(column).alias("month"),
        F.dayofmonth(column).alias("day"),
    )


def date_range_filter(
    start: dt.datetime, end: dt.datetime, column: str = "timestamp"
) -> Column:
    """``start <= column < end`` that also prunes year/month/day partitions.

    A predicate on the time alone says nothing about the partition columns to
    the optimizer, so both are given; the time predicate stays exact.  Times with
    a zone are converted to UTC, those without are taken as they are; so the
    column and its date parts must be in UTC.
    """
    start, end = (
        t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t for t in (start, end)
    )
    if not start < end:
        return F.lit(False)
    last = end - dt.timedelta(microseconds=1)

    def number(year: Column, month: Column, day: Column) -> Column:
        return year * 10000 + month * 100 + day

    parts = number(*[F.col(p) for p in DATE_PARTS])
    days = parts.between(
        start.year * 10000 + start.month * 100 + start.day,
        last.year * 10000 + last.month * 100 + last.day,
    )
    years = F.col("year").between(start.year, last.year)
    time = F.col(column)
    return (
        years & days
        & (time >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
        & (time < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
    )


def spread(
    df: DataFrame, columns: Sequence[str], files: int, by: Sequence[str] = ("uuid", "offset")
) -> DataFrame:
    """Gather the rows of one partition value into at most ``files`` tasks.

    Without it, every task writes a file into every partition value it sees.
    Hashing the partition columns alone would give a hot value to one task, so
    its rows are split ``files`` ways by ``by`` (those present, or the whole
    row): content, so that a task run again makes the same split.
    """
    present = [c for c in by if c in df.columns] or df.columns
    salt = F.pmod(F.xxhash64(*present), F.lit(files))
    return df.repartition(*[F.col(c) for c in columns], salt)


def rebalance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Batch writes: let adaptive execution size the output tasks.

    The rebalance hint clusters by the partition columns, splits large ones
    and merges small ones.  Streams run without adaptive execution and use
    :func:`spread`.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])
