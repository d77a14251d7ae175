"""Comparing a source with its target: counts, checksums, verdicts.

Both sides are reduced to a few tall rows ``(table, check_name, side, value,
status)``; only those rows meet.  A check's value is text, so counts and
checksums of any size compare the same way.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.text import digest_number, exact_sum, exact_xor, row_sql
from changeflow.operators.quality import SAMPLE_ROWS, partial_checksum

logger = logging.getLogger(__name__)

# Checks.
ROW_COUNT = "row_count"
KEY_CHECKSUM = "key_checksum"
ROW_CHECKSUM = "row_checksum"
SAMPLE_CHECKSUM = "sample_checksum"
CHECKS = (ROW_COUNT, KEY_CHECKSUM, ROW_CHECKSUM, SAMPLE_CHECKSUM)

# Verdicts.
PASS = "PASS"
FAIL = "FAIL"
SKIPPED = "SKIPPED"  # a side could not be read: no statement
ERROR = "ERROR"      # a side was read, but the check could not be computed

_OK, _UNREADABLE, _BROKEN = "ok", "unreadable", "error"
_STATS = "`table` string, check_name string, side string, value string, status string"


@dataclass(frozen=True)
class Computed:
    """A side whose check values its own database computed, in one row with a
    column per check; see ``sources.postgres.stats_query``."""

    values: DataFrame


Side = DataFrame | Computed | Callable[[], "DataFrame | Computed"] | None


def _missing(
    spark: SparkSession, table: str, side: str, checks: Sequence[str], status: str
) -> DataFrame:
    rows = [(table, check, side, None, status) for check in checks]
    return spark.createDataFrame(rows, _STATS)


def _tall(stats: DataFrame, table: Column, side: str, values: Mapping[str, str]) -> DataFrame:
    """One row per check; ``values`` maps the check to an expression."""
    pairs = ", ".join(f"'{check}', cast({value} AS string)" for check, value in values.items())
    return stats.select(
        table.alias("table"),
        F.expr(f"stack({len(values)}, {pairs}) AS (check_name, value)"),
        F.lit(side).alias("side"),
        F.lit(_OK).alias("status"),
    ).select("table", "check_name", "side", "value", "status")


def _aggregates(
    df: DataFrame, key: str, columns: Sequence[str], checks: Sequence[str]
) -> dict[str, Column]:
    """The checks of one pass over the rows."""
    found = {}
    if ROW_COUNT in checks:
        found[ROW_COUNT] = F.expr("count(*)")
    for check, names in ((KEY_CHECKSUM, [key]), (ROW_CHECKSUM, columns)):
        if check in checks:
            number = digest_number(row_sql(df, names))
            found[check] = F.expr(f"concat_ws(':', {exact_sum(number)}, {exact_xor(number)})")
    return {check: column.alias(check) for check, column in found.items()}


def table_stats(
    df: DataFrame,
    table: str,
    side: str,
    key: str = "uuid",
    columns: Sequence[str] | None = None,
    checks: Sequence[str] = CHECKS,
    sample: int = SAMPLE_ROWS,
) -> DataFrame:
    """The tall rows of one side.  Count and both checksums share one scan."""
    columns = list(columns or df.columns)
    found = _aggregates(df, key, columns, checks)
    parts = []
    if found:
        parts.append(_tall(df.agg(*found.values()), F.lit(table), side, {c: c for c in found}))
    if SAMPLE_CHECKSUM in checks:
        sampled = partial_checksum(df, sample, key, columns)
        # An empty table has a checksum too: that of no rows.
        values = {SAMPLE_CHECKSUM: "coalesce(sample_checksum, '')"}
        parts.append(_tall(sampled, F.lit(table), side, values))
    return reduce(DataFrame.unionByName, parts)


def grouped_stats(
    df: DataFrame,
    side: str,
    by: str = "table",
    key: str = "uuid",
    columns: Sequence[str] | None = None,
    checks: Sequence[str] = (ROW_COUNT, KEY_CHECKSUM, ROW_CHECKSUM),
) -> DataFrame:
    """Tall rows of all tables that one DataFrame holds, in one scan.

    For a side in which ``by`` names each row's table.  The groups are as few
    as the tables, and each task hands on one row per group.
    """
    if SAMPLE_CHECKSUM in checks:
        raise ValueError("a sample is taken table by table: use table_stats")
    columns = list(columns or [c for c in df.columns if c != by])
    found = _aggregates(df, key, columns, checks)
    grouped = df.groupBy(by).agg(*found.values())
    return _tall(grouped, F.col(by), side, {c: c for c in found})


def stats_from_query(
    result: DataFrame, table: str, side: str, checks: Sequence[str] = CHECKS
) -> DataFrame:
    """Tall rows from one row of check values that the source database computed.

    The columns are named after the checks; see ``sources.postgres``.
    """
    values = {check: check for check in checks if check in result.columns}
    return _tall(result, F.lit(table), side, values)


def _build(
    df: DataFrame, table: str, side: str, key: str, columns: Sequence[str] | None,
    checks: Sequence[str], sample: int,
) -> list[DataFrame]:
    """All checks over one scan; if that cannot be planned, each by itself, so
    that only the checks that lack something are errors."""
    try:
        return [table_stats(df, table, side, key, columns, checks, sample)]
    except (AnalysisException, KeyError):
        if len(checks) == 1:
            return [_missing(df.sparkSession, table, side, checks, _BROKEN)]
        return [
            part
            for check in checks
            for part in _build(df, table, side, key, columns, [check], sample)
        ]


def side_stats(
    spark: SparkSession,
    side: str,
    tables: Mapping[str, Side],
    key: str | Mapping[str, str] = "uuid",
    columns: Mapping[str, Sequence[str]] | None = None,
    checks: Sequence[str] = CHECKS,
    sample: int = SAMPLE_ROWS,
) -> DataFrame:
    """Tall rows of every table of one side.

    A table is a DataFrame, its :class:`Computed` values, a function that opens
    either, or None.  One that
    cannot be opened is unreadable; one that opens but lacks a needed column
    is an error.  The verdict tells the two apart.
    """
    parts = []
    for table, opened in tables.items():
        try:
            df = opened() if callable(opened) else opened
        except (PySparkException, Py4JError) as error:
            logger.warning("the %s of table %s cannot be read: %s", side, table, error)
            df = None
        if df is None:
            parts.append(_missing(spark, table, side, checks, _UNREADABLE))
            continue
        if isinstance(df, Computed):
            absent = [c for c in checks if c not in df.values.columns]
            if absent:
                parts.append(_missing(spark, table, side, absent, _BROKEN))
            if len(absent) < len(checks):
                parts.append(stats_from_query(df.values, table, side, checks))
            continue
        name = key if isinstance(key, str) else key[table]
        parts += _build(df, table, side, name, (columns or {}).get(table), checks, sample)
    return reduce(DataFrame.unionByName, parts)


def compare_stats(source: DataFrame, target: DataFrame, tolerance: int = 0) -> DataFrame:
    """One row per table and check: both values and the verdict.

    ``tolerance`` is the difference in rows that a count check allows, for a
    target that a stream is still filling.
    """
    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column)))

    compared = source.unionByName(target).groupBy("table", "check_name").agg(
        of("source", "value").alias("source_value"),
        of("target", "value").alias("target_value"),
        of("source", "status").alias("_source"),
        of("target", "status").alias("_target"),
    )
    src, tgt = F.col("_source"), F.col("_target")
    unread = src.isNull() | tgt.isNull() | (src == _UNREADABLE) | (tgt == _UNREADABLE)
    lag = F.abs(F.col("source_value").try_cast("long") - F.col("target_value").try_cast("long"))
    verdict = (
        F.when(unread, SKIPPED)
        .when((src == _BROKEN) | (tgt == _BROKEN), ERROR)
        .when(F.col("source_value") == F.col("target_value"), PASS)
        .when((F.col("check_name") == ROW_COUNT) & (lag <= tolerance), PASS)
        .otherwise(FAIL)
    )
    return compared.select(
        "table", "check_name", "source_value", "target_value", verdict.alias("verdict")
    )


def reconcile(
    spark: SparkSession,
    sources: Mapping[str, Side],
    targets: Mapping[str, Side],
    key: str | Mapping[str, str] = "uuid",
    columns: Mapping[str, Sequence[str]] | None = None,
    checks: Sequence[str] = CHECKS,
    tolerance: int = 0,
    sample: int = SAMPLE_ROWS,
) -> DataFrame:
    """Compare every table's source and target by the given checks.

    Both sides are always computed, over the same columns with the same
    digest.  Name the columns where the target has more of them.
    """
    return compare_stats(
        side_stats(spark, "source", sources, key, columns, checks, sample),
        side_stats(spark, "target", targets, key, columns, checks, sample),
        tolerance,
    )


def reconcile_counts(
    spark: SparkSession, sources: Mapping[str, Side], targets: Mapping[str, Side], tolerance: int = 0
) -> DataFrame:
    return reconcile(spark, sources, targets, checks=[ROW_COUNT], tolerance=tolerance)


def reconcile_checksums(
    spark: SparkSession,
    sources: Mapping[str, Side],
    targets: Mapping[str, Side],
    key: str | Mapping[str, str] = "uuid",
    columns: Mapping[str, Sequence[str]] | None = None,
    sample: int = SAMPLE_ROWS,
) -> DataFrame:
    checks = [KEY_CHECKSUM, ROW_CHECKSUM, SAMPLE_CHECKSUM]
    return reconcile(spark, sources, targets, key, columns, checks, sample=sample)


def qa_verdict(results: DataFrame) -> DataFrame:
    """One row: was every table compared, and does all that was compared agree?

    A skipped check is a warning, an error is a failure.  Without any result, or
    with a table of which every check was skipped, nothing is proven: not passed.
    """
    verdict = F.col("verdict")
    counts = [F.count_if(verdict == v).alias(f"n_{v.lower()}") for v in (PASS, FAIL, SKIPPED, ERROR)]
    tables = results.groupBy("table").agg(*counts)
    compared = F.coalesce(F.every(F.col("n_pass") + F.col("n_fail") > 0), F.lit(False))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_pass", "n_fail", "n_skipped", "n_error")]
    found = tables.agg(compared.alias("compared"), *totals)
    passed = F.col("compared") & (F.col("n_fail") == 0) & (F.col("n_error") == 0)
    return found.select(passed.alias("passed"), "n_pass", "n_fail", "n_skipped", "n_error")


def exit_code(verdict: DataFrame) -> int:
    """0 when the checks passed, 1 when one failed, 2 when nothing failed but a
    table was not compared; reads the one verdict row."""
    row = verdict.first()
    return 0 if row["passed"] else 1 if row["n_fail"] or row["n_error"] else 2
