"""Counts, checksums and constraint checks over any table.

Every statistic is a global aggregate: partial aggregation runs in the scan
tasks and one row per task is exchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.text import (
    digest_number,
    exact_sum,
    exact_xor,
    quoted,
    row_sql,
    row_text,
)

SAMPLE_ROWS = 100  # fixed value: rows in a partial checksum


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``row_count``.  Reads no column."""
    return df.agg(F.count("*").alias("row_count"))


def checksum_columns(text: str) -> list[Column]:
    number = digest_number(text)
    return [
        F.expr(exact_sum(number)).alias("checksum_sum"),
        F.expr(exact_xor(number)).alias("checksum_xor"),
    ]


def key_checksum(df: DataFrame, key: str = "uuid") -> DataFrame:
    """Order-independent checksum of the keys, with the count.

    The sum notices repeated keys, which cancel in the xor; reads one column.
    """
    return df.agg(F.count("*").alias("row_count"), *checksum_columns(row_sql(df, [key])))


def table_checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same over whole rows."""
    return df.agg(F.count("*").alias("row_count"), *checksum_columns(row_sql(df, columns)))


def topk_by_key(
    df: DataFrame, n: int = SAMPLE_ROWS, key: str = "uuid", columns: Sequence[str] | None = None
) -> DataFrame:
    """The first ``n`` rows by key.

    Planned as a top-n per task and a merge of those, never a full sort.  The
    row text breaks ties, so the result is the same on every run.
    """
    columns = list(columns or df.columns)
    ties = [] if columns == [key] else [row_text(df, columns)]
    return df.select(*columns).orderBy(F.col(key), *ties).limit(n)


def partial_checksum(
    df: DataFrame, n: int = SAMPLE_ROWS, key: str = "uuid", columns: Sequence[str] | None = None
) -> DataFrame:
    """MD5 over the concatenated texts of the first ``n`` rows by key.

    It looks at one end of the key space only; :func:`table_checksum` covers
    every row.  NULL for an empty table.
    """
    columns = list(columns or df.columns)
    sample = df.select(F.col(key).alias("_key"), row_text(df, columns).alias("_text"))
    sample = sample.orderBy("_key", "_text").limit(n)
    joined = F.expr("listagg(_text, '') WITHIN GROUP (ORDER BY _key, _text)")
    return sample.agg(F.count("*").alias("sampled_rows"), F.md5(joined).alias("sample_checksum"))


def checksum_by_group(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Count and checksums over whole rows of every group, in one scan; a row per group and task is exchanged."""
    columns = list(columns or [c for c in df.columns if c not in by])
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), *checksum_columns(row_sql(df, columns)))


def topk_by_group(
    df: DataFrame, by: Sequence[str], n: int = SAMPLE_ROWS, key: str = "uuid", columns: Sequence[str] | None = None
) -> DataFrame:
    """The first ``n`` rows by key of every group, in one scan; the row text breaks ties.

    Each task keeps ``n`` rows of a group before the exchange, as long as ``n`` is below
    ``spark.sql.optimizer.windowGroupLimitThreshold``; a larger one is refused.
    """
    return _first_of_groups(df, by, n, key, columns).drop("_key", "_text", "_rank")


def _first_of_groups(df: DataFrame, by: Sequence[str], n: int, key: str, columns: Sequence[str] | None) -> DataFrame:
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n >= limit:
        raise ValueError(f"{n} rows of a group would be cut after the exchange only: give less than {limit}")
    columns = list(columns or [c for c in df.columns if c not in by])
    texts = df.select(*by, *columns, F.col(key).alias("_key"), row_text(df, columns).alias("_text"))
    first = F.row_number().over(Window.partitionBy(*by).orderBy("_key", "_text"))
    return texts.withColumn("_rank", first).where(F.col("_rank") <= n)


def partial_checksum_by_group(
    df: DataFrame, by: Sequence[str], n: int = SAMPLE_ROWS, key: str = "uuid", columns: Sequence[str] | None = None
) -> DataFrame:
    """:func:`partial_checksum` of every group, in one scan."""
    joined = F.expr("listagg(_text, '') WITHIN GROUP (ORDER BY _key, _text)")
    return _first_of_groups(df, by, n, key, columns).groupBy(*by).agg(
        F.count("*").alias("sampled_rows"), F.md5(joined).alias("sample_checksum")
    )


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False) -> DataFrame:
    """Add ``row_hash`` over the named columns.

    The default is Spark's 64-bit xxHash of the raw values, fast and exact
    where Spark reads both sides.  ``portable`` takes the MD5 of the canonical
    row text, which other engines can compute.
    """
    columns = list(columns or df.columns)
    value = F.md5(row_text(df, columns)) if portable else F.xxhash64(*columns)
    return df.withColumn("row_hash", value)


def _per_column(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Count of rows per condition: one pass, one output row per column."""
    counts = df.agg(*[F.expr(f"count_if({c})").alias(f"_{i}") for i, c in enumerate(conditions.values())])
    names = F.array(*[F.lit(column) for column in conditions])
    numbers = F.array(*[f"_{i}" for i in range(len(conditions))])
    pairs = F.arrays_zip(names.alias("column"), numbers.alias("violations"))
    return counts.select(F.inline(pairs)).toDF("column", "violations")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column."""
    return _per_column(df, {c: f"{quoted(c)} IS NULL" for c in columns})


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Values longer than the limit, per column."""
    return _per_column(df, {c: f"length({quoted(c)}) > {n}" for c, n in limits.items()})


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows with a NULL in a required column."""
    return df.where(_any_of([F.col(c).isNull() for c in columns]))


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """The rows with a value that is too long."""
    return df.where(_any_of([F.length(c) > n for c, n in limits.items()]))


def _any_of(conditions: Sequence[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | F.coalesce(condition, F.lit(False))
    return found


def check_unique_key(df: DataFrame, keys: Sequence[str] = ("uuid",)) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Counts are combined before the exchange, so a key with very many copies
    moves one row per task.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counts.where(F.col("copies") > 1)


def default_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """A missing timestamp becomes the current one (fixed per micro-batch)."""
    now = F.current_timestamp().cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(F.col(column), now))
