"""Which rows differ, found along a tree of digests.

Keys are dealt to branches by their hash.  One pass over each side gives a count and
two digests per branch; only branches that differ are looked at again, row by row.
Where a side is stored by branch the others are not even read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.text import row_sql

MISSING, EXTRA, CHANGED = "missing", "extra", "changed"
#: Reads some branches of a side, or all of them.
Side = Callable[[Sequence[int] | None], DataFrame]


def branch_of(keys: Sequence[str], branches: int) -> Column:
    """The same deal as the buckets of a kept state (``plans.live.bucket_of``)."""
    return F.pmod(F.xxhash64(*keys), F.lit(branches)).cast("int")


def side_of(df: DataFrame, keys: Sequence[str], branches: int) -> Side:
    """A table that is not stored by branch: scanned whole, and filtered."""
    branch = branch_of(keys, branches)
    return lambda wanted: df if wanted is None else df.where(branch.isin(list(wanted)))


def _digested(df: DataFrame, keys: Sequence[str], columns: Sequence[str], branches: int) -> DataFrame:
    text = F.expr(row_sql(df, columns))
    return df.select(
        *keys, branch_of(keys, branches).alias("branch"),
        F.xxhash64(text).alias("one"), F.xxhash64(text, F.lit(1)).alias("two"),
    )


def branch_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], branches: int) -> DataFrame:
    """One row per branch that has rows: n, and what its rows' digests add up to.

    Sums of 32-bit halves see rows that are there twice, which cancel in a xor; they hold
    2**31 rows of a branch.
    """
    rows = _digested(df, keys, columns, branches)
    return rows.groupBy("branch").agg(
        F.count("*").alias("n"), F.sum(F.shiftright("one", 32)).alias("high"),
        F.sum(F.col("one").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.bit_xor("two").alias("two"),
    )


def differing_branches(
    source: Side, target: Side, keys: Sequence[str], columns: Sequence[str], branches: int
) -> list[int]:
    """The branches whose digests differ; at most ``branches`` numbers."""
    names = ("n", "high", "low", "two")
    left = branch_digests(source(None), keys, columns, branches)
    right = branch_digests(target(None), keys, columns, branches).withColumnsRenamed({c: f"{c}_" for c in names})
    equal = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in names]
    differ = ~(equal[0] & equal[1] & equal[2] & equal[3])
    return sorted(r[0] for r in left.join(right, "branch", "full_outer").where(differ).select("branch").collect())


def differing_rows(
    source: Side, target: Side, keys: Sequence[str] = ("uuid",), columns: Sequence[str] | None = None,
    branches: int = 256,
) -> DataFrame:
    """The keys that are ``missing`` or ``extra`` in the target or have ``changed`` rows.

    Columns: the keys and ``difference``.  A key that a side has several times is
    changed unless the other has the same rows as often.  NULL keys count as equal.
    """
    first = source(None)
    columns = list(columns or first.columns)
    wanted = differing_branches(source, target, keys, columns, branches)

    def per_key(side: Side, mark: str) -> DataFrame:
        rows = _digested(side(wanted), keys, columns, branches)
        return rows.groupBy(*[F.col(k).alias(f"{k}{mark}") for k in keys]).agg(
            F.count("*").alias(f"n{mark}"), F.sum(F.col("one").cast("decimal(20,0)")).alias(f"one{mark}"),
            F.sum(F.col("two").cast("decimal(20,0)")).alias(f"two{mark}"),
        )

    left, right = per_key(source, "_s"), per_key(target, "_t")
    same_key = [F.col(f"{k}_s").eqNullSafe(F.col(f"{k}_t")) for k in keys]
    both = left.join(right, same_key, "full_outer")
    equal = (F.col("n_s") == F.col("n_t")) & (F.col("one_s") == F.col("one_t")) & (F.col("two_s") == F.col("two_t"))
    difference = F.when(F.col("n_t").isNull(), MISSING).when(F.col("n_s").isNull(), EXTRA).when(~equal, CHANGED)
    return both.select(
        *[F.coalesce(f"{k}_s", f"{k}_t").alias(k) for k in keys], difference.alias("difference")
    ).where(F.col("difference").isNotNull())
