"""Does the copy match its source?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from changeflow.operators.reconcile import CHECKS, Side, qa_verdict, reconcile
from changeflow.plans.replicate import replicated_table
from changeflow.schemas import TABLES, table_schema


def run_qa(
    spark: SparkSession,
    sources: Mapping[str, Side],
    root: str,
    fmt: str = "parquet",
    checks: Sequence[str] = CHECKS,
    tolerance: int = 0,
    order: Sequence[str] = ("offset",),
) -> tuple[DataFrame, DataFrame]:
    """Check results per table, and the overall verdict.

    The source is compared with the state derived from the change log: the log
    itself has a row per change, updates and deletes included.  ``order`` orders
    the changes of a key.  A source may be ``reconcile.Computed``: the check
    values that its database computed, so that no row of it is read.
    """
    targets = {t: (lambda t=t: replicated_table(spark, root, t, fmt, order)) for t in TABLES}
    columns = {t: table_schema(t).fieldNames() for t in TABLES}
    results = reconcile(
        spark, sources, targets, columns=columns, checks=checks, tolerance=tolerance
    )
    return results, qa_verdict(results)
