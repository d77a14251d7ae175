"""A check must fail when it should, and only that check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures
from changeflow.operators import reconcile as R
from tests.conftest import rows

FIELDS = list(fixtures.ROW_FIELDS)


@pytest.fixture(scope="module")
def source(spark):
    live = fixtures.source_rows(fixtures.events(spark, "/root/testdata/sf0.001"))
    return live.select(*FIELDS).cache()


def verdicts(spark, source, target, **options):
    results = R.reconcile(spark, {"t": source}, {"t": target}, **options)
    return {r.check_name: r.verdict for r in results.collect()}


def all_of(verdict, **others):
    return {**dict.fromkeys(R.CHECKS, verdict), **others}


def test_equal_tables_pass(spark, source):
    assert verdicts(spark, source, source.orderBy(F.rand(3))) == all_of(R.PASS)


def test_a_missing_row(spark, source):
    first = source.agg(F.min("uuid")).first()[0]
    assert verdicts(spark, source, source.where(F.col("uuid") != first)) == all_of(R.FAIL)
    last = source.agg(F.max("uuid")).first()[0]
    # The sample looks at the first keys only.
    assert verdicts(spark, source, source.where(F.col("uuid") != last)) == all_of(
        R.FAIL, sample_checksum=R.PASS
    )


def test_a_changed_field(spark, source):
    first = source.agg(F.min("uuid")).first()[0]
    changed = source.withColumn(
        "event_id", F.when(F.col("uuid") == first, "OTHER").otherwise(F.col("event_id"))
    )
    assert verdicts(spark, source, changed) == {
        R.ROW_COUNT: R.PASS, R.KEY_CHECKSUM: R.PASS, R.ROW_CHECKSUM: R.FAIL, R.SAMPLE_CHECKSUM: R.FAIL,
    }


def test_a_duplicated_row(spark, source):
    last = source.agg(F.max("uuid")).first()[0]
    doubled = source.unionByName(source.where(F.col("uuid") == last))
    assert verdicts(spark, source, doubled) == all_of(R.FAIL, sample_checksum=R.PASS)


def test_a_row_exchanged_for_another(spark, source):
    last = source.agg(F.max("uuid")).first()[0]
    swapped = source.withColumn(
        "uuid", F.when(F.col("uuid") == last, "zz").otherwise(F.col("uuid"))
    )
    assert verdicts(spark, source, swapped) == {
        R.ROW_COUNT: R.PASS, R.KEY_CHECKSUM: R.FAIL, R.ROW_CHECKSUM: R.FAIL, R.SAMPLE_CHECKSUM: R.PASS,
    }


def test_two_doubled_keys_do_not_cancel(spark, source):
    last = source.orderBy(F.desc("uuid")).limit(2)
    assert verdicts(spark, source, source.unionByName(last).unionByName(last))[R.KEY_CHECKSUM] == R.FAIL


def test_unreadable_is_skipped_and_a_missing_column_is_an_error(spark, source, fresh):
    missing = fresh("nothing")
    assert verdicts(spark, source, lambda: spark.read.parquet(missing)) == all_of(R.SKIPPED)
    assert verdicts(spark, None, source) == all_of(R.SKIPPED)
    no_database = spark.read.format("jdbc").option("url", "jdbc:none:x").option("dbtable", "t")
    assert verdicts(spark, no_database.load, source) == all_of(R.SKIPPED)
    assert verdicts(spark, source, source.drop("event_id"), columns={"t": FIELDS}) == {
        R.ROW_COUNT: R.PASS, R.KEY_CHECKSUM: R.PASS, R.ROW_CHECKSUM: R.ERROR,
        R.SAMPLE_CHECKSUM: R.ERROR,
    }


def test_values_that_the_source_computed(spark, source):
    stats = R.table_stats(source, "t", "source")
    values = {r.check_name: r.value for r in stats.collect()}
    computed = spark.createDataFrame([tuple(values.values())], list(values))
    assert verdicts(spark, R.Computed(computed), source) == all_of(R.PASS)
    counted = computed.select(R.ROW_COUNT)
    assert verdicts(spark, lambda: R.Computed(counted), source) == all_of(R.ERROR, row_count=R.PASS)
    wrong = computed.withColumn(R.ROW_CHECKSUM, F.lit("0:0"))
    assert verdicts(spark, R.Computed(wrong), source) == all_of(R.PASS, row_checksum=R.FAIL)


def test_a_table_of_one_side_only(spark, source):
    results = R.reconcile(spark, {"a": source, "b": source}, {"a": source})
    found = {(r.table, r.verdict) for r in results.collect()}
    assert found == {("a", R.PASS), ("b", R.SKIPPED)}


def test_tolerance_is_for_counts(spark, source):
    last = source.agg(F.max("uuid")).first()[0]
    short = source.where(F.col("uuid") != last)
    assert verdicts(spark, source, short, tolerance=1)[R.ROW_COUNT] == R.PASS
    assert verdicts(spark, source, short, tolerance=1)[R.KEY_CHECKSUM] == R.FAIL
    assert rows(R.reconcile_counts(spark, {"t": source}, {"t": short}), "verdict") == [(R.FAIL,)]


def test_empty_tables_agree(spark, source):
    none = source.where("uuid = ''")
    assert verdicts(spark, none, none) == all_of(R.PASS)


def test_overall_verdict(spark):
    def overall(*verdicts):
        df = spark.createDataFrame([("t", v) for v in verdicts], "`table` string, verdict string")
        result = R.qa_verdict(df)
        return result.first()["passed"], R.exit_code(result)

    assert overall(R.PASS, R.PASS) == (True, 0)
    assert overall(R.PASS, R.SKIPPED) == (True, 0)
    assert overall(R.PASS, R.FAIL) == (False, 1)
    assert overall(R.ERROR) == (False, 1)
    assert overall() == (False, 2)
    assert overall(R.SKIPPED) == (False, 2)


def test_other_tables(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    dearer = orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") == 7, 0.01).otherwise(0.0) + F.col("o_totalprice")
    )
    assert verdicts(spark, orders, orders, key="o_orderkey") == all_of(R.PASS)
    assert verdicts(spark, orders, dearer, key="o_orderkey")[R.ROW_CHECKSUM] == R.FAIL


def test_grouped_stats_agree_with_one_table_at_a_time(spark, source):
    both = source.withColumn("table", F.lit("a")).unionByName(
        source.where("robot_id = 'RobotID_01'").withColumn("table", F.lit("b"))
    )
    checks = [R.ROW_COUNT, R.KEY_CHECKSUM, R.ROW_CHECKSUM]
    tables = {t: both.where(F.col("table") == t).drop("table") for t in ("a", "b")}
    single = R.side_stats(spark, "source", tables, checks=checks)
    assert rows(R.grouped_stats(both, "source")) == rows(single)
