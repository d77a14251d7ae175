from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures
from changeflow.functions.text import exact_sum, row_text
from changeflow.operators import quality
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


def test_known_checksums(spark):
    """Values measured on this fixture with another engine."""
    log = fixtures.change_log(fixtures.events(spark, SF))
    expected = {
        "robot": ("10708025014903", 1049955289, "ed81674b53ab24eebe2b41d934e28189"),
        "teleop": ("10796722047304", 3213553168, "72372752c34ea6b3ec29fe78221c8c77"),
    }
    for table, (total, xor, sample) in expected.items():
        part = log.where(F.col("table") == table)
        whole = quality.table_checksum(part, fixtures.ROW_FIELDS).first()
        assert (whole.checksum_sum, whole.checksum_xor) == (total, xor)
        inserts = part.where("operation = 'INSERT'")
        first = quality.partial_checksum(inserts, columns=fixtures.ROW_FIELDS).first()
        assert (first.sampled_rows, first.sample_checksum) == (100, sample)


def test_different_rows_have_different_texts(spark):
    data = [
        ("a|b", "c"), ("a", "b|c"), ("a\\|b", "c"), ("a\\", "b|c"), (None, "x"), ("x", None),
        ("\\N", "x"), ("", "x"), ("x", ""), ("a|", "c"), ("a", "|c"),
    ]
    df = spark.createDataFrame(data, "a string, b string")
    texts = [r[0] for r in df.select(row_text(df)).collect()]
    assert len(set(texts)) == len(data)
    assert texts[2] == "a\\\\\\|b|c" and texts[4] == "\\N|x" and texts[6] == "\\\\N|x"
    spark.conf.set("spark.sql.parser.escapedStringLiterals", "true")
    try:
        assert [r[0] for r in df.select(row_text(df)).collect()] == texts
    finally:
        spark.conf.unset("spark.sql.parser.escapedStringLiterals")


def test_row_text_formats(spark):
    row = (
        1, 2.5, decimal.Decimal("3.10"), True, dt.date(2024, 2, 29),
        dt.datetime(2024, 1, 2, 3, 4, 5), bytearray(b"\x01\xff"), None,
    )
    df = spark.createDataFrame(
        [row],
        "i int, d double, m decimal(10,2), b boolean, t date, n timestamp_ntz, x binary, z string",
    )
    text = df.select(row_text(df)).first()[0]
    assert text == "1|2.500000|3.10|true|2024-02-29|2024-01-02 03:04:05.000000|01FF|\\N"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_that_are_hard_to_print(spark, ansi):
    doubles = [float("nan"), float("inf"), float("-inf"), None, 1e-9, 2e-9, 1e35, 1e-300, 2.5, 0.0]
    small = [decimal.Decimal(d) for d in ("0", "0.00000001", "-0.00000012", "1.5")]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for kind in ("double", "float"):
            given = [d for d in doubles if kind == "double" or d not in (1e-300,)]
            df = spark.createDataFrame([(d,) for d in given], f"d {kind}")
            texts = [r[0] for r in df.select(row_text(df)).collect()]
            assert len(set(texts)) == len(given)
            assert texts[:4] == ["NaN", "Infinity", "-Infinity", "\\N"] and texts[-2:] == ["2.500000", "0.000000"]
            rounded = [r[0] for r in df.select(row_text(df, scale=2)).collect()]
            assert rounded[0] == "NaN" and rounded[4] == rounded[5] == "0.00"
        df = spark.createDataFrame([(d,) for d in small], "m decimal(20, 8)")
        assert [r[0] for r in df.select(row_text(df)).collect()] == [
            "0.00000000", "0.00000001", "-0.00000012", "1.50000000",
        ]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_row_text_does_not_depend_on_the_session_zone(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-03-31 02:30:00.5' AS n, timestamp_micros(1711848600123456) AS z"
    )
    expected = "2024-03-31 02:30:00.500000|2024-03-31 01:30:00.123456"
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(row_text(df)).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_exact_sum(spark):
    numbers = [2**32 - 1, 0, 1, 65535, 65536, 2**31] * 50
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    assert df.agg(F.expr(exact_sum("n"))).first()[0] == str(sum(numbers))
    assert df.where("n < 0").agg(F.expr(exact_sum("n"))).first()[0] == "0"


def test_key_checksum_matches_its_definition_and_ignores_order(spark):
    keys = [f"k{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "uuid string")
    numbers = [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) for k in keys]
    xor = 0
    for n in numbers:
        xor ^= n
    expected = (len(keys), str(sum(numbers)), xor)
    assert tuple(quality.key_checksum(df).first()) == expected
    assert tuple(quality.key_checksum(df.orderBy(F.rand(1))).first()) == expected
    empty = quality.key_checksum(df.where("uuid = ''")).first()
    assert tuple(empty) == (0, "0", 0)


def test_partial_checksum(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 0), ("c", 3)], "uuid string, n int")
    expected = hashlib.md5(b"a|0a|1b|2").hexdigest()
    assert tuple(quality.partial_checksum(df, 3).first()) == (3, expected)
    assert tuple(quality.partial_checksum(df.where("n > 9"), 3).first()) == (0, None)


def test_topk_needs_no_full_sort(spark, plan_of, small):
    log = fixtures.change_log(fixtures.events(spark, small))
    plan = plan_of(quality.topk_by_key(log, columns=fixtures.ROW_FIELDS))
    assert "TakeOrderedAndProject" in plan


def test_count_reads_no_column(spark, plan_of, small):
    plan = plan_of(quality.row_count(spark.read.parquet(f"{small}/lineitem.parquet")))
    assert "ReadSchema: struct<>" in plan
    plan = plan_of(
        quality.key_checksum(spark.read.parquet(f"{small}/orders.parquet"), "o_orderkey")
    )
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_constraints(spark):
    data = [("u1", "r", "x" * 51), ("u1", None, "ok"), ("u2", "r", None), (None, "r", "é" * 50)]
    df = spark.createDataFrame(data, "uuid string, robot_id string, event_id string")
    columns = ["uuid", "robot_id", "event_id"]
    assert rows(quality.check_not_null(df, columns)) == [("event_id", 1), ("robot_id", 1), ("uuid", 1)]
    limits = {"uuid": 36, "robot_id": 50, "event_id": 50}
    assert rows(quality.check_length(df, limits)) == [("event_id", 1), ("robot_id", 0), ("uuid", 0)]
    assert quality.not_null_violations(df, columns).count() == 3
    assert rows(quality.length_violations(df, limits), "uuid") == [("u1",)]
    assert rows(quality.check_unique_key(df)) == [("u1", 2)]


def test_default_timestamp(spark):
    df = spark.sql("SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01'), (2, NULL) t(id, timestamp)")
    filled = {r.id: r.timestamp for r in quality.default_timestamp(df).collect()}
    assert filled[1] == dt.datetime(2024, 1, 1)
    assert abs(filled[2] - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(hours=1)


@pytest.mark.parametrize("portable", [True, False])
def test_row_hash_sees_every_column(spark, portable):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("a", None)], "uuid string, n int")
    hashed = quality.row_hash(df, portable=portable)
    assert hashed.select("row_hash").distinct().count() == 4
