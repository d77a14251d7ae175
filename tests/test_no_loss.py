"""Records and results that must not be lost or taken for good."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from changeflow import schemas
from changeflow.operators import decode, layout, reconcile
from changeflow.sources import stream


def test_only_whole_records_with_a_known_operation(spark):
    row = '"table":"robot","uuid":"a","robot_id":"r","timestamp":"2024-01-01 00:00:00","event_id":"e"}'
    values = {
        '{"operation":"INSERT",' + row: None,
        '{"operation":"delete",' + row: None,
        '{"operation":"BOGUS",' + row: decode.BAD_OPERATION,
        "{" + row: decode.BAD_OPERATION,
        '{"operation":"INSERT",' + row + " garbage": decode.NOT_AN_OBJECT,
        '{"operation":"INSERT",' + row + '{"operation":"INSERT",' + row: decode.NOT_AN_OBJECT,
        '{"operation":"INSERT",' + row + ',{"operation":"INSERT",' + row: decode.NOT_AN_OBJECT,
        '{"OPERATION":"INSERT",' + row + " garbage": decode.NOT_AN_OBJECT,
        '{"OPERATION":"insert",' + row: None,
        '{"operation":"INSERT",' + row.replace('"uuid":"a"', '"uuid":""'): decode.NO_KEY,
    }
    records = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, offset bigint")
    found = decode.parse_flat(records).orderBy("offset").collect()
    assert [r.error for r in found] == list(values.values())
    assert found[1].operation == "DELETE" and found[8].operation == schemas.INSERT
    assert decode.quarantine_malformed(decode.parse_flat(records)).count() == 7


def test_positions_of_file_topics_never_repeat(spark, fresh):
    root = fresh("topics")
    for part in range(3):
        rows = spark.range(50).select(F.concat(F.lit(f"{part}-"), "id").alias("value"), F.lit("t").alias("topic"))
        stream.publish_changes(rows, root)
    read = stream.read_change_batch(spark, ["t"], root)
    assert read.select("topic", "partition", "offset").distinct().count() == 150


def test_nothing_compared_is_not_passed(spark):
    columns = "`table` string, check_name string, verdict string"
    cases = [
        ([], False, 2),
        ([("a", "x", "SKIPPED")], False, 2),
        ([("a", "x", "PASS"), ("b", "x", "SKIPPED")], False, 2),
        ([("a", "x", "PASS"), ("a", "y", "SKIPPED")], True, 0),
        ([("a", "x", "PASS"), ("a", "y", "FAIL")], False, 1),
    ]
    for results, passed, code in cases:
        verdict = reconcile.qa_verdict(spark.createDataFrame(results, columns))
        assert (verdict.first()["passed"], reconcile.exit_code(verdict)) == (passed, code)


def test_date_range_of_aware_times(spark):
    rows = layout.add_date_parts(spark.sql("SELECT timestamp_ntz'2024-01-01 23:30:00' AS timestamp"))
    east = dt.timezone(dt.timedelta(hours=2))
    start = dt.datetime(2024, 1, 2, 1, tzinfo=east)
    assert rows.where(layout.date_range_filter(start, start + dt.timedelta(hours=1))).count() == 1
    assert rows.where(layout.date_range_filter(start + dt.timedelta(hours=1), start + dt.timedelta(hours=2))).count() == 0
