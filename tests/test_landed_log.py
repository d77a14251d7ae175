"""Whole batches, compaction, kept state, replays and differences, without a stream where none is needed."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures, schemas
from changeflow.operators import differences, encode, replays, routing, state
from changeflow.plans import compact, live
from changeflow.sources import stream
from changeflow.streaming import run, whole
from tests.conftest import rows

NOON = dt.datetime(2024, 1, 1, 12)


def batch(spark, changes, topic="robot_events", table="robot"):
    """Landed rows of (uuid, event, operation, offset)."""
    given = [
        (op, key, "RobotID_01", NOON, event, None, topic, 0, offset, NOON, None, None, table)
        for key, event, op, offset in changes
    ]
    fields = [f for f in whole.LANDED.fields if f.name not in ("query_id", "batch_id")]
    return spark.createDataFrame(given, type(whole.LANDED)(fields))


def states(spark, lake, kept):
    return rows(live.read_state(spark, lake, "robot", kept), "uuid", "event_id")


def test_a_batch_that_fails_half_way_is_not_seen(spark, small, fresh, monkeypatch):
    log = fixtures.change_log(fixtures.events(spark, small))
    encoded = encode.encode_changes(log, schemas.FLAT, fixtures.ROW_FIELDS, fixtures.OPTIONAL_FIELDS)
    topics, lake, checkpoint = fresh(), fresh(), fresh()
    records = encode.record_key(encoded.withColumn("topic", routing.route_default_teleop(F.col("table"))))
    stream.publish_changes(records, topics, timestamp="timestamp")
    write = whole.write_batch

    def failing(df, path, *args, **kwargs):
        if path.endswith(whole.BATCHES):
            raise OSError("lost")
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(whole, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        run.finish_all([whole.replicate_whole(spark, topics, lake, checkpoint, once=True)])
    landed = spark.read.schema(whole.LANDED).parquet(f"{lake}/{whole.LOG}")
    assert landed.count() == log.count()
    assert whole.read_whole(spark, lake, "robot").count() == 0
    monkeypatch.setattr(whole, "write_batch", write)
    query = whole.replicate_whole(spark, topics, lake, checkpoint, once=True)
    run.finish_all([query])
    for table in schemas.TABLES:
        expected = log.where(F.col("table") == table)
        found = whole.read_whole(spark, lake, table)
        assert rows(found, "uuid", "operation", "offset") == rows(expected, "uuid", "operation", "offset")


def test_whole_batches_cache_nothing(spark, fresh):
    lake = fresh()
    whole.land_whole(batch(spark, [("a", "x", "INSERT", 0)]), lake, "q", 0)
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    positions = [tuple(r) for r in whole.landed_positions(spark, lake).collect()]
    assert positions == [("robot_events", 0, 0, 0, 1, "q", 0)]


def test_empty_and_repeated_batches(spark, fresh):
    lake = fresh()
    assert whole.read_whole(spark, lake, "robot").count() == 0
    whole.land_whole(batch(spark, []), lake, "q", 0)
    assert whole.whole_ids(spark, lake).count() == 0
    for _ in range(2):
        whole.land_whole(batch(spark, [("a", "x", "INSERT", 0), (None, "y", "INSERT", 1)]), lake, "q", 1)
    assert whole.read_whole(spark, lake, "robot").count() == 2
    assert whole.read_whole(spark, lake, "teleop").count() == 0


def test_undecodable_changes_go_to_the_quarantine(spark):
    decoded = spark.createDataFrame(
        [("INSERT", "a", "robot_events", None), (None, None, "robot_events", "no_key"),
         (None, None, "robot_events", "null_value"), ("INSERT", "b", "elsewhere", None)],
        "operation string, uuid string, topic string, error string",
    ).selectExpr(
        "*", "'r' AS robot_id", "timestamp_ntz'2024-01-01' AS timestamp", "'e' AS event_id",
        "'t' AS teleoperator_id", "0 AS partition", "0L AS offset", "current_timestamp() AS record_timestamp", "'{}' AS raw",
    )
    shown = whole.by_table(decoded).select("table", "uuid", "raw").collect()
    assert sorted((r.table, r.uuid or "", r.raw or "") for r in shown) == [
        ("quarantine", "", "{}"), ("quarantine", "b", ""), ("robot", "a", ""),
    ]


# --- kept state -------------------------------------------------------------------


def test_folds_read_new_batches_and_write_changed_buckets_only(spark, fresh, plan_of):
    lake, kept = fresh("lake"), fresh("state")
    whole.land_whole(batch(spark, [(f"k{i}", "one", "INSERT", i) for i in range(40)]), lake, "q", 0)
    assert live.fold_landed(spark, lake, "robot", kept, buckets=8) == 0
    whole.land_whole(batch(spark, [("k3", "two", "UPDATE", 40), ("k5", "", "DELETE", 41)]), lake, "q", 1)
    newer = live.newer_rows(spark, lake, "robot", live.current_version(spark, kept).folded)
    assert newer.count() == 2
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(newer))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # All scans, of the log and of the batches, are cut by partition.
    assert len(filters) >= 2 and all(re.search(r"batch_id#\w+ > 0", f) for f in filters)
    assert live.fold_landed(spark, lake, "robot", kept) == 1
    now = live.current_version(spark, kept)
    changed = {r[0] for r in spark.createDataFrame([("k3",), ("k5",)], "uuid string").select(live.bucket_of(["uuid"], 8)).collect()}
    assert {b for b, v in now.written.items() if v == 1} == changed
    assert now.buckets == 8 and now.folded == {"q": 1}
    assert states(spark, lake, kept) == sorted((f"k{i}", "two" if i == 3 else "one") for i in range(40) if i != 5)
    assert live.fold_landed(spark, lake, "robot", kept) == 1  # nothing new: no new version


def test_a_fold_that_fails_changes_nothing(spark, fresh, monkeypatch):
    lake, kept = fresh("lake"), fresh("state")
    whole.land_whole(batch(spark, [("a", "one", "INSERT", 0), ("b", "one", "INSERT", 1)]), lake, "q", 0)
    live.fold_landed(spark, lake, "robot", kept, buckets=4)
    whole.land_whole(batch(spark, [("a", "two", "UPDATE", 2)]), lake, "q", 1)
    with monkeypatch.context() as patched:
        patched.setattr(live, "rebalance", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            live.fold_landed(spark, lake, "robot", kept)
    assert states(spark, lake, kept) == [("a", "one"), ("b", "one")]
    live.fold_landed(spark, lake, "robot", kept)
    assert states(spark, lake, kept) == [("a", "two"), ("b", "one")]


def test_late_copies_and_null_keys(spark, fresh):
    lake, kept = fresh("lake"), fresh("state")
    whole.land_whole(batch(spark, [("a", "one", "INSERT", 0), ("a", "", "DELETE", 5)]), lake, "q", 0)
    live.fold_landed(spark, lake, "robot", kept, buckets=4)
    whole.land_whole(batch(spark, [("a", "one", "INSERT", 0), (None, "x", "INSERT", 6)]), lake, "other", 0)
    live.fold_landed(spark, lake, "robot", kept)
    assert states(spark, lake, kept) == []


# --- compaction -------------------------------------------------------------------


def test_compaction_reads_every_batch_once(spark, fresh):
    lake, catalog = fresh("lake"), fresh("catalog")
    compact.init_compacted(spark, {"robot": "compacted_once"}, catalog)

    def offsets():
        return [r.offset for r in compact.read_log(spark, lake, "robot", "compacted_once").orderBy("offset").collect()]

    assert offsets() == [] and compact.compact_batches(spark, lake, "robot", "compacted_once") is None
    for i in range(3):
        whole.land_whole(batch(spark, [(f"k{i}", "x", "INSERT", i)]), lake, "q", i)
    assert compact.compact_batches(spark, lake, "robot", "compacted_once", upto=1).count() == 1
    assert offsets() == [0, 1, 2]
    whole.land_whole(batch(spark, [("k9", "x", "INSERT", 3)]), lake, "second", 0)
    compact.compact_batches(spark, lake, "robot", "compacted_once")
    whole.land_whole(batch(spark, [("k8", "x", "INSERT", 4)]), lake, "q", 3)
    assert offsets() == [0, 1, 2, 3, 4]
    assert spark.table("compacted_once").count() == 4
    spark.sql("DROP TABLE compacted_once")


def test_a_compaction_that_was_not_recorded_is_not_seen(spark, fresh, monkeypatch):
    lake, catalog = fresh("lake"), fresh("catalog")
    compact.init_compacted(spark, {"robot": "compacted_half"}, catalog)
    whole.land_whole(batch(spark, [("a", "x", "INSERT", 0), ("b", "x", "INSERT", 1)]), lake, "q", 0)
    with monkeypatch.context() as patched:
        patched.setattr(compact, "RANGES", "\0")
        with pytest.raises(Exception):
            compact.compact_batches(spark, lake, "robot", "compacted_half")
    assert compact.read_log(spark, lake, "robot", "compacted_half").count() == 2
    compact.compact_batches(spark, lake, "robot", "compacted_half")
    assert rows(compact.read_log(spark, lake, "robot", "compacted_half"), "uuid") == [("a",), ("b",)]
    spark.sql("DROP TABLE compacted_half")


# --- replays ----------------------------------------------------------------------


def test_only_overlapping_batches_are_compared(spark, fresh, plan_of):
    lake = fresh()
    for query, number, offsets in (("a", 0, range(0, 10)), ("a", 1, range(10, 20)), ("b", 0, range(15, 25)), ("b", 1, range(25, 30))):
        whole.land_whole(batch(spark, [(f"k{i}", "x", "INSERT", i) for i in offsets]), lake, query, number)
    positions = whole.landed_positions(spark, lake)
    assert rows(replays.overlapping_batches(positions), "query_id", "batch_id") == [("a", 1), ("b", 0)]
    spans = rows(replays.query_spans(positions), "query_id", "first", "last")
    assert spans == [("a", 0, 19), ("b", 15, 29)]
    found = replays.dedupe_overlaps(whole.read_whole(spark, lake, "robot"), positions)
    assert [r.offset for r in found.orderBy("offset").collect()] == list(range(30))
    assert "SortAggregate" not in plan_of(found)
    assert found.columns == whole.landed_columns("robot")


def test_gaps_do_not_overlap(spark):
    positions = spark.createDataFrame(
        [("t", 0, 0, 9, 10, "a", 0), ("t", 0, 20, 29, 10, "a", 1), ("t", 0, 10, 19, 10, "b", 0), ("t", 1, 0, 99, 9, "b", 0)],
        whole.POSITIONS,
    )
    assert replays.overlapping_batches(positions).count() == 0


# --- positions and differences ----------------------------------------------------


def test_as_of_cuts_each_partition(spark):
    log = spark.createDataFrame([("t", 0, 1), ("t", 0, 2), ("t", 1, 1), ("u", 0, 1)], "topic string, partition int, offset bigint")
    upto = spark.createDataFrame([("t", 0, 1), ("t", 1, 5)], "topic string, partition int, upto bigint")
    assert rows(whole.as_of(log, upto)) == [("t", 0, 1), ("t", 1, 1)]


def test_differences_are_found_by_branch(spark, fresh):
    lake, kept = fresh("lake"), fresh("state")
    whole.land_whole(batch(spark, [(f"k{i}", "one", "INSERT", i) for i in range(200)]), lake, "q", 0)
    live.fold_landed(spark, lake, "robot", kept, buckets=32)
    columns = ["uuid", "event_id"]
    source = live.read_state(spark, lake, "robot", kept).select(*columns)
    asked = []

    def target(wanted):
        asked.append(wanted)
        return live.read_state(spark, lake, "robot", kept, wanted).select(*columns)

    equal = differences.differing_rows(differences.side_of(source, ["uuid"], 32), target, ["uuid"], columns, 32)
    assert equal.count() == 0 and asked == [None, []]
    changed = source.where("uuid <> 'k1'").withColumn(
        "event_id", F.when(F.col("uuid") == "k2", F.lit(None)).otherwise(F.col("event_id"))
    ).unionByName(spark.createDataFrame([("new", "x"), ("k4", "one")], "uuid string, event_id string"))
    found = differences.differing_rows(differences.side_of(changed, ["uuid"], 32), target, ["uuid"], columns, 32)
    assert rows(found) == [("k1", "extra"), ("k2", "changed"), ("k4", "changed"), ("new", "missing")]
    assert 0 < len(asked[-1]) <= 4
    read = live.read_state(spark, lake, "robot", kept, asked[-1]).inputFiles()
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read} <= set(asked[-1])


def test_rows_that_are_there_twice_differ(spark):
    one = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, v string")
    two = spark.createDataFrame([("a", "z"), ("a", "z"), ("b", "y"), (None, "n")], "k string, v string")
    sides = [differences.side_of(df, ["k"], 4) for df in (one, two)]
    assert rows(differences.differing_rows(*sides, ["k"], branches=4)) == [("a", "changed"), (None, "extra")]
    assert differences.differing_rows(sides[0], sides[0], ["k"], branches=4).count() == 0
