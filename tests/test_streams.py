"""Streams against batches, replays, restarts."""

from __future__ import annotations

import glob
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import fixtures, schemas
from changeflow.operators import decode, layout, state
from changeflow.plans import qa, replicate
from changeflow.sources import stream, tables
from changeflow.streaming import run, sinks
from tests.conftest import rows

ROW = [*fixtures.ROW_FIELDS, *fixtures.OPTIONAL_FIELDS]


@pytest.fixture(scope="module")
def log(spark, small):
    return fixtures.change_log(fixtures.events(spark, small)).cache()


@pytest.fixture(scope="module")
def topics(spark, log, tmp_path_factory):
    """Flat events in three files per topic, damaged records among them."""
    root = str(tmp_path_factory.mktemp("topics") / "root")
    captured = replicate.capture_changes(log)
    stream.publish_changes(captured.repartitionByRange(3, "offset"), root)
    damaged = spark.createDataFrame(
        [("{oops", "robot_events", 5001), (None, "teleop_events", 5002)],
        "value string, topic string, offset long",
    )
    stream.publish_changes(damaged, root)
    return root


def robot_rows(spark, topics, per_trigger=1):
    records = stream.read_change_stream(spark, "robot_events", topics, max_per_trigger=per_trigger)
    return decode.project_to_table(
        decode.accepted(decode.parse_flat(records)), schemas.table_schema("robot")
    )


def expected_robot(log):
    return rows(log.where(F.col("table") == "robot"), *fixtures.ROW_FIELDS, "operation", "offset")


def landed_robot(spark, path):
    return rows(
        tables.read_table(spark, path, replicate.landed_schema("robot")),
        *fixtures.ROW_FIELDS, "operation", "offset",
    )


@pytest.mark.parametrize("files", [None, 4])
def test_batches_equal_the_log_and_are_counted(spark, log, topics, fresh, files):
    path = fresh()
    query = sinks.append_batches(
        robot_rows(spark, topics), path, fresh(), once=True, files=files
    )
    run.finish_all([query])
    assert landed_robot(spark, path) == expected_robot(log)
    counts = sinks.recent_row_counts(query)
    assert len(counts) >= 3 and sum(n for _, n in counts) == len(expected_robot(log))


def test_restart_goes_on_where_it_stopped(spark, log, fresh):
    root, path, checkpoint = fresh("topics"), fresh("landed"), fresh("checkpoint")
    captured = replicate.capture_changes(log)
    ids = set()
    for low in (0, 400, 400):  # the last start finds nothing new
        if low == 0 or not ids & {"second"}:
            part = captured.where((F.col("offset") >= low) & (F.col("offset") < (400 if low == 0 else 10**9)))
            stream.publish_changes(part, root)
        if low:
            ids.add("second")
        query = sinks.append_batches(robot_rows(spark, root), path, checkpoint, once=True)
        run.finish_all([query])
        ids.add(str(query.id))
    assert landed_robot(spark, path) == expected_robot(log)
    assert len(ids) == 2  # one query id over all starts


def test_a_batch_delivered_twice_lands_once(spark, log, fresh):
    path = fresh()
    robot = log.where(F.col("table") == "robot").select(*ROW[:4], "operation", "offset")
    first, second = robot.where("offset < 500"), robot.where("offset >= 500")
    sinks.write_batch(first, path, "q1", 0, ["robot_id"])
    sinks.write_batch(second, path, "q1", 1, ["robot_id"])
    once = spark.read.parquet(path).count()
    sinks.write_batch(second, path, "q1", 1, ["robot_id"])
    sinks.write_batch(first, path, "q1", 0, ["robot_id"])
    assert spark.read.parquet(path).count() == once == robot.count()
    sinks.write_batch(robot.where("offset < 0"), path, "q1", 2, ["robot_id"])  # an empty batch
    assert spark.read.parquet(path).count() == once


def test_a_new_checkpoint_duplicates_and_dedupe_removes(spark, log, topics, fresh):
    path = fresh()
    for _ in range(2):
        run.finish_all(
            [sinks.append_batches(robot_rows(spark, topics), path, fresh(), once=True)]
        )
    landed = tables.read_table(spark, path, replicate.landed_schema("robot"))
    assert landed.count() == 2 * len(expected_robot(log))
    single = state.dedupe_replays(landed)
    assert rows(single, *fixtures.ROW_FIELDS, "operation", "offset") == expected_robot(log)


def test_split_lands_every_record_somewhere(spark, log, topics, fresh):
    lake = fresh("lake")
    query = replicate.replicate_events(
        spark, topics, lake, fresh(), once=True, max_per_trigger=2, files=3
    )
    run.finish_all([query])
    assert landed_robot(spark, f"{lake}/robot") == expected_robot(log)
    teleop = replicate.read_change_log(spark, lake, "teleop")
    assert rows(teleop, *ROW, "offset") == rows(
        log.where(F.col("table") == "teleop"), *ROW, "offset"
    )
    bad = spark.read.parquet(f"{lake}/quarantine")
    assert rows(bad, "raw", "error", "offset") == [("{oops", "not_json_object", 5001)]
    # Every record of the stream counted once, although three tables are written.
    assert sum(n for _, n in sinks.recent_row_counts(query)) == log.count() + 2


def test_qa_over_a_replicated_lake(spark, log, topics, small, fresh):
    lake = fresh("lake")
    run.finish_all([replicate.replicate_events(spark, topics, lake, fresh(), once=True)])
    live = fixtures.source_rows(fixtures.events(spark, small))
    sources = {
        t: live.where(F.col("table") == t).select(*schemas.table_schema(t).fieldNames())
        for t in schemas.TABLES
    }
    results, verdict = qa.run_qa(spark, sources, lake)
    assert results.count() == 8 and verdict.first()["passed"]
    sources["teleop"] = sources["teleop"].where("robot_id <> 'RobotID_01'")
    results, verdict = qa.run_qa(spark, sources, lake)
    assert not verdict.first()["passed"]
    assert {r.table for r in results.where("verdict = 'FAIL'").collect()} == {"teleop"}
    results, verdict = qa.run_qa(spark, sources, fresh("no_lake"))
    assert {r.verdict for r in results.collect()} == {"SKIPPED"}


def test_nested_events_split_by_presence(spark, log, fresh):
    from changeflow.operators.encode import encode_changes

    root, lake = fresh("topics"), fresh("lake")
    encoded = encode_changes(log, schemas.NESTED, fixtures.ROW_FIELDS, fixtures.OPTIONAL_FIELDS)
    empty = spark.createDataFrame(
        [('{"action":"DELETE","data":null}', 9001), ("[]", 9002)], "value string, offset long"
    )
    shared = encoded.select("value", "offset").unionByName(empty)
    stream.publish_changes(shared.withColumn("topic", F.lit(schemas.SHARED_TOPIC)), root)
    run.finish_all([replicate.replicate_shared_topic(spark, root, lake, fresh(), once=True)])
    # A record without a row must not count as a robot row.
    assert landed_robot(spark, f"{lake}/robot") == expected_robot(log)
    assert rows(spark.read.parquet(f"{lake}/quarantine"), "raw") == [("[]",)]
    assert rows(spark.read.parquet(f"{lake}/no_data"), "operation", "offset") == [("DELETE", 9001)]


def test_forwarded_rows_by_date(spark, log, fresh, plan_of):
    from changeflow.operators.encode import encode_changes

    root, path = fresh("topics"), fresh("landed")
    wrapped = encode_changes(log, schemas.WRAPPED, fixtures.ROW_FIELDS, fixtures.OPTIONAL_FIELDS)
    stream.publish_changes(replicate.forward_inserts(wrapped.select("value", "offset")), root)
    query = replicate.replicate_rows_by_date(
        spark, "robot", root, path, fresh(), every=None, once=True, files=2
    )
    run.finish_all([query])
    parts = [T.StructField(p, T.IntegerType()) for p in layout.DATE_PARTS]
    schema = T.StructType(schemas.table_schema("robot").fields + parts)
    landed = tables.read_table(spark, path, schema)
    inserts = log.where("operation = 'INSERT' AND table = 'robot'")
    assert rows(landed, *fixtures.ROW_FIELDS) == rows(inserts, *fixtures.ROW_FIELDS)

    import datetime as dt

    start, end = dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 1, 9, 7, 30)
    ranged = landed.where(layout.date_range_filter(start, end))
    expected = inserts.where((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
    assert rows(ranged, "uuid") == rows(expected, "uuid") and ranged.count() > 0
    assert "PartitionFilters: [isnotnull(year" in plan_of(ranged)


@pytest.mark.parametrize("kind", ["host", "broker", "text"])
@pytest.mark.parametrize("by_date", [False, True])
def test_metrics(spark, fresh, kind, by_date):
    from changeflow.operators.encode import to_json_text

    schema = schemas.METRICS[kind]
    when = "timestamp '2024-01-0{} 00:00:00'"
    samples = [
        spark.sql("SELECT " + ", ".join(
            f"{when.format(d)} AS timestamp" if f.name == "timestamp"
            else f"CAST({d} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields
        ))
        for d in (1, 2, 3)
    ]
    df = samples[0].unionByName(samples[1]).unionByName(samples[2])
    root, path = fresh("topics"), fresh("landed")
    values = df.select(to_json_text(F.struct(*schema.fieldNames())).alias("value"))
    bad = spark.createDataFrame([("nonsense",)], "value string")
    published = values.unionByName(bad).withColumn("topic", F.lit("m"))
    stream.publish_changes(published, root)
    query = replicate.replicate_metrics(
        spark, root, path, fresh(), kind, "m", by_date, every=None, once=True
    )
    run.finish_all([query])
    names = schema.fieldNames()
    assert rows(spark.read.schema(schema).parquet(path), *names) == rows(df, *names)
    assert rows(spark.read.parquet(f"{path}_quarantine"), "raw", "error") == [
        ("nonsense", decode.NOT_AN_OBJECT)
    ]
    folders = glob.glob(f"{path}/**/*=*", recursive=True)
    assert any("year=" in f for f in folders) == (by_date or kind == "text")


def test_native_stream_equals_the_log(spark, log, topics, fresh):
    path, checkpoint = fresh(), fresh()
    rows_in = robot_rows(spark, topics)
    query = sinks.append_stream(rows_in, path, checkpoint, once=True)
    run.finish_all([query])
    landed = tables.read_table(spark, path, rows_in.schema)
    assert "Exchange" not in query._jsq.explainInternal(False)  # narrow from source to file
    assert rows(landed, *fixtures.ROW_FIELDS, "operation", "offset") == expected_robot(log)
    assert sum(n for _, n in sinks.recent_row_counts(query)) == len(expected_robot(log))


def test_stream_dedupe(spark, log, fresh):
    root, path = fresh("topics"), fresh("landed")
    captured = replicate.capture_changes(log)
    for _ in range(2):
        stream.publish_changes(captured, root, timestamp="timestamp")
    records = stream.read_change_stream(spark, "robot_events", root, max_per_trigger=1)
    unique = state.dedupe_replays(records, within="40 days")
    run.finish_all([sinks.append_stream(unique, path, fresh(), once=True)])
    landed = tables.read_table(spark, path, unique.schema)
    assert rows(landed, "offset") == rows(log.where("table = 'robot'"), "offset")


def test_processing_time_trigger_and_run_many(spark, topics, fresh):
    paths = [fresh(), fresh()]
    queries = [
        sinks.append_batches(
            robot_rows(spark, topics), p, fresh(), every="1 second", name=f"timed_{i}"
        )
        for i, p in enumerate(paths)
    ]
    deadline = time.time() + 60
    while time.time() < deadline and not all(len(sinks.recent_row_counts(q)) >= 3 for q in queries):
        time.sleep(0.2)
    queries[0].stop()
    run.run_many(spark, queries)  # one has ended, so this returns and stops the other
    assert not any(q.isActive for q in queries)


def test_a_failing_query_raises(spark, topics, fresh):
    def fail(batch, batch_id):
        raise RuntimeError("no room")

    healthy = sinks.append_batches(robot_rows(spark, topics), fresh(), fresh(), every="1 second")
    failing = robot_rows(spark, topics).writeStream.foreachBatch(fail)
    failing = failing.option("checkpointLocation", fresh()).start()
    with pytest.raises(Exception, match="no room"):
        run.run_many(spark, [healthy, failing])
    assert not healthy.isActive


def test_a_query_that_failed_before_stops_no_others(spark, topics, fresh):
    def fail(batch, batch_id):
        raise RuntimeError("no room")

    failing = robot_rows(spark, topics).writeStream.foreachBatch(fail)
    failing = failing.option("checkpointLocation", fresh()).start()
    with pytest.raises(Exception, match="no room"):
        failing.awaitTermination(60)
    started = sinks.append_batches(robot_rows(spark, topics), fresh(), fresh(), once=True)
    run.run_many(spark, [started])
    assert not started.isActive


def test_a_checkpoint_is_required(spark, topics, fresh):
    with pytest.raises(ValueError):
        sinks.append_stream(robot_rows(spark, topics), fresh(), "")


def test_event_path_has_no_shuffle_and_reads_one_topic(spark, topics, plan_of):
    records = stream.read_change_batch(spark, "robot_events", topics)
    plan = plan_of(decode.accepted(decode.parse_flat(records)))
    assert "Exchange" not in plan
    assert "topic=teleop" not in " ".join(records.inputFiles())
    both = stream.read_change_batch(spark, list(schemas.EVENT_TOPICS.values()), topics)
    decoded = decode.accepted(decode.parse_flat(both))
    assert "PartitionFilters: [isnotnull(topic" in plan_of(decoded.where("topic = 'robot_events'"))


def test_compaction_keeps_the_rows_in_fewer_files(spark, log, topics, fresh):
    lake, target = fresh("lake"), fresh("compacted")
    for _ in range(2):  # the second start without its checkpoint repeats everything
        run.finish_all(
            [replicate.replicate_events(spark, topics, lake, fresh(), once=True, max_per_trigger=1)]
        )
    replicate.compact_log(spark, lake, "robot", target)
    compacted = tables.read_table(spark, target, schemas.change_log_schema("robot"))
    assert rows(compacted, *fixtures.ROW_FIELDS, "operation", "offset") == expected_robot(log)
    assert len(compacted.inputFiles()) == 3 < len(
        replicate.read_change_log(spark, lake, "robot").inputFiles()
    )
