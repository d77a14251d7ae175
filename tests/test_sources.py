from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from changeflow import fixtures, schemas, session
from changeflow.sources import stream, tables
from tests.conftest import rows


def test_kafka_options():
    assert stream.kafka_options("host:9092", ["a", "b"]) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    loose = stream.kafka_options("h", "a", "latest", False, 1000, 64, {"groupIdPrefix": "x"})
    assert loose["minPartitions"] == "64"
    assert loose["startingOffsets"] == "latest" and loose["failOnDataLoss"] == "false"
    assert loose["maxOffsetsPerTrigger"] == "1000" and loose["groupIdPrefix"] == "x"


def test_jdbc_options():
    whole = tables.jdbc_options("jdbc:x", "robot", partition=("id", "0", "9", 4))
    assert whole["dbtable"] == "robot" and whole["numPartitions"] == "4"
    assert (whole["partitionColumn"], whole["lowerBound"], whole["upperBound"]) == ("id", "0", "9")
    count = tables.jdbc_options("jdbc:x", query=tables.count_query("robot"))
    assert count["query"] == "SELECT COUNT(*) AS row_count FROM robot" and "dbtable" not in count
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", "0", "9", 4))


def test_keys_choose_the_partition(spark, small):
    log = fixtures.change_log(fixtures.events(spark, small))
    records = stream.as_records(
        log.select(F.col("uuid").alias("key"), F.lit("{}").alias("value"), F.lit("t").alias("topic"), "offset")
    )
    assert [f.name for f in records.schema] == schemas.STREAM_RECORD.fieldNames()
    spread = records.groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert spread.where("n > 1").count() == 0
    assert records.select("partition").distinct().count() == 8


def test_rows_without_a_topic_are_not_published(spark, fresh):
    root = fresh()
    df = spark.createDataFrame([("a", "t"), ("b", None)], "value string, topic string")
    stream.publish_changes(df, root)
    read = stream.read_change_batch(spark, "t", root)
    assert rows(read, F.col("value").cast("string")) == [("a",)]


def test_init_tables_keeps_rows(spark, fresh):
    root = fresh()
    declared = {"kept_robot": (schemas.table_schema("robot"), ["robot_id"])}
    tables.init_tables(spark, declared, root)
    assert spark.table("kept_robot").count() == 0
    row = spark.sql("SELECT 'u' uuid, 'r' robot_id, timestamp_ntz'2024-01-01' timestamp, 'e' event_id")
    tables.append_table(row, "kept_robot", ["robot_id"])
    tables.init_tables(spark, declared, root)
    assert rows(spark.table("kept_robot"), "uuid", "robot_id") == [("u", "r")]
    tables.init_tables(spark, declared, root, overwrite=True)
    assert spark.table("kept_robot").count() == 0
    spark.sql("DROP TABLE kept_robot")


def test_an_empty_table_is_readable_and_a_missing_one_is_not(spark, fresh):
    path = fresh()
    schema = schemas.table_schema("robot")
    tables.write_table(spark.createDataFrame([], schema), path, ["robot_id"])
    assert tables.read_table(spark, path, schema).count() == 0
    with pytest.raises(AnalysisException):
        tables.read_table(spark, fresh("missing"), schema)


def test_a_hot_partition_value_is_written_by_several_tasks(spark, fresh):
    from changeflow.operators.layout import spread

    df = spark.range(20000).select(
        F.md5(F.col("id").cast("string")).alias("uuid"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("robot_id"),
    )
    # Streams run without adaptive execution, which would merge this little data.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = spread(df, ["robot_id"], 16).where("robot_id = 'hot'")
        assert tasks.select(F.spark_partition_id()).distinct().count() == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_source_snapshot(spark, small):
    source = {"format": "parquet", "path": f"{small}/orders.parquet"}
    assert tables.read_source_table(spark, source).count() == 1500


def test_session_settings():
    conf = session.session_config(
        master="local[2]", delta=True, checkpoint_location="/c", shuffle_partitions=9,
        object_store={"endpoint": "http://store:9000"},
    )
    assert conf["spark.sql.streaming.checkpointLocation"] == "/c"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.sql.shuffle.partitions"] == "9"
    assert "delta" in conf["spark.sql.extensions"]
    with pytest.raises(ValueError):
        session.session_config(object_store={"secret.key": "x"})


def test_work_folders_are_under_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_folder(spark, "a"), session.work_folder(spark, "a")
    assert first != second and first.startswith(shared)


def test_source_side_queries():
    """The texts that PostgreSQL runs; no server is started to run them."""
    from changeflow.sources import postgres

    schema = schemas.table_schema("robot")
    assert postgres.row_sql(schema, ["uuid", "timestamp"]) == (
        r"concat_ws('|', coalesce(replace(replace(uuid, '\', '\\'), '|', '\|'), '\N'), "
        r"coalesce(to_char(timestamp, 'YYYY-MM-DD HH24:MI:SS.US'), '\N'))"
    )
    text = postgres.stats_query("robot", schema)
    for check in ("row_count", "key_checksum", "row_checksum", "sample_checksum"):
        assert f" AS {check}" in text
    assert text.endswith(" FROM robot") and "LIMIT 100" in text
    zoned = postgres.value_sql("t", schemas.table_schema("robot", zoned=True)["timestamp"].dataType)
    assert "AT TIME ZONE 'UTC'" in zoned
    with pytest.raises(ValueError):
        from pyspark.sql import types as T
        postgres.value_sql("m", T.MapType(T.StringType(), T.StringType()))


def test_stats_from_a_query_compare_with_spark_stats(spark):
    from changeflow.operators import reconcile as R

    df = spark.createDataFrame([("a", 1), ("b", None)], "uuid string, n int")
    stats = R.table_stats(df, "t", "target")
    found = {r.check_name: r.value for r in stats.collect()}
    computed = spark.createDataFrame([tuple(found[c] for c in R.CHECKS)], list(R.CHECKS))
    results = R.compare_stats(R.stats_from_query(computed, "t", "source"), stats)
    assert {r.verdict for r in results.collect()} == {R.PASS} and results.count() == 4


def test_source_text_equals_ours(spark):
    """The parts of the source-side text that another engine here can run."""
    import duckdb
    from changeflow.functions.text import row_text
    from changeflow.sources import postgres

    data = [
        ("a|b", 1, 2.5, True), ("a\\|b", -7, 0.1, False), ("", 2**40, -3.25, True),
        (None, None, None, None), ("\\N", 0, 1e6, False), ("é😀", 5, 12345.678901, True),
        ("n", 1, float("nan"), True), ("i", 2, float("inf"), True), ("j", 3, float("-inf"), True),
    ]
    df = spark.createDataFrame(data, "s string, n long, d double, b boolean")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s VARCHAR, n BIGINT, d DOUBLE, b BOOLEAN)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", data)
    theirs = con.execute(f"SELECT {postgres.row_sql(df.schema)} FROM t").fetchall()
    assert sorted(r[0] for r in theirs) == sorted(r[0] for r in df.select(row_text(df)).collect())
