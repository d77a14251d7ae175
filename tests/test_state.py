from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import state
from tests.conftest import rows

SCHEMA = "table string, uuid string, operation string, v int, topic string, partition int, offset long"


def random_log(seed, n=800, hot=0.4):
    """Changes of 60 keys, one of which has a large share, shuffled."""
    rng = random.Random(seed)
    log = []
    for offset in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(60)}"
        operation = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        log.append((rng.choice(["robot", "teleop"]), key, operation, offset * 7, "t", 0, offset))
    rng.shuffle(log)
    return log


def brute_force(log):
    last = {}
    for row in sorted(log, key=lambda r: r[6]):
        last[row[:2]] = row
    return sorted((r for r in last.values() if r[2] != "DELETE"), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_current_state(spark, seed):
    log = random_log(seed)
    df = spark.createDataFrame(log, SCHEMA).repartition(5)
    assert rows(state.current_state(df, ["table", "uuid"])) == brute_force(log)
    # Delivering records again changes nothing.
    again = df.unionByName(df.where("uuid = 'hot'")).unionByName(df)
    assert rows(state.current_state(again, ["table", "uuid"])) == brute_force(log)


def test_fold_is_the_same_as_the_whole_log(spark):
    log = random_log(5)
    df = spark.createDataFrame(log, SCHEMA)
    latest = state.latest_changes(df.where("offset < 300"), ["table", "uuid"])
    latest = state.fold_changes(latest, df.where("offset >= 300 AND offset < 310"), ["table", "uuid"])
    latest = state.fold_changes(latest, df.where("offset >= 250"), ["table", "uuid"])
    assert rows(state.drop_deleted(latest)) == brute_force(log)


def test_a_late_replay_does_not_revive_a_deleted_row(spark):
    log = [("robot", "a", "INSERT", 1, "t", 0, 1), ("robot", "a", "DELETE", 1, "t", 0, 2)]
    df = spark.createDataFrame(log, SCHEMA)
    latest = state.latest_changes(df, ["uuid"])
    replayed = state.fold_changes(latest, df.where("offset = 1"), ["uuid"])
    assert state.drop_deleted(replayed).count() == 0


def test_rows_are_combined_before_the_exchange(spark, plan_of):
    df = spark.createDataFrame(random_log(1), SCHEMA)
    plan = plan_of(state.current_state(df, ["table", "uuid"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan[plan.index("Exchange hashpartitioning"):]


def test_dedupe_replays(spark):
    df = spark.createDataFrame(random_log(2), SCHEMA)
    replayed = df.unionByName(df).unionByName(df.where(F.col("uuid") == "hot"))
    assert rows(state.dedupe_replays(replayed)) == rows(df)


def test_a_stream_needs_a_bound(spark, fresh):
    folder = fresh()
    spark.createDataFrame(random_log(2), SCHEMA).write.parquet(folder)
    endless = spark.readStream.schema(SCHEMA).parquet(folder)
    with pytest.raises(ValueError):
        state.dedupe_replays(endless)


def test_a_bucketed_state_is_not_shuffled(spark, fresh, plan_of):
    from changeflow.sources.tables import save_bucketed

    log = random_log(8)
    df = spark.createDataFrame(log, SCHEMA)
    earlier = state.latest_changes(df.where("offset < 500"), ["table", "uuid"])
    save_bucketed(earlier, "state_now", ["table", "uuid"], 4, fresh())
    folded = state.fold_changes(
        spark.table("state_now"), df.where("offset >= 500"), ["table", "uuid"]
    )
    assert rows(state.drop_deleted(folded)) == brute_force(log)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            state.fold_changes(
                spark.table("state_now"), df.where("offset >= 500"), ["table", "uuid"]
            )
        )
        assert plan.count("Exchange hashpartitioning") == 1  # the new part only
        save_bucketed(folded, "state_next", ["table", "uuid"], 4, fresh(), arranged=True)
        following = spark.table("state_next")
        assert rows(state.drop_deleted(following)) == brute_force(log)
        assert len(following.inputFiles()) == 4  # one file per bucket without another shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE state_now")
        spark.sql("DROP TABLE IF EXISTS state_next")
