from __future__ import annotations

from pyspark.sql import functions as F

from changeflow.operators import routing
from tests.conftest import rows


def test_route_by_channel_or_table(spark):
    cases = [
        ("robot_changes", "robot", "robot_cdc"),
        ("teleop_changes", "teleop", "teleop_cdc"),
        ("teleop_changes", "robot", "robot_cdc"),   # robot is tested first
        ("robot_changes", "teleop", "robot_cdc"),
        (None, "teleop", "teleop_cdc"),
        ("teleop_changes", None, "teleop_cdc"),
        ("other", "unknown", None),
        (None, None, None),
    ]
    df = spark.createDataFrame(cases, "channel string, tbl string, expected string")
    routed = df.withColumn(
        "topic", routing.route_by_channel_or_table(F.col("channel"), F.col("tbl"))
    )
    assert routed.where(~F.col("topic").eqNullSafe(F.col("expected"))).count() == 0


def test_route_default_teleop(spark):
    df = spark.createDataFrame([("robot",), ("teleop",), ("other",), (None,)], "tbl string")
    routed = df.select("tbl", routing.route_default_teleop(F.col("tbl")).alias("topic"))
    assert rows(routed) == rows(
        spark.createDataFrame(
            [("robot", "robot_events"), ("teleop", "teleop_events"), ("other", "teleop_events"),
             (None, "teleop_events")], "a string, b string",
        )
    )


def test_split_by_presence_is_complete(spark):
    df = spark.createDataFrame([("a", None), ("b", "t"), ("c", "")], "uuid string, teleoperator_id string")
    robot, teleop = routing.split_by_presence(df)
    assert rows(robot, "uuid") == [("a",)]
    assert rows(teleop, "uuid") == [("b",), ("c",)]
