"""A change log derived from the ``events`` table.

Three consecutive events are one entity: an INSERT, an UPDATE, and an UPDATE or
(every fifth entity) a DELETE.  Even entities are ``robot`` rows, odd ones
``teleop`` rows.  The work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.schemas import DELETE, INSERT, ROBOT, TELEOP, UPDATE

ROW_FIELDS = ("uuid", "robot_id", "timestamp", "event_id")
OPTIONAL_FIELDS = ("teleoperator_id",)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def change_log(events: DataFrame) -> DataFrame:
    """One change per event, ``offset`` in commit order."""
    e = F.col("event_id")
    entity = F.expr("event_id div 3")
    step = e % 3
    return events.select(
        F.md5(entity.cast("string")).alias("uuid"),
        F.when(entity % 2 == 0, ROBOT).otherwise(TELEOP).alias("table"),
        F.concat(F.lit("RobotID_0"), (F.col("user_id") % 3 + 1).cast("string")).alias("robot_id"),
        F.col("ts").alias("timestamp"),
        F.upper("event_type").alias("event_id"),
        F.when(
            entity % 2 == 1, F.concat(F.lit("OPERATOR_"), (F.col("user_id") % 10).cast("string"))
        ).alias("teleoperator_id"),
        F.when(step == 0, INSERT)
        .when((step == 2) & (entity % 5 == 0), DELETE)
        .otherwise(UPDATE)
        .alias("operation"),
        e.alias("offset"),
    )


def source_rows(events: DataFrame) -> DataFrame:
    """What the source tables hold after all changes.

    Derived without the change log's latest-state operator, so that it can
    judge it: an entity's row is the event that no event of the entity follows.
    An entity has three events, so a window group has three rows.
    """
    step = F.expr("event_id % 3")
    entity = F.expr("event_id div 3")
    follower = F.lead("event_id").over(Window.partitionBy(entity).orderBy("event_id"))
    last = events.withColumn("_next", follower).where(F.col("_next").isNull())
    kept = last.where((step != 2) | (entity % 5 != 0))
    return change_log(kept).drop("operation", "offset")


def host_samples(events: DataFrame) -> DataFrame:
    """Host metrics with cumulative disk counters, one sample per event."""
    return events.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("host_"), (F.col("user_id") % 5).cast("string")).alias("hostname"),
        (F.col("value") / 5).alias("cpu_percent"),
        (F.col("value") / 10).alias("memory_percent"),
        (F.col("event_id") * 512).alias("disk_read_total"),
        (F.col("event_id") * 256).alias("disk_write_total"),
        F.col("event_id").alias("offset"),
    )
