"""Choosing topics and splitting streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.schemas import CHANNELS, EVENT_TOPICS, INSERT, ROBOT, ROW_TOPICS, TELEOP


def filter_topic(records: DataFrame, topic: str) -> DataFrame:
    """One topic of a shared stream.

    Brokers do not filter: subscribe to the one topic where only one is needed.
    """
    return records.where(F.col("topic") == topic)


def split_by_presence(
    decoded: DataFrame, column: str = "teleoperator_id"
) -> tuple[DataFrame, DataFrame]:
    """(rows without the column's value, rows with it): robot and teleop.

    Run on accepted records only: an undecodable one has no value either.
    """
    return decoded.where(F.col(column).isNull()), decoded.where(F.col(column).isNotNull())


def keep_inserts(events: DataFrame) -> DataFrame:
    """Inserts that carry a row; NULL and empty data are dropped."""
    return events.where((F.col("operation") == INSERT) & F.col("has_data"))


def route_by_channel_or_table(
    channel: Column, table: Column, topics: Mapping[str, str] = ROW_TOPICS
) -> Column:
    """Topic named by channel or table, robot tested first; NULL for neither."""
    def named(name: str) -> Column:
        return (channel == CHANNELS[name]) | (table == name)

    return F.when(named(ROBOT), topics[ROBOT]).when(named(TELEOP), topics[TELEOP])


def route_default_teleop(table: Column, topics: Mapping[str, str] = EVENT_TOPICS) -> Column:
    """Robot's topic for the robot table, teleop's for anything else."""
    return F.when(table == ROBOT, topics[ROBOT]).otherwise(topics[TELEOP])
