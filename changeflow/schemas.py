"""Schemas of tables, change events, metrics and stream records.

Schemas are declared, never inferred.  Column names are lower snake case; the
decoder folds the case of incoming JSON keys, so ``Robot_ID`` and ``robot_id``
are the same field.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: names that producers and consumers of the events share ----
ROBOT = "robot"
TELEOP = "teleop"
TABLES = (ROBOT, TELEOP)

INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"
OPERATIONS = (INSERT, UPDATE, DELETE)

CHANNELS = {ROBOT: "robot_changes", TELEOP: "teleop_changes"}
EVENT_TOPICS = {ROBOT: "robot_events", TELEOP: "teleop_events"}
ROW_TOPICS = {ROBOT: "robot_cdc", TELEOP: "teleop_cdc"}
SHARED_TOPIC = "cdc_topic"
HOST_METRICS_TOPIC = "kafka_metrics"
TEXT_METRICS_TOPIC = "metrics_topic"

NESTED = "nested"      # {"action": .., "data": {row}}
WRAPPED = "wrapped"    # {"table": .., "action": .., "data": {row}}
BARE = "bare"          # {row}
FLAT = "flat"          # {"operation": .., "table": .., row fields ..}
ENVELOPES = (NESTED, WRAPPED, BARE, FLAT)
# ------------------------------------------------------------------------------

KEY = "uuid"


def table_schema(table: str, zoned: bool = False) -> T.StructType:
    """Row schema of ``robot`` or ``teleop``.

    ``zoned`` selects TIMESTAMP (an instant) for sources that store a zone;
    the default is TIMESTAMP_NTZ, which does not depend on the session zone.
    """
    fields = [
        T.StructField("uuid", T.StringType()),
        T.StructField("robot_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType() if zoned else T.TimestampNTZType()),
        T.StructField("event_id", T.StringType()),
    ]
    if table == TELEOP:
        fields.append(T.StructField("teleoperator_id", T.StringType()))
    elif table != ROBOT:
        raise ValueError(f"unknown table {table!r}; expected one of {TABLES}")
    return T.StructType(fields)


def row_schema(zoned: bool = False) -> T.StructType:
    """The union of both tables' columns: what a change event can carry."""
    return table_schema(TELEOP, zoned)


# Columns that place a record in its stream.  They travel with every decoded
# change because ordering (latest state) and replay removal need them.
POSITION = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_timestamp", T.TimestampType()),
    ]
)

# Schema of Spark's Kafka source, also used for file-backed topics.
STREAM_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def change_log_schema(table: str, zoned: bool = False) -> T.StructType:
    """Schema of a landed change log: operation, row, position."""
    return T.StructType(
        [T.StructField("operation", T.StringType())]
        + table_schema(table, zoned).fields
        + POSITION.fields
    )


TEXT_METRICS = T.StructType(
    [
        T.StructField("cpu", T.StringType()),
        T.StructField("memory", T.StringType()),
        T.StructField("disk_io", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BROKER_METRICS = T.StructType(
    [
        T.StructField("broker_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("cpu_percent", T.FloatType()),
        T.StructField("memory_percent", T.FloatType()),
        T.StructField("disk_read_mbps", T.FloatType()),
        T.StructField("disk_write_mbps", T.FloatType()),
        T.StructField("messages_in_per_sec", T.IntegerType()),
        T.StructField("bytes_in_per_sec", T.LongType()),
        T.StructField("bytes_out_per_sec", T.LongType()),
    ]
)

HOST_METRICS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("cpu_percent", T.DoubleType()),
        T.StructField("memory_percent", T.DoubleType()),
        T.StructField("disk_io_read", T.DoubleType()),
        T.StructField("disk_io_write", T.DoubleType()),
    ]
)

METRICS = {"text": TEXT_METRICS, "broker": BROKER_METRICS, "host": HOST_METRICS}

# VARCHAR limits of the relational tables.
LENGTH_LIMITS = {
    "uuid": 36,
    "robot_id": 50,
    "event_id": 50,
    "teleoperator_id": 50,
}

# NOT NULL columns of the relational tables.
REQUIRED = {
    ROBOT: ("uuid", "robot_id", "timestamp", "event_id"),
    TELEOP: ("uuid", "robot_id", "timestamp", "event_id", "teleoperator_id"),
}
