"""From source changes to lake tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.decode import (
    BAD_OPERATION,
    NO_DATA,
    NO_TOPIC,
    accepted,
    decode_changes,
    open_wrapper,
    parse_metrics,
    project_to_table,
    quarantine_malformed,
    unwrap_data,
    without_data,
)
from changeflow.operators.encode import encode_changes, record_key
from changeflow.operators.layout import DATE_PARTS, add_date_parts
from changeflow.operators.routing import (
    filter_topic,
    keep_inserts,
    route_by_channel_or_table,
    route_default_teleop,
    split_by_presence,
)
from changeflow.operators.state import current_state, dedupe_replays
from changeflow.schemas import (
    BARE,
    EVENT_TOPICS,
    FLAT,
    HOST_METRICS_TOPIC,
    INSERT,
    METRICS,
    NESTED,
    OPERATIONS,
    POSITION,
    ROBOT,
    ROW_TOPICS,
    SHARED_TOPIC,
    TABLES,
    TELEOP,
    change_log_schema,
    table_schema,
)
from changeflow.sources.stream import FILES, read_change_stream
from changeflow.sources.tables import read_table, write_table
from changeflow.streaming.sinks import (
    EVENT_TRIGGER,
    METRICS_TRIGGER,
    Target,
    split_batches,
)

QUARANTINE = "quarantine"
NO_DATA_TABLE = "no_data"
QUARANTINED = T.StructType(
    [T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())] + POSITION.fields
)
WITHOUT_DATA = T.StructType(
    [T.StructField("operation", T.StringType()), T.StructField("raw", T.StringType())] + POSITION.fields
)
ROW_FIELDS = ("uuid", "robot_id", "timestamp", "event_id")
OPTIONAL_FIELDS = ("teleoperator_id",)


def capture_changes(changes: DataFrame) -> DataFrame:
    """Row changes to keyed, routed records of flat events: encode, route, key."""
    encoded = encode_changes(changes, FLAT, ROW_FIELDS, OPTIONAL_FIELDS)
    routed = encoded.withColumn("topic", route_default_teleop(F.col("table")))
    return record_key(routed)


def _opened(notifications: DataFrame) -> DataFrame:
    opened = open_wrapper(notifications)
    channel = F.col("channel") if "channel" in opened.columns else F.lit(None).cast("string")
    return opened.withColumn("_route", route_by_channel_or_table(channel, F.col("table")))


def forward_inserts(notifications: DataFrame) -> DataFrame:
    """Wrapped notifications to bare-row records.

    Only inserts with a row are forwarded, routed by channel or table; records
    for neither table have no topic and are not published.  What should have
    been forwarded and could not be is in :func:`unforwarded`.
    """
    inserts = keep_inserts(_opened(notifications).where(F.col("error").isNull()))
    return unwrap_data(inserts.withColumn("topic", F.col("_route")).drop("_route"))


def unforwarded(notifications: DataFrame) -> DataFrame:
    """What :func:`forward_inserts` could not forward: raw text, reason, position.

    Notifications that do not decode, unknown operations, and inserts without a
    row or for neither table.  Known changes other than inserts are left out by
    both functions.
    """
    opened = _opened(notifications)
    known = F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False))
    is_insert = F.col("operation") == INSERT
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(~known, BAD_OPERATION)
        .when(is_insert & ~F.col("has_data"), NO_DATA)
        .when(is_insert & F.col("_route").isNull(), NO_TOPIC)
    )
    return quarantine_malformed(opened.withColumn("error", reason))


def _table_rows(table: str):
    schema = table_schema(table)
    return lambda batch: project_to_table(
        accepted(filter_topic(batch, EVENT_TOPICS[table])), schema
    )


def replicate_events(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    source_fmt: str = FILES,
    fmt: str = "parquet",
    every: str | None = None,
    once: bool = False,
    max_per_trigger: int | None = None,
    files: int | None = None,
    topics: Sequence[str] = tuple(EVENT_TOPICS.values()),
    source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Flat change events to change-log tables by robot, plus the quarantine.

    ``source_options`` go to the stream reader (security settings,
    ``minPartitions`` to split a large topic partition over several tasks).

    One query reads both topics once.  Lands ``root/robot``, ``root/teleop``
    and ``root/quarantine``.
    """
    records = read_change_stream(
        spark, topics, source, source_fmt, max_per_trigger=max_per_trigger, extra=source_options
    )
    decoded = decode_changes(records, FLAT)
    targets = [Target(f"{root}/{t}", _table_rows(t), ("robot_id",), files) for t in TABLES]
    targets.append(Target(f"{root}/{QUARANTINE}", quarantine_malformed))
    return split_batches(decoded, targets, checkpoint, fmt, every, once, "events")


def replicate_shared_topic(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    source_fmt: str = FILES,
    fmt: str = "parquet",
    every: str | None = None,
    once: bool = False,
    max_per_trigger: int | None = None,
    files: int | None = None,
    source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Nested events of both tables on one topic, split by teleoperator.

    Lands ``root/robot``, ``root/teleop``, ``root/no_data`` (changes without a
    row, of which nothing says the table) and ``root/quarantine``.
    """
    records = read_change_stream(
        spark, SHARED_TOPIC, source, source_fmt, max_per_trigger=max_per_trigger,
        extra=source_options,
    )
    decoded = decode_changes(records, NESTED)

    def rows(table: str):
        side = TABLES.index(table)  # robot: rows without a teleoperator
        return lambda batch: project_to_table(
            split_by_presence(accepted(batch).where("has_data"))[side], table_schema(table)
        )

    targets = [Target(f"{root}/{t}", rows(t), ("robot_id",), files) for t in (ROBOT, TELEOP)]
    targets.append(Target(f"{root}/{NO_DATA_TABLE}", without_data))
    targets.append(Target(f"{root}/{QUARANTINE}", quarantine_malformed))
    return split_batches(decoded, targets, checkpoint, fmt, every, once, "shared_topic")


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}_{QUARANTINE}"


def replicate_rows_by_date(
    spark: SparkSession,
    table: str,
    source: str,
    path: str,
    checkpoint: str,
    source_fmt: str = FILES,
    fmt: str = "parquet",
    every: str | None = EVENT_TRIGGER,
    once: bool = False,
    max_per_trigger: int | None = None,
    files: int | None = None,
    source_options: Mapping[str, str] | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Bare rows of one table to a table partitioned by year, month and day.

    The partition columns follow those of the batch.  What does not decode lands
    in ``quarantine``, by default the path with ``_quarantine`` added.
    """
    records = read_change_stream(
        spark, ROW_TOPICS[table], source, source_fmt, max_per_trigger=max_per_trigger,
        extra=source_options,
    )

    def rows(batch: DataFrame) -> DataFrame:
        schema = table_schema(table, zoned=True)
        return add_date_parts(project_to_table(accepted(batch), schema, POSITION.fieldNames()))

    targets = [
        Target(path, rows, DATE_PARTS, files),
        Target(quarantine or _beside(path), quarantine_malformed),
    ]
    return split_batches(
        decode_changes(records, BARE), targets, checkpoint, fmt, every, once, f"{table}_by_date"
    )


def replicate_metrics(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    kind: str = "host",
    topic: str = HOST_METRICS_TOPIC,
    by_date: bool = False,
    source_fmt: str = FILES,
    fmt: str = "parquet",
    every: str | None = METRICS_TRIGGER,
    once: bool = False,
    max_per_trigger: int | None = None,
    source_options: Mapping[str, str] | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Metrics samples to a table partitioned by host, or by day.

    Never by a measured value: that would make a folder per reading.  What does
    not decode lands in ``quarantine``, by default the path with ``_quarantine``
    added.
    """
    records = read_change_stream(
        spark, topic, source, source_fmt, max_per_trigger=max_per_trigger, extra=source_options
    )
    host = {"host": "hostname", "broker": "broker_id"}.get(kind)
    dated = by_date or host is None

    def samples(batch: DataFrame) -> DataFrame:
        shaped = project_to_table(accepted(batch), METRICS[kind])
        return add_date_parts(shaped) if dated else shaped

    targets = [
        Target(path, samples, DATE_PARTS if dated else (host,)),
        Target(quarantine or _beside(path), quarantine_malformed),
    ]
    return split_batches(
        parse_metrics(records, kind), targets, checkpoint, fmt, every, once, f"{kind}_metrics"
    )


def landed_schema(table: str) -> T.StructType:
    ids = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    return T.StructType(change_log_schema(table).fields + ids)


def read_change_log(
    spark: SparkSession, root: str, table: str, fmt: str = "parquet"
) -> DataFrame:
    """The landed change log of one table."""
    return read_table(spark, f"{root}/{table}", landed_schema(table), fmt)


def replicated_table(
    spark: SparkSession, root: str, table: str, fmt: str = "parquet",
    order: Sequence[str] = ("offset",),
) -> DataFrame:
    """The table as the change log leaves it: its live rows and columns.

    ``order`` as for :func:`changeflow.operators.state.current_state`: records
    that were sent without a key need more than the offset.
    """
    names = table_schema(table).fieldNames()
    position = [c for c in order if c not in names]
    log = read_change_log(spark, root, table, fmt).select("operation", *names, *position)
    return current_state(log, order=order).select(*names)


def compact_log(
    spark: SparkSession, root: str, table: str, target: str, fmt: str = "parquet",
    upto: int | None = None, dedupe: bool = True,
) -> None:
    """Rewrite a landed log into few well-sized files under another path.

    Every micro-batch leaves files of its own; this gathers them by robot and
    removes what several checkpoints landed twice.  ``upto`` takes the batches
    up to that id and prunes the other folders.  A log of one checkpoint has no
    copies: ``dedupe=False`` saves that shuffle.  The landed log is not touched.
    """
    log = read_change_log(spark, root, table, fmt)
    if upto is not None:
        log = log.where(F.col("batch_id") <= upto)
    rows = log.select(*change_log_schema(table).fieldNames())
    if dedupe:
        rows = dedupe_replays(rows)
    write_table(rows, target, ["robot_id"], fmt, mode="overwrite")
