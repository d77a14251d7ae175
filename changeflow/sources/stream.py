"""Change streams: a broker, or topics kept as parquet files.

Both give the same columns (``key, value, topic, partition, offset, timestamp,
timestampType``), so everything after the source is the same plan.  File topics
are folders ``topic=<name>`` under one root.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schemas import STREAM_RECORD

KAFKA = "kafka"
FILES = "files"


def _names(topics: str | Sequence[str]) -> list[str]:
    return [topics] if isinstance(topics, str) else list(topics)


def kafka_options(
    servers: str,
    topics: str | Sequence[str],
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_records: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    The default starts at the earliest record: changes made before the first
    start belong to the copy.  A checkpoint overrides it on later starts.
    ``fail_on_data_loss=False`` goes on when the broker no longer has some
    offsets; reconciliation then shows the gap.  ``min_partitions`` splits the
    offset ranges into at least that many tasks: a partition that holds much of
    the topic is then read by several.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(_names(topics)),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    options.update(extra or {})
    return options


def file_options(
    root: str, fail_on_data_loss: bool = True, max_files: int | None = None
) -> dict[str, str]:
    options = {"basePath": root, "ignoreMissingFiles": str(not fail_on_data_loss).lower()}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    return options


def _topic_path(root: str, topics: str | Sequence[str]) -> str:
    # Always a glob: a stream takes any other path as its own base path, and
    # the topic would not be a column.
    return f"{root}/topic={{{','.join(_names(topics))}}}"


def read_change_stream(
    spark: SparkSession,
    topics: str | Sequence[str],
    source: str,
    fmt: str = FILES,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Subscribe to one topic or several; ``topic`` stays a column.

    ``source`` is the server list for ``kafka`` and the root folder for
    ``files``.  Only the named topics are read: a broker cannot filter, and
    file topics are chosen by folder.  ``max_per_trigger`` bounds a micro-batch
    (records for ``kafka``, files for ``files``).
    """
    if fmt == KAFKA:
        options = kafka_options(
            source, topics, starting_offsets, fail_on_data_loss, max_per_trigger,
            min_partitions, extra,
        )
        return spark.readStream.format("kafka").options(**options).load()
    options = {**file_options(source, fail_on_data_loss, max_per_trigger), **(extra or {})}
    reader = spark.readStream.schema(STREAM_RECORD).options(**options)
    return reader.parquet(_topic_path(source, topics))


def read_change_batch(
    spark: SparkSession,
    topics: str | Sequence[str],
    source: str,
    fmt: str = FILES,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """The records that the topics hold now, as a batch."""
    if fmt == KAFKA:
        options = {"kafka.bootstrap.servers": source, "subscribe": ",".join(_names(topics))}
        return spark.read.format("kafka").options(**options, **(extra or {})).load()
    reader = spark.read.schema(STREAM_RECORD).option("basePath", source)
    return reader.parquet(_topic_path(source, topics))


def as_records(
    changes: DataFrame, partitions: int = 8, timestamp: str | None = None, first_offset: int = 0
) -> DataFrame:
    """Stream-record columns for file topics, where no broker assigns them.

    Needs ``value`` and ``topic``; takes ``key`` and ``offset`` when present.
    Records of one key share a partition, as a keyed producer would send them.
    """
    have = changes.columns
    key = F.col("key") if "key" in have else F.lit(None)
    key = key.cast("binary")
    offset = F.col("offset") if "offset" in have else F.monotonically_increasing_id() + first_offset
    time = F.col(timestamp) if timestamp else F.current_timestamp()
    return changes.select(
        key.alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("topic"),
        F.coalesce(F.pmod(F.hash(key), F.lit(partitions)), F.lit(0)).alias("partition"),
        offset.cast("long").alias("offset"),
        time.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _next_offset(spark: SparkSession, target: str) -> int:
    """The offset after the largest that the file topics have; 0 if there are none."""
    try:
        there = spark.read.schema(STREAM_RECORD).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return there.agg(F.coalesce(F.max("offset") + 1, F.lit(0))).first()[0]


def publish_changes(
    changes: DataFrame, target: str, fmt: str = FILES, timestamp: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Publish ``key``, ``value`` and ``topic``; rows without a topic stay out.

    A narrow job: each task sends its own rows, no shuffle.  In file topics, rows
    without an ``offset`` follow all that is there already, so no call repeats a
    position; two publishers at the same time must give offsets of their own.
    ``extra`` has the producer's settings (``kafka.acks``, security, compression).
    """
    routed = changes.where(F.col("topic").isNotNull())
    if fmt == KAFKA:
        columns = [c for c in ("key", "value", "topic") if c in routed.columns]
        writer = routed.select(*columns).write.format("kafka")
        writer.options(**{"kafka.bootstrap.servers": target, **(extra or {})}).save()
        return
    first = 0 if "offset" in routed.columns else _next_offset(routed.sparkSession, target)
    as_records(routed, timestamp=timestamp, first_offset=first).write.mode("append").partitionBy("topic").parquet(target)
