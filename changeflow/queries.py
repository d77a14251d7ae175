"""One query per operator over the supplied tables.

Each takes (spark, folder of the tables) and returns a DataFrame.  Streaming
operators publish the change log to file topics in a new working folder, run to
the end of what is there, and return the landed table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import fixtures, schemas
from changeflow.operators import decode, encode, layout, metrics, quality, reconcile, routing, state
from changeflow.plans import qa, replicate
from changeflow.schemas import ROBOT, TABLES, TELEOP
from changeflow.session import work_folder
from changeflow.sources import stream, tables
from changeflow.streaming import run, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROW = [*fixtures.ROW_FIELDS, *fixtures.OPTIONAL_FIELDS]
#: Rows of the log that one task publishes, a file per topic.
FILE_ROWS = 250_000
#: Files that a split sink keeps at a time.
KEPT_FILES = 24


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs --------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.change_log(fixtures.events(spark, sf_dir))


def _encoded(log: DataFrame, envelope: str) -> DataFrame:
    return encode.encode_changes(log, envelope, fixtures.ROW_FIELDS, fixtures.OPTIONAL_FIELDS)


def _records(spark: SparkSession, sf_dir: str, envelope: str) -> DataFrame:
    """Stream records of the whole log in one envelope, flat topics."""
    encoded = _encoded(_log(spark, sf_dir), envelope)
    routed = encoded.withColumn("topic", routing.route_default_teleop(F.col("table")))
    return stream.as_records(encode.record_key(routed), timestamp="timestamp")


def _files_of_a_batch(rows: DataFrame, batches: int) -> int:
    """The files per topic of one of ``batches`` equal batches, so that none has many more than ``FILE_ROWS`` rows."""
    return max(1, -(-rows.count() // (batches * FILE_ROWS)))


def _publish(
    spark: SparkSession, sf_dir: str, envelope: str = schemas.FLAT, topic: Column | None = None,
    batches: int = 3,
) -> tuple[str, int]:
    """Publish the log in offset order; the topics' root, and the files per topic of one of ``batches`` batches.

    A task sorts what it publishes by topic, and a file is often read by one task: the
    files grow in number, not in size.
    """
    log = _log(spark, sf_dir)
    files = _files_of_a_batch(log, batches)
    encoded = _encoded(log, envelope)
    topic = routing.route_default_teleop(F.col("table")) if topic is None else topic
    records = encode.record_key(encoded.withColumn("topic", topic))
    root = work_folder(spark, "topics")
    stream.publish_changes(
        records.repartitionByRange(batches * files, "offset"), root, timestamp="timestamp"
    )
    return root, files


def _by_table(names: dict[str, str]) -> Column:
    return F.when(F.col("table") == ROBOT, names[ROBOT]).otherwise(names[TELEOP])


def _land(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Run a stream to its end through the plain sink and read it back."""
    path, checkpoint = work_folder(spark, "landed"), work_folder(spark, "checkpoint")
    run.finish_all([sinks.append_stream(df, path, checkpoint, once=True)])
    return tables.read_table(spark, path, df.schema)


def _texts(records: DataFrame) -> DataFrame:
    return records.select("topic", F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))


def _rows(decoded: DataFrame, columns: Sequence[str] = ROW) -> DataFrame:
    """Row columns with zone-less timestamps, and the sequence number."""
    shown = [
        F.col(c).cast(T.TimestampNTZType()).alias(c) if c == "timestamp" else F.col(c)
        for c in columns
    ]
    return decoded.select("operation", *shown, F.col("offset").alias("seq"))


# --- sources -------------------------------------------------------------------


@query
def read_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _publish(spark, sf_dir)
    return _texts(_land(spark, stream.read_change_stream(spark, "robot_events", root)))


@query
def read_change_stream_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    records = stream.read_change_stream(
        spark, "teleop_events", root, fail_on_data_loss=False, max_per_trigger=files
    )
    return _texts(_land(spark, records))


@query
def read_change_stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _publish(spark, sf_dir)
    topics = list(schemas.EVENT_TOPICS.values())
    return _texts(_land(spark, stream.read_change_stream(spark, topics, root)))


@query
def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "table")
    log = _log(spark, sf_dir).select(*ROW, "operation", "offset")
    tables.write_table(log, path, ["robot_id"])
    return _rows(tables.read_table(spark, path, log.schema))


@query
def read_source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {"format": "parquet", "path": f"{sf_dir}/orders.parquet"}
    return tables.read_source_table(spark, source).agg(
        F.count("*").alias("row_count"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


# --- sinks ---------------------------------------------------------------------


@query
def append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    records = stream.read_change_stream(spark, "robot_events", root, max_per_trigger=files)
    return _rows(_land(spark, decode.accepted(decode.parse_flat(records))))


@query
def append_stream_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _publish(spark, sf_dir, schemas.BARE, _by_table(schemas.ROW_TOPICS))
    path, checkpoint = work_folder(spark, "by-date"), work_folder(spark, "checkpoint")
    records = stream.read_change_stream(spark, schemas.ROW_TOPICS[TELEOP], root)
    rows = decode.project_to_table(
        decode.accepted(decode.parse_bare(records)), schemas.table_schema(TELEOP, zoned=True),
        schemas.POSITION.fieldNames(),
    )
    started = sinks.append_stream_by_date(rows, path, checkpoint, every=None, once=True)
    run.finish_all([started])
    parts = [T.StructField(p, T.IntegerType()) for p in layout.DATE_PARTS]
    schema = T.StructType(
        schemas.table_schema(TELEOP, zoned=True).fields + schemas.POSITION.fields + parts
    )
    landed = tables.read_table(spark, path, schema)
    return landed.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else c for c in ROW],
        *layout.DATE_PARTS,
        F.col("offset").alias("seq"),
    )


@query
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    records = stream.read_change_stream(spark, "robot_events", root, max_per_trigger=files)
    rows = decode.project_to_table(
        decode.accepted(decode.parse_flat(records)), schemas.table_schema(ROBOT)
    )
    path, checkpoint = work_folder(spark, "batches"), work_folder(spark, "checkpoint")
    run.finish_all([sinks.append_batches(rows, path, checkpoint, once=True, files=4 * files)])
    landed = tables.read_table(spark, path, replicate.landed_schema(ROBOT))
    return _rows(landed, fixtures.ROW_FIELDS)


def _of_each(rows_of: Callable[[str], DataFrame]) -> DataFrame:
    """What both tables' topics give, with the table's name."""
    parts = [rows_of(t).withColumn("tbl", F.lit(t)) for t in TABLES]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query
def append_stream_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)

    def landed(table: str) -> DataFrame:
        records = stream.read_change_stream(spark, schemas.EVENT_TOPICS[table], root, max_per_trigger=files)
        return _land(spark, decode.accepted(decode.parse_flat(records)))

    return _rows(_of_each(landed), ["tbl", *ROW])


@query
def append_stream_by_date_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _publish(spark, sf_dir, schemas.BARE, _by_table(schemas.ROW_TOPICS))

    def landed(table: str) -> DataFrame:
        path, checkpoint = work_folder(spark, "by-date"), work_folder(spark, "checkpoint")
        records = stream.read_change_stream(spark, schemas.ROW_TOPICS[table], root)
        row = schemas.table_schema(table, zoned=True)
        rows = decode.project_to_table(
            decode.accepted(decode.parse_bare(records)), row, schemas.POSITION.fieldNames()
        )
        run.finish_all([sinks.append_stream_by_date(rows, path, checkpoint, every=None, once=True)])
        parts = [T.StructField(p, T.IntegerType()) for p in layout.DATE_PARTS]
        return tables.read_table(spark, path, T.StructType(row.fields + schemas.POSITION.fields + parts))

    return _of_each(landed).select(
        "tbl", *[F.col(c).cast("timestamp_ntz").alias(c) if c == "timestamp" else c for c in ROW],
        *layout.DATE_PARTS,
        F.col("offset").alias("seq"),
    )


def _landed_in_batches(spark: SparkSession, root: str, per_trigger: int, files: int | None = None) -> DataFrame:
    """Both topics, landed to the end, ``per_trigger`` files per batch."""

    def landed(table: str) -> DataFrame:
        path, checkpoint = work_folder(spark, "batches"), work_folder(spark, "checkpoint")
        rows = _event_rows(spark, root, table, per_trigger)
        run.finish_all([sinks.append_batches(rows, path, checkpoint, once=True, files=files)])
        return tables.read_table(spark, path, replicate.landed_schema(table))

    return _of_each(landed)


@query
def append_batches_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    return _rows(_landed_in_batches(spark, root, files, files=4 * files), ["tbl", *ROW])


def _both_tables(spark: SparkSession, root: str) -> DataFrame:
    parts = [
        replicate.read_change_log(spark, root, t).withColumn("tbl", F.lit(t)) for t in TABLES
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query
def split_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.lit(schemas.SHARED_TOPIC)
    root, files = _publish(spark, sf_dir, schemas.NESTED, topic)
    lake, checkpoint = work_folder(spark, "lake"), work_folder(spark, "checkpoint")
    started = replicate.replicate_shared_topic(
        spark, root, lake, checkpoint, once=True, max_per_trigger=min(files, KEPT_FILES)
    )
    run.finish_all([started])
    return _rows(_both_tables(spark, lake), ["tbl", *ROW])


@query
def init_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_folder(spark, "catalog")
    prefix = root.rsplit("-", 1)[1]
    names = {t: f"{t}_{prefix}" for t in TABLES}
    declared = {
        names[t]: (schemas.change_log_schema(t), ["robot_id"]) for t in TABLES
    }
    tables.init_tables(spark, declared, root)
    log = _log(spark, sf_dir).withColumns(
        {"topic": F.lit("log"), "partition": F.lit(0), "record_timestamp": F.col("timestamp")}
    )
    for t in TABLES:
        tables.append_table(log.where(F.col("table") == t), names[t], ["robot_id"])
    tables.init_tables(spark, declared, root)  # a second start keeps the rows
    counts = [
        spark.table(names[t]).groupBy("robot_id").agg(F.count("*").alias("row_count"))
        .select(F.lit(t).alias("tbl"), "robot_id", "row_count")
        for t in TABLES
    ]
    return counts[0].unionByName(counts[1])


@query
def publish_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _publish(spark, sf_dir)
    records = stream.read_change_batch(spark, list(schemas.EVENT_TOPICS.values()), root)
    return records.select(
        F.col("key").cast("string").alias("record_key"),
        "topic",
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
    )


# --- decoding, projection, routing ---------------------------------------------


@query
def decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(decode.decode_value(_records(spark, sf_dir, schemas.FLAT)))


@query
def parse_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(decode.accepted(decode.parse_nested(_records(spark, sf_dir, schemas.NESTED))))


@query
def parse_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.parse_wrapped(_records(spark, sf_dir, schemas.WRAPPED))
    return _rows(decode.accepted(decoded).withColumnRenamed("table", "tbl"), ["tbl", *ROW])


@query
def parse_bare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the producers write the keys in another case."""
    log = _log(spark, sf_dir)
    spelled = {
        "UUID": "uuid", "Robot_ID": "robot_id", "Timestamp": "timestamp", "Event_ID": "event_id",
        "Teleoperator_ID": "teleoperator_id",
    }
    other = encode.to_json_text(F.struct(*[F.col(c).alias(n) for n, c in spelled.items()]))
    encoded = _encoded(log, schemas.BARE).withColumn(
        "value", F.when(F.col("event_id").isin("CLICK", "VIEW"), other).otherwise(F.col("value"))
    )
    records = stream.as_records(encoded.withColumn("topic", F.lit("rows")), timestamp="timestamp")
    return _rows(decode.accepted(decode.parse_bare(records)))


@query
def parse_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.parse_flat(_records(spark, sf_dir, schemas.FLAT))
    return _rows(decode.accepted(decoded).withColumnRenamed("table", "tbl"), ["tbl", *ROW])


def _metric_records(samples: DataFrame, columns: Sequence[str]) -> DataFrame:
    value = encode.to_json_text(F.struct(*columns))
    return samples.select(
        value.alias("value"), F.lit(schemas.HOST_METRICS_TOPIC).alias("topic"), "offset"
    )


def _metrics_shown(parsed: DataFrame, kind: str) -> DataFrame:
    shown = []
    for f in schemas.METRICS[kind].fields:
        if isinstance(f.dataType, T.TimestampType):
            shown.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            shown.append(F.col(f.name).cast("double").alias(f.name))
        else:
            shown.append(F.col(f.name))
    return parsed.select(*shown, F.col("offset").alias("seq"))


@query
def parse_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = fixtures.host_samples(fixtures.events(spark, sf_dir)).select(
        "timestamp", "hostname", "cpu_percent", "memory_percent",
        F.col("disk_read_total").cast("double").alias("disk_io_read"),
        F.col("disk_write_total").cast("double").alias("disk_io_write"),
        "offset",
    )
    records = _metric_records(samples, schemas.HOST_METRICS.fieldNames())
    return _metrics_shown(decode.accepted(decode.parse_metrics(records, "host")), "host")


@query
def parse_metrics_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.events(spark, sf_dir)
    samples = events.select(
        F.concat(F.lit("cpu "), "event_type").alias("cpu"),
        F.col("props").alias("memory"),
        F.col("user_id").cast("string").alias("disk_io"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("offset"),
    )
    records = _metric_records(samples, schemas.TEXT_METRICS.fieldNames())
    return _metrics_shown(decode.accepted(decode.parse_metrics(records, "text")), "text")


@query
def parse_metrics_broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fractional reading of a whole-number field becomes NULL."""
    e = F.col("event_id")
    fractional = F.col("event_type") == "error"
    whole = F.when(fractional, F.col("user_id") + 0.5).otherwise(F.col("user_id").cast("double"))
    samples = fixtures.events(spark, sf_dir).select(
        F.concat(F.lit("broker_"), (F.col("user_id") % 3).cast("string")).alias("broker_id"),
        F.col("ts").alias("timestamp"),
        (e % 400 / 4).alias("cpu_percent"),
        (e % 200 / 2).alias("memory_percent"),
        (e % 64 / 8).alias("disk_read_mbps"),
        (e % 32 / 8).alias("disk_write_mbps"),
        F.when(fractional, whole.cast("string"))
        .otherwise(F.col("user_id").cast("string")).alias("messages_in_per_sec"),
        (e * 1000).alias("bytes_in_per_sec"),
        (e * 10).alias("bytes_out_per_sec"),
        e.alias("offset"),
    )
    records = _metric_records(samples, schemas.BROKER_METRICS.fieldNames())
    return _metrics_shown(decode.accepted(decode.parse_metrics(records, "broker")), "broker")


@query
def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = _log(spark, sf_dir).select(F.struct("uuid", "robot_id", "event_id").alias("data"))
    return decode.flatten(packed, "data")


@query
def filter_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = routing.filter_topic(_records(spark, sf_dir, schemas.FLAT), "robot_events")
    return _rows(decode.accepted(decode.parse_flat(records)), ["uuid", "robot_id"])


@query
def split_by_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.accepted(decode.parse_nested(_records(spark, sf_dir, schemas.NESTED)))
    robot, teleop = routing.split_by_presence(decoded)
    labelled = robot.withColumn("tbl", F.lit(ROBOT)).unionByName(
        teleop.withColumn("tbl", F.lit(TELEOP))
    )
    return _rows(labelled, ["tbl", "uuid", "teleoperator_id"])


@query
def add_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = layout.add_date_parts(_log(spark, sf_dir))
    return dated.select("uuid", *layout.DATE_PARTS, F.col("offset").alias("seq"))


@query
def keep_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.parse_wrapped(_records(spark, sf_dir, schemas.WRAPPED))
    return _rows(routing.keep_inserts(decode.accepted(decoded)))


@query
def route_by_channel_or_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel and table come from different columns, so they may disagree."""
    channel = (
        F.when(F.col("event_type").isin("click", "view"), schemas.CHANNELS[ROBOT])
        .when(F.col("event_type") == "signup", schemas.CHANNELS[TELEOP])
    )
    table = F.when(F.col("event_type") == "error", "unknown").otherwise(
        F.when(F.expr("event_id div 3") % 2 == 0, ROBOT).otherwise(TELEOP)
    )
    return fixtures.events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        routing.route_by_channel_or_table(channel, table).alias("topic"),
    )


@query
def route_default_teleop(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = F.when(F.col("event_type") == "click", ROBOT).when(
        F.col("event_type") == "view", "unknown"
    )
    return fixtures.events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), routing.route_default_teleop(table).alias("topic")
    )


def _encode_query(envelope: str) -> Query:
    def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = _encoded(_log(spark, sf_dir), envelope)
        return events.select("value", F.col("offset").alias("seq"))

    return encoded


QUERIES["encode_nested"] = _encode_query(schemas.NESTED)
QUERIES["encode_wrapped"] = _encode_query(schemas.WRAPPED)


@query
def encode_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From old and new images: a delete carries the old one."""
    row = F.struct(*ROW)
    log = _log(spark, sf_dir)
    deleted = F.col("operation") == schemas.DELETE
    images = log.select(
        "operation", "table", "offset",
        F.when(deleted, row).alias("old"), F.when(~deleted, row).alias("new"),
    )
    return _encoded(images, schemas.FLAT).select("value", F.col("offset").alias("seq"))


def _damaged(
    spark: SparkSession, sf_dir: str, envelope: str = schemas.FLAT, topic: Column | None = None
) -> DataFrame:
    """Records of which most are damaged, each event type in its own way."""
    kind = F.col("event_id")
    value = F.col("value")
    encoded = _encoded(_log(spark, sf_dir), envelope)
    topic = F.lit("changes") if topic is None else topic
    damaged = (
        F.when(kind == "ERROR", F.substring(value, F.lit(1), F.length(value) - 5))
        .when(kind == "SIGNUP", F.concat(F.lit("["), value, F.lit("]")))
        .when(kind == "VIEW", F.replace(value, F.lit('"timestamp":"2024'), F.lit('"timestamp":"noon')))
        .when(kind == "CLICK", F.replace(value, F.lit('"uuid"'), F.lit('"id"')))
        .otherwise(value)
    )
    return encoded.select(damaged.alias("value"), "offset", topic.alias("topic"))


@query
def quarantine_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = decode.quarantine_malformed(decode.parse_flat(_damaged(spark, sf_dir)))
    return bad.select("raw", "error", F.col("offset").alias("seq"))


def _outcomes(landed: dict[str, DataFrame], quarantined: DataFrame) -> DataFrame:
    """Where every record went: a table's name, or the reason against it."""
    found = quarantined.select(F.col("error").alias("outcome"), F.col("offset").alias("seq"))
    for name, rows in landed.items():
        found = found.unionByName(rows.select(F.lit(name).alias("outcome"), F.col("offset").alias("seq")))
    return found


@query
def quarantine_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged rows of both tables: each lands by date or in the quarantine."""
    root = work_folder(spark, "topics")
    topic = _by_table(schemas.ROW_TOPICS)
    stream.publish_changes(_damaged(spark, sf_dir, schemas.BARE, topic), root)
    paths = {t: work_folder(spark, t) for t in TABLES}
    run.finish_all([
        replicate.replicate_rows_by_date(
            spark, t, root, paths[t], work_folder(spark, "checkpoint"), every=None, once=True
        )
        for t in TABLES
    ])
    landed = {
        t: tables.read_table(
            spark, paths[t],
            T.StructType(schemas.table_schema(t, zoned=True).fields + schemas.POSITION.fields),
        )
        for t in TABLES
    }
    bad = [
        tables.read_table(spark, f"{paths[t]}_quarantine", replicate.QUARANTINED) for t in TABLES
    ]
    return _outcomes(landed, bad[0].unionByName(bad[1]))


@query
def quarantine_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of which two in five are damaged."""
    samples = fixtures.host_samples(fixtures.events(spark, sf_dir))
    records = _metric_records(samples, ["timestamp", "hostname", "cpu_percent", "memory_percent"])
    kind, value = F.col("offset") % 5, F.col("value")
    damaged = (
        F.when(kind == 0, F.substring(value, F.lit(1), F.length(value) - 3))
        .when(kind == 1, F.concat(F.lit("["), value, F.lit("]")))
        .otherwise(value)
    )
    root = work_folder(spark, "topics")
    stream.publish_changes(records.withColumn("value", damaged), root)
    path, checkpoint = work_folder(spark, "metrics"), work_folder(spark, "checkpoint")
    run.finish_all(
        [replicate.replicate_metrics(spark, root, path, checkpoint, every=None, once=True)]
    )
    schema = T.StructType(schemas.HOST_METRICS.fields + schemas.POSITION.fields)
    return _outcomes(
        {"landed": tables.read_table(spark, path, schema)},
        tables.read_table(spark, f"{path}_quarantine", replicate.QUARANTINED),
    )


@query
def quarantine_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic for both tables, with damaged events and events without a row."""
    encoded = _encoded(_log(spark, sf_dir), schemas.NESTED)
    kind, value = F.col("event_id"), F.col("value")
    changed = (
        F.when(kind == "ERROR", F.substring(value, F.lit(1), F.length(value) - 5))
        .when(kind == "SIGNUP", F.concat(value, value))
        .when(kind == "VIEW", F.concat(F.lit('{"action":"'), "operation", F.lit('","data":null}')))
        .otherwise(value)
    )
    topic = F.lit(schemas.SHARED_TOPIC)
    root = work_folder(spark, "topics")
    stream.publish_changes(
        encoded.select(changed.alias("value"), "offset", topic.alias("topic")), root
    )
    lake, checkpoint = work_folder(spark, "lake"), work_folder(spark, "checkpoint")
    run.finish_all([replicate.replicate_shared_topic(spark, root, lake, checkpoint, once=True)])
    landed = {t: replicate.read_change_log(spark, lake, t) for t in TABLES}
    landed["no_data"] = tables.read_table(spark, f"{lake}/no_data", replicate.WITHOUT_DATA)
    return _outcomes(
        landed, tables.read_table(spark, f"{lake}/quarantine", replicate.QUARANTINED)
    )


@query
def unforwarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications that are forwarded, and those that should be and cannot be."""
    encoded = _encoded(_log(spark, sf_dir), schemas.WRAPPED)
    kind, value = F.col("event_id"), F.col("value")
    changed = (
        F.when(kind == "ERROR", F.substring(value, F.lit(1), F.length(value) - 5))
        .when(kind == "SIGNUP", F.concat(F.lit("["), value, F.lit("]")))
        .when(kind == "VIEW", F.regexp_replace(value, '"table":"(robot|teleop)"', '"table":"other"'))
        .when(kind == "CLICK", F.replace(value, F.lit('"INSERT"'), F.lit('"BOGUS"')))
        .otherwise(value)
    )
    sent = encoded.select(changed.alias("value"), "offset")
    forwarded = replicate.forward_inserts(sent).where(F.col("topic").isNotNull())
    return _outcomes({"forwarded": forwarded}, replicate.unforwarded(sent))


@query
def decode_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_report(decode.parse_flat(_damaged(spark, sf_dir)))


@query
def record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = encode.record_key(_log(spark, sf_dir))
    return keyed.select(F.col("key").cast("string").alias("record_key"), F.col("offset").alias("seq"))


@query
def unwrap_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts forwarded as bare rows to their topics."""
    forwarded = replicate.forward_inserts(_records(spark, sf_dir, schemas.WRAPPED).drop("topic"))
    return forwarded.select("topic", "value", F.col("offset").alias("seq"))


@query
def counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = fixtures.host_samples(fixtures.events(spark, sf_dir))
    counters = ["disk_read_total", "disk_write_total"]
    deltas = metrics.counter_delta_by_time(samples, counters, order=["timestamp", "offset"])
    return deltas.select(
        "hostname", "disk_read_total_delta", "disk_write_total_delta", F.col("offset").alias("seq")
    )


@query
def project_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.accepted(decode.parse_flat(_records(spark, sf_dir, schemas.FLAT)))
    robot = routing.filter_topic(decoded, "robot_events")
    rows = decode.project_to_table(robot, schemas.table_schema(ROBOT), ["topic", "offset"])
    return rows.withColumnRenamed("offset", "seq")


# --- counts, checksums, constraints --------------------------------------------


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("events", "orders", "customer", "lineitem")
    counts = [
        quality.row_count(spark.read.parquet(f"{sf_dir}/{n}.parquet"))
        .select(F.lit(n).alias("tbl"), "row_count")
        for n in names
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@query
def key_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    parts = [
        quality.key_checksum(log.where(F.col("table") == t)).withColumn("tbl", F.lit(t))
        for t in TABLES
    ]
    return parts[0].unionByName(parts[1])


@query
def table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of three different tables."""
    log = _log(spark, sf_dir)
    parts = [
        quality.table_checksum(df, columns).withColumn("tbl", F.lit(name))
        for name, df, columns in (
            ("log", log, list(fixtures.ROW_FIELDS)),
            ("orders", spark.read.parquet(f"{sf_dir}/orders.parquet"), None),
            ("customer", spark.read.parquet(f"{sf_dir}/customer.parquet"), None),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def partial_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = _log(spark, sf_dir).where(F.col("operation") == schemas.INSERT)
    parts = [
        quality.partial_checksum(inserts.where(F.col("table") == t), columns=fixtures.ROW_FIELDS)
        .withColumn("tbl", F.lit(t))
        for t in TABLES
    ]
    orders = quality.partial_checksum(
        spark.read.parquet(f"{sf_dir}/orders.parquet"), key="o_orderkey"
    ).withColumn("tbl", F.lit("orders"))
    return parts[0].unionByName(parts[1]).unionByName(orders)


@query
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumnRenamed("offset", "seq")
    return quality.row_hash(log, fixtures.ROW_FIELDS, portable=True).select("seq", "row_hash")


@query
def topk_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = _log(spark, sf_dir).where(F.col("operation") == schemas.INSERT)
    return quality.topk_by_key(inserts, columns=[*fixtures.ROW_FIELDS])


@query
def table_checksum_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of_each(lambda t: quality.table_checksum(_log(spark, sf_dir).where(F.col("table") == t), ROW))


@query
def partial_checksum_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = _log(spark, sf_dir).where(F.col("operation") == schemas.INSERT)
    return _of_each(lambda t: quality.partial_checksum(inserts.where(F.col("table") == t), columns=ROW))


@query
def row_hash_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumnRenamed("offset", "seq")
    return quality.row_hash(log, ROW, portable=True).select("seq", "row_hash")


@query
def topk_by_key_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = _log(spark, sf_dir).where(F.col("operation") == schemas.INSERT)
    return quality.topk_by_key(inserts, columns=ROW)


def _source_and_target(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source rows, and the rows recovered from the encoded change log."""
    source = fixtures.source_rows(fixtures.events(spark, sf_dir))
    decoded = decode.accepted(decode.parse_flat(_records(spark, sf_dir, schemas.FLAT)))
    target = state.current_state(decoded, keys=["table", "uuid"])
    return source.select("table", *ROW), target.select("table", *ROW)


def _by_name(df: DataFrame) -> dict[str, DataFrame]:
    return {
        t: df.where(F.col("table") == t).select(*schemas.table_schema(t).fieldNames())
        for t in TABLES
    }


def _sides(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    source, target = _source_and_target(spark, sf_dir)
    return _by_name(source), _by_name(target)


def _shown(results: DataFrame) -> DataFrame:
    return results.withColumnRenamed("table", "tbl")


@query
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reconcile.reconcile_counts(spark, *_sides(spark, sf_dir)))


@query
def reconcile_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reconcile.reconcile_checksums(spark, *_sides(spark, sf_dir)))


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with every verdict: orders agree, a customer balance differs,
    one source cannot be read, one target lacks the key."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    first = F.col("c_custkey") == 0
    changed = customer.withColumn(
        "c_acctbal", F.when(first, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    sources = {
        "orders": orders,
        "customer": customer,
        "supplier": lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet"),
        "part": part,
    }
    targets = {
        "orders": orders,
        "customer": changed,
        "supplier": spark.read.parquet(f"{sf_dir}/supplier.parquet"),
        "part": part.drop("p_partkey"),
    }
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "supplier": "s_suppkey",
            "part": "p_partkey"}
    checks = [reconcile.ROW_COUNT, reconcile.KEY_CHECKSUM, reconcile.ROW_CHECKSUM]
    columns = {"part": part.columns}
    return reconcile.reconcile(spark, sources, targets, keys, columns, checks)


@query
def reconcile_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_faulty(spark, sf_dir)).select("tbl", "check_name", "verdict")


@query
def qa_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.qa_verdict(_faulty(spark, sf_dir))


@query
def batch_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table, from the counts of every landed batch."""
    root, files = _publish(spark, sf_dir)
    counted = []
    for t in TABLES:
        records = stream.read_change_stream(
            spark, schemas.EVENT_TOPICS[t], root, max_per_trigger=files
        )
        rows = decode.accepted(decode.parse_flat(records))
        path, checkpoint = work_folder(spark, "batches"), work_folder(spark, "checkpoint")
        started = sinks.append_batches(rows, path, checkpoint, once=True)
        run.finish_all([started])
        landed = tables.read_table(spark, path, replicate.landed_schema(t))
        counted.append(sinks.batch_row_counts(landed).select(F.lit(t).alias("tbl"), "rows"))
    return counted[0].unionByName(counted[1]).groupBy("tbl").agg(F.sum("rows").alias("row_count"))


@query
def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    return quality.check_not_null(log, schemas.REQUIRED[TELEOP]).withColumnRenamed("column", "col")


@query
def check_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique_key(_log(spark, sf_dir))


@query
def check_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {**schemas.LENGTH_LIMITS, "event_id": 5}
    checked = quality.check_length(_log(spark, sf_dir), limits)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = quality.check_length(documents, {"text": 1000, "source": 50, "lang": 2})
    return checked.unionByName(texts).withColumnRenamed("column", "col")


@query
def default_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.col("event_id") == "ERROR"
    log = _log(spark, sf_dir).withColumn("timestamp", F.when(~missing, F.col("timestamp")))
    filled = quality.default_timestamp(log)
    return filled.select(
        F.col("offset").alias("seq"),
        F.col("timestamp").isNotNull().alias("has_timestamp"),
        F.when(~missing, F.col("timestamp")).alias("given"),
    )


# --- streaming controls --------------------------------------------------------


def _event_rows(spark: SparkSession, root: str, table: str, per_trigger: int | None = None):
    records = stream.read_change_stream(
        spark, schemas.EVENT_TOPICS[table], root, max_per_trigger=per_trigger
    )
    return decode.project_to_table(
        decode.accepted(decode.parse_flat(records)), schemas.table_schema(table)
    )


@query
def trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the files per batch, run to the end: the batches add up to the table."""
    root, files = _publish(spark, sf_dir)
    path, checkpoint = work_folder(spark, "landed"), work_folder(spark, "checkpoint")
    rows = _event_rows(spark, root, ROBOT, per_trigger=files)
    started = sinks.append_batches(rows, path, checkpoint, once=True)
    run.finish_all([started])
    landed = tables.read_table(spark, path, replicate.landed_schema(ROBOT))
    return landed.agg(
        F.count_distinct("batch_id").alias("batches"), F.count("*").alias("row_count")
    )


@query
def trigger_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    landed = _landed_in_batches(spark, root, files)
    return landed.groupBy("tbl").agg(
        F.count_distinct("batch_id").alias("batches"), F.count("*").alias("row_count")
    )


def _publish_part(spark: SparkSession, sf_dir: str, root: str, inserts: bool) -> None:
    log = _log(spark, sf_dir)
    is_insert = F.col("operation") == schemas.INSERT
    part = log.where(is_insert if inserts else ~is_insert)
    stream.publish_changes(replicate.capture_changes(part), root, timestamp="timestamp")


def _two_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish inserts, run; publish the rest, run again from the checkpoint."""
    root = work_folder(spark, "topics")
    path, checkpoint = work_folder(spark, "landed"), work_folder(spark, "checkpoint")
    for inserts in (True, False):
        _publish_part(spark, sf_dir, root, inserts)
        rows = _event_rows(spark, root, TELEOP)
        run.finish_all([sinks.append_batches(rows, path, checkpoint, once=True)])
    return tables.read_table(spark, path, replicate.landed_schema(TELEOP))


@query
def checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_two_starts(spark, sf_dir), ["uuid", "robot_id"])


@query
def batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _two_starts(spark, sf_dir)
    return landed.groupBy("batch_id").agg(F.count("*").alias("row_count"))


@query
def output_mode_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later batches add to the native sink and leave earlier rows alone."""
    root = work_folder(spark, "topics")
    path, checkpoint = work_folder(spark, "landed"), work_folder(spark, "checkpoint")
    for inserts in (True, False):
        _publish_part(spark, sf_dir, root, inserts)
        rows = _event_rows(spark, root, ROBOT)
        run.finish_all([sinks.append_stream(rows, path, checkpoint, once=True)])
    landed = tables.read_table(spark, path, rows.schema)
    return landed.groupBy("operation").agg(F.count("*").alias("row_count"))


def _two_starts_all(spark: SparkSession, sf_dir: str, native: bool = False) -> DataFrame:
    """Both topics: inserts, run; the rest, run again from the checkpoints."""
    root = work_folder(spark, "topics")
    paths = {t: (work_folder(spark, "landed"), work_folder(spark, "checkpoint")) for t in TABLES}
    sink = sinks.append_stream if native else sinks.append_batches
    shapes = {}
    for inserts in (True, False):
        _publish_part(spark, sf_dir, root, inserts)
        for t in TABLES:
            rows = _event_rows(spark, root, t)
            shapes[t] = rows.schema if native else replicate.landed_schema(t)
            run.finish_all([sink(rows, *paths[t], once=True)])
    return _of_each(lambda t: tables.read_table(spark, paths[t][0], shapes[t]))


@query
def checkpoint_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(_two_starts_all(spark, sf_dir), ["tbl", *ROW])


@query
def batch_id_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _two_starts_all(spark, sf_dir)
    return landed.groupBy("tbl", "batch_id").agg(F.count("*").alias("row_count"))


@query
def output_mode_append_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _two_starts_all(spark, sf_dir, native=True)
    return landed.groupBy("tbl", "operation").agg(F.count("*").alias("row_count"))


@query
def run_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables' queries at the same time in one session."""
    root, _ = _publish(spark, sf_dir)
    paths = {t: work_folder(spark, t) for t in TABLES}
    started = [
        sinks.append_batches(
            _event_rows(spark, root, t), paths[t], work_folder(spark, "checkpoint"), once=True
        )
        for t in TABLES
    ]
    run.finish_all(started)
    counts = [
        tables.read_table(spark, paths[t], replicate.landed_schema(t))
        .groupBy("robot_id").agg(F.count("*").alias("row_count"))
        .select(F.lit(t).alias("tbl"), "robot_id", "row_count")
        for t in TABLES
    ]
    return counts[0].unionByName(counts[1])


# --- state ---------------------------------------------------------------------


@query
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.accepted(decode.parse_flat(_records(spark, sf_dir, schemas.FLAT)))
    live = state.current_state(decoded, keys=["table", "uuid"])
    return _rows(live.withColumnRenamed("table", "tbl"), ["tbl", *ROW])


@query
def fold_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier state (inserts only) brought up to date with the rest."""
    log = _log(spark, sf_dir)
    is_insert = F.col("operation") == schemas.INSERT
    earlier = state.latest_changes(log.where(is_insert), ["table", "uuid"])
    latest = state.fold_changes(earlier, log.where(~is_insert), ["table", "uuid"])
    return _rows(state.drop_deleted(latest).withColumnRenamed("table", "tbl"), ["tbl", *ROW])


@query
def dedupe_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with purchases delivered twice."""
    records = _records(spark, sf_dir, schemas.FLAT)
    again = records.where(F.col("value").cast("string").contains('"PURCHASE"'))
    return _texts(state.dedupe_replays(records.unionByName(again)))


@query
def dedupe_replays_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log published twice in offset order, read in three batches.

    The delay exceeds the log's whole span, so no record is late.
    """
    log = _log(spark, sf_dir)
    files = _files_of_a_batch(log, 2)
    encoded = replicate.capture_changes(log)
    root = work_folder(spark, "topics")
    for _ in range(2):
        stream.publish_changes(
            encoded.repartitionByRange(2 * files, "offset"), root, timestamp="timestamp"
        )
    topics = list(schemas.EVENT_TOPICS.values())
    records = stream.read_change_stream(spark, topics, root, max_per_trigger=3 * files)
    return _texts(_land(spark, state.dedupe_replays(records, within="40 days")))


# --- whole runs ----------------------------------------------------------------


@query
def replicate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, files = _publish(spark, sf_dir)
    lake, checkpoint = work_folder(spark, "lake"), work_folder(spark, "checkpoint")
    most = min(2 * files, KEPT_FILES)
    run.finish_all(
        [replicate.replicate_events(spark, root, lake, checkpoint, once=True, max_per_trigger=most)]
    )
    return _rows(_both_tables(spark, lake), ["tbl", *ROW])


@query
def replicate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = fixtures.host_samples(fixtures.events(spark, sf_dir)).select(
        "timestamp", "hostname", "cpu_percent", "memory_percent",
        F.col("disk_read_total").cast("double").alias("disk_io_read"),
        F.col("disk_write_total").cast("double").alias("disk_io_write"),
        "offset",
    )
    root = work_folder(spark, "topics")
    records = _metric_records(samples, schemas.HOST_METRICS.fieldNames())
    keyed = records.withColumn("key", F.get_json_object("value", "$.hostname"))
    files = _files_of_a_batch(samples, 3)
    stream.publish_changes(keyed.repartitionByRange(3 * files, "offset"), root)
    path, checkpoint = work_folder(spark, "metrics"), work_folder(spark, "checkpoint")
    started = replicate.replicate_metrics(
        spark, root, path, checkpoint, every=None, once=True, max_per_trigger=min(files, KEPT_FILES)
    )
    run.finish_all([started])
    schema = T.StructType(
        schemas.HOST_METRICS.fields + schemas.POSITION.fields
        + replicate.landed_schema(ROBOT).fields[-2:]
    )
    return _metrics_shown(tables.read_table(spark, path, schema), "host")


@query
def run_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicate through the stream, then compare with the source rows."""
    root, _ = _publish(spark, sf_dir)
    lake, checkpoint = work_folder(spark, "lake"), work_folder(spark, "checkpoint")
    run.finish_all([replicate.replicate_events(spark, root, lake, checkpoint, once=True)])
    sources, _ = _sides(spark, sf_dir)
    results, _ = qa.run_qa(spark, sources, lake)
    return _shown(results)


@query
def replicated_matches_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, route, decode, derive the state, and compare: a row per table."""
    checks = [reconcile.ROW_COUNT, reconcile.ROW_CHECKSUM]
    source, target = _source_and_target(spark, sf_dir)
    results = reconcile.compare_stats(
        reconcile.grouped_stats(source, "source", checks=checks),
        reconcile.grouped_stats(target, "target", checks=checks),
    )
    return results.groupBy(F.col("table").alias("tbl")).agg(
        *[
            F.max(F.when(F.col("check_name") == check, F.col(f"{side}_value")))
            .alias(f"{side}_{check}")
            for check in checks
            for side in ("source", "target")
        ],
        F.every(F.col("verdict") == reconcile.PASS).alias("matches"),
    )


# The queries over logs of whole batches register themselves here.
from changeflow import log_queries  # noqa: E402, F401
