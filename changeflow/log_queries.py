"""Queries over logs of whole batches: commits, compaction, kept state, replays, differences.

The change log is published in three parts, in order; between them the streams run to
the end of what is there, as a job that starts every few minutes does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import fixtures, schemas
from changeflow.operators import decode, differences, encode, quality, reconcile, replays, routing, state
from changeflow.plans import compact, constraints, live
from changeflow.queries import ROW, _encoded, _log, query
from changeflow.schemas import TABLES
from changeflow.session import work_folder
from changeflow.sources import stream
from changeflow.streaming import deltas, run, sinks, whole

PARTS = 3


def _published(spark: SparkSession, sf_dir: str, root: str, log: DataFrame | None = None) -> Iterator[int]:
    """Publishes the log part by part, a third of the event ids each; gives the part's number."""
    log = _log(spark, sf_dir) if log is None else log
    records = encode.record_key(
        _encoded(log, schemas.FLAT).withColumn("topic", routing.route_default_teleop(F.col("table")))
    )
    low, high = log.agg(F.min("offset"), F.max("offset")).first()
    ends = [low + (high - low + 1) * i // PARTS for i in range(PARTS + 1)]
    for i in range(PARTS):
        part = records.where((F.col("offset") >= ends[i]) & (F.col("offset") < ends[i + 1]))
        stream.publish_changes(part, root, timestamp="timestamp")
        yield i + 1


def _run(spark: SparkSession, root: str, lake: str, checkpoint: str) -> None:
    run.finish_all([whole.replicate_whole(spark, root, lake, checkpoint, once=True)])


def _changes(rows: DataFrame, table: str) -> DataFrame:
    return rows.select("operation", F.lit(table).alias("tbl"), *ROW, F.col("offset").alias("seq"))


def _both(read) -> DataFrame:
    """The rows of both tables, in one layout."""
    def of(table: str) -> DataFrame:
        rows = read(table)
        return rows if "teleoperator_id" in rows.columns else rows.withColumn("teleoperator_id", F.lit(None).cast("string"))

    return _changes(of(TABLES[0]), TABLES[0]).unionByName(_changes(of(TABLES[1]), TABLES[1]))


def _folders(spark: SparkSession, *names: str) -> list[str]:
    return [work_folder(spark, n) for n in names]


@query
def batch_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole batches, and nothing of one that landed half: rows of one table, no positions."""
    root, lake, checkpoint = _folders(spark, "topics", "lake", "checkpoint")
    for _ in _published(spark, sf_dir, root):
        _run(spark, root, lake, checkpoint)
    records = stream.read_change_batch(spark, schemas.EVENT_TOPICS[schemas.ROBOT], root)
    half = whole.by_table(decode.decode_changes(records, schemas.FLAT))
    sinks.write_batch(half, f"{lake}/{whole.LOG}", "half-way", 0, (whole.TABLE,))
    return _both(lambda t: whole.read_whole(spark, lake, t))


@query
def compact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two compactions and a batch after them, read as one log."""
    root, lake, checkpoint, catalog = _folders(spark, "topics", "lake", "checkpoint", "catalog")
    names = {t: f"{t}_{catalog.rsplit('-', 1)[1]}" for t in TABLES}
    compact.init_compacted(spark, names, catalog)
    for part in _published(spark, sf_dir, root):
        _run(spark, root, lake, checkpoint)
        if part < PARTS:
            for t, name in names.items():
                compact.compact_batches(spark, lake, t, name)
    return _both(lambda t: compact.read_log(spark, lake, t, names[t]))


@query
def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, each folding what landed since the last one into the kept state."""
    root, lake, checkpoint, kept = _folders(spark, "topics", "lake", "checkpoint", "state")
    for _ in _published(spark, sf_dir, root):
        _run(spark, root, lake, checkpoint)
        for t in TABLES:
            live.fold_landed(spark, lake, t, f"{kept}/{t}", buckets=16)
    return _both(lambda t: live.read_state(spark, lake, t, f"{kept}/{t}")).drop("operation")


@query
def dedupe_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three checkpoints: the first part lands three times, the second twice, the third once."""
    root, lake, *checkpoints = _folders(spark, "topics", "lake", "first", "second", "third")
    for part in _published(spark, sf_dir, root):
        for checkpoint in {1: checkpoints[:2], 2: checkpoints[:1], 3: checkpoints[2:]}[part]:
            _run(spark, root, lake, checkpoint)
    positions = whole.landed_positions(spark, lake)
    return _both(lambda t: replays.dedupe_overlaps(whole.read_whole(spark, lake, t), positions))


@query
def reconcile_at_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source and target as of two positions, while the target lacks the last part."""
    root, lake, checkpoint = _folders(spark, "topics", "lake", "checkpoint")
    upto = []
    for part in _published(spark, sf_dir, root):
        if part < PARTS:
            _run(spark, root, lake, checkpoint)
            ends = whole.last_positions(whole.landed_positions(spark, lake)).collect()  # a row per topic partition
            upto.append(spark.createDataFrame(ends, "topic string, partition int, upto bigint"))
    results = []
    for i, position in enumerate(upto):
        sources, targets = {}, {}
        for t in TABLES:
            columns = whole.live_columns(t)
            topic = stream.read_change_batch(spark, schemas.EVENT_TOPICS[t], root)
            source = decode.accepted(decode.decode_changes(topic, schemas.FLAT))
            target = whole.read_whole(spark, lake, t)
            for sides, log in ((sources, source), (targets, target)):
                rows = whole.as_of(log, position).select("operation", *columns, "offset")
                sides[t] = state.current_state(rows).select(*columns)
        found = reconcile.reconcile(spark, sources, targets)
        results.append(found.select(
            F.lit(i + 1).alias("position"), F.col("table").alias("tbl"), "check_name", "source_value", "verdict"
        ))
    return results[0].unionByName(results[1])


@query
def differing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged source against the kept state: exactly the keys that differ."""
    root, lake, checkpoint, kept = _folders(spark, "topics", "lake", "checkpoint", "state")
    for _ in _published(spark, sf_dir, root):
        pass
    _run(spark, root, lake, checkpoint)
    buckets = 16
    source = fixtures.source_rows(fixtures.events(spark, sf_dir))
    first = F.substring("uuid", 1, 1)
    changed = F.when(first == "1", F.concat("event_id", F.lit("?"))).otherwise(F.col("event_id"))
    damaged = source.where(first != "0").withColumn("event_id", changed).unionByName(
        source.where(first == "2").withColumn("uuid", F.reverse("uuid"))
    )
    found = []
    for t in TABLES:
        live.fold_landed(spark, lake, t, f"{kept}/{t}", buckets=buckets)
        columns = whole.live_columns(t)
        own = damaged.where(F.col("table") == t).select(*columns)

        def target(wanted, t=t, columns=columns):
            return live.read_state(spark, lake, t, f"{kept}/{t}", wanted).select(*columns)

        rows = differences.differing_rows(
            differences.side_of(own, ["uuid"], buckets), target, ["uuid"], columns, buckets
        )
        found.append(rows.select(F.lit(t).alias("tbl"), "uuid", "difference"))
    return found[0].unionByName(found[1])


@query
def counter_delta_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter differences across micro-batches, cut within every host's series."""
    source, path, kept, checkpoint = _folders(spark, "samples", "deltas", "readings", "checkpoint")
    samples = fixtures.host_samples(fixtures.events(spark, sf_dir))
    time = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `timestamp`)")
    timed = samples.withColumn("_at", time)
    low, high = timed.agg(F.min("_at"), F.max("_at")).first()
    counters = ["disk_read_total", "disk_write_total"]
    for i in range(PARTS):
        after, upto = (low + (high - low + 1) * j // PARTS for j in (i, i + 1))
        part = timed.where((F.col("_at") >= after) & (F.col("_at") < upto)).drop("_at")
        part.write.mode("append").parquet(source)
        stream_ = spark.readStream.schema(samples.schema).parquet(source)
        run.finish_all([deltas.stream_counter_delta(
            stream_, path, kept, checkpoint, counters, order=["timestamp", "offset"], once=True
        )])
    return deltas.read_deltas(spark, path, samples.schema, counters).select(
        "hostname", "disk_read_total_delta", "disk_write_total_delta", F.col("offset").alias("seq")
    )


@query
def incremental_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations counted fold by fold, with planted ones: no robot, a second insert, long event ids."""
    root, lake, checkpoint, kept, counts = _folders(spark, "topics", "lake", "checkpoint", "state", "counts")
    entity, step = F.expr("offset div 3"), F.col("offset") % 3
    log = _log(spark, sf_dir)
    log = log.withColumn("robot_id", F.when(F.col("event_id") != "ERROR", F.col("robot_id"))).withColumn(
        "operation", F.when((step == 1) & (entity % 7 == 0), schemas.INSERT).otherwise(F.col("operation"))
    )
    for _ in _published(spark, sf_dir, root, log):
        _run(spark, root, lake, checkpoint)
        for t in TABLES:
            live.fold_landed(spark, lake, t, f"{kept}/{t}", buckets=16)
            constraints.check_folded(
                spark, lake, t, f"{kept}/{t}", f"{counts}/{t}", schemas.REQUIRED[t], {"event_id": 5, "uuid": 36}
            )
    found = [
        constraints.read_checks(spark, f"{counts}/{t}").select(
            F.lit(t).alias("tbl"), "rule", F.col("column").alias("col"), "violations"
        )
        for t in TABLES
    ]
    return found[0].unionByName(found[1])


# --- all tables of a log in one scan ----------------------------------------------


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).withColumnsRenamed({"table": "tbl", "offset": "seq"})


CHANGE = ["operation", *ROW, "seq"]


@query
def checksum_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.checksum_by_group(_tables(spark, sf_dir), ["tbl"], CHANGE)


@query
def topk_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of every table, all operations, three changes of a key tied."""
    return quality.topk_by_group(_tables(spark, sf_dir), ["tbl"], columns=CHANGE)


@query
def partial_checksum_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.partial_checksum_by_group(_tables(spark, sf_dir), ["tbl"], columns=CHANGE)


# --- fields that a schema does not take --------------------------------------------


@query
def field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host metrics with readings that are no numbers and a field that the schema lacks."""
    e = F.col("event_id")
    samples = fixtures.events(spark, sf_dir).select(
        F.to_json(F.struct(
            F.col("ts").alias("timestamp"), F.concat(F.lit("host_"), F.col("user_id") % 5).alias("HostName"),
            F.when(e % 4 == 0, "n/a").otherwise((F.col("value") / 5).cast("string")).alias("cpu_percent"),
            F.when(F.col("event_type") == "error", F.col("event_type")).alias("Severity"),
            (e * 512).alias("disk_io_read"),
        )).alias("value")
    )
    return decode.field_report(samples, schemas.HOST_METRICS)


@query
def unmatched_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat changes read by the robot table's schema keep the operator beside the row."""
    records = _encoded(_log(spark, sf_dir), schemas.FLAT)
    names = ["operation", "table", *schemas.table_schema(schemas.ROBOT).fieldNames()]
    found = decode.keep_unmatched(decode.decode_value(records), names, "value")
    return found.select(F.col("offset").alias("seq"), F.inline_outer("unmatched")).toDF("seq", "field", "text")
