"""Landing a micro-batch of several tables whole or not at all.

A batch is one write, partitioned by query, batch and table; nothing is cached and
nothing is read twice.  When it has landed, its positions are written as one file:
that row per topic partition says that the batch is there.  Readers join the log
with it and see nothing of a batch that failed half way.  Both writes replace
exactly their own partitions, so a batch that is delivered again lands once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.decode import NULL_VALUE, decode_changes
from changeflow.schemas import EVENT_TOPICS, FLAT, POSITION, change_log_schema, row_schema, table_schema
from changeflow.sources.stream import FILES, read_change_stream
from changeflow.streaming.sinks import BATCH_COLUMNS, _start, count_rows, running_query_id, write_batch

LOG, BATCHES = "log", "batches"
TABLE, QUARANTINE = "table", "quarantine"
_IDS = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
#: What a landed row has, whatever its table: columns of other tables are NULL and cost nothing.
LANDED = T.StructType(
    [T.StructField("operation", T.StringType()), *row_schema().fields, *POSITION.fields]
    + [T.StructField(c, T.StringType()) for c in ("raw", "error")]
    + _IDS + [T.StructField(TABLE, T.StringType())]
)
#: The offsets that a batch landed, per topic partition.
POSITIONS = T.StructType(
    [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("first_offset", "last_offset", "rows")]
    + _IDS
)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet folder, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def by_table(decoded: DataFrame, topics: Mapping[str, str] = EVENT_TOPICS) -> DataFrame:
    """Decoded changes in one layout, with the table that each belongs to.

    What did not decode belongs to the quarantine and keeps its raw text; tombstones
    belong nowhere.
    """
    bad = F.col("error").isNotNull()
    table = F.when(bad, QUARANTINE)
    for name, topic in topics.items():
        table = table.when(F.col("topic") == topic, name)
    given = decoded.where(~F.col("error").eqNullSafe(NULL_VALUE))
    row = [F.col(f.name).cast(f.dataType).alias(f.name) for f in row_schema().fields]
    return given.select(
        "operation", *row, *POSITION.fieldNames(), F.when(bad, F.col("raw")).alias("raw"), "error",
        F.coalesce(table, F.lit(QUARANTINE)).alias(TABLE),
    )


def land_whole(
    batch: DataFrame, root: str, query_id: str, batch_id: int, entity: Sequence[str] = (TABLE,),
    schema: T.StructType = LANDED,
) -> None:
    """Land one batch under ``root/log``, then say so under ``root/batches``.

    The positions are read back from the landed files, three columns of one batch;
    an empty batch says nothing.
    """
    write_batch(batch, f"{root}/{LOG}", query_id, batch_id, entity)
    landed = read_or_empty(batch.sparkSession, f"{root}/{LOG}", schema).where(
        (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
    )
    positions = landed.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("rows")
    )
    write_batch(positions.coalesce(1), f"{root}/{BATCHES}", query_id, batch_id)


def whole_batches(
    df: DataFrame, root: str, checkpoint: str, entity: Sequence[str] = (TABLE,), every: str | None = None,
    once: bool = False, name: str | None = None,
) -> StreamingQuery:
    """Land a stream of rows with a ``table`` column, each batch whole or not at all."""

    def land(batch: DataFrame, batch_id: int) -> None:
        land_whole(batch, root, running_query_id(batch), batch_id, entity)

    return _start(count_rows(df).writeStream.foreachBatch(land), checkpoint, name, every, once)


def replicate_whole(
    spark: SparkSession, source: str, root: str, checkpoint: str, source_fmt: str = FILES,
    every: str | None = None, once: bool = False, max_per_trigger: int | None = None,
    topics: Mapping[str, str] = EVENT_TOPICS, source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Flat change events of all tables to one log of whole batches, the quarantine included."""
    records = read_change_stream(
        spark, list(topics.values()), source, source_fmt, max_per_trigger=max_per_trigger, extra=source_options
    )
    decoded = decode_changes(records, FLAT)
    return whole_batches(by_table(decoded, topics), root, checkpoint, every=every, once=once, name="whole_batches")


def landed_positions(spark: SparkSession, root: str) -> DataFrame:
    """What every whole batch holds: topic, partition, offsets, rows, query_id, batch_id."""
    return read_or_empty(spark, f"{root}/{BATCHES}", POSITIONS)


def whole_ids(spark: SparkSession, root: str) -> DataFrame:
    """(query_id, batch_id) of the batches that are there whole."""
    return landed_positions(spark, root).select(*BATCH_COLUMNS).distinct()


def landed_columns(table: str) -> list[str]:
    """The columns of a table's landed rows."""
    if table == QUARANTINE:
        return ["raw", "error", *POSITION.fieldNames(), *BATCH_COLUMNS]
    return [*change_log_schema(table).fieldNames(), *BATCH_COLUMNS]


def read_whole(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's rows of whole batches.

    Other tables' folders are pruned, and those of other batches where the few
    ids are broadcast by their size.
    """
    log = read_or_empty(spark, f"{root}/{LOG}", LANDED).where(F.col(TABLE) == table)
    found = log.join(whole_ids(spark, root), list(BATCH_COLUMNS), "left_semi")
    return found.select(*landed_columns(table))


def last_positions(positions: DataFrame) -> DataFrame:
    """The last landed offset of each topic partition: topic, partition, upto."""
    return positions.groupBy("topic", "partition").agg(F.max("last_offset").alias("upto"))


def as_of(log: DataFrame, upto: DataFrame) -> DataFrame:
    """The changes up to a position of their topic partition; none of unnamed ones.

    With the same ``upto`` (topic, partition, upto) on both sides, a source that has
    moved on and a target that is still filling are compared at one point of the
    log, so their state is equal without a tolerance.  Offsets have to land in
    order, as a broker gives them.
    """
    found = log.join(upto, ["topic", "partition"])
    return found.where(F.col("offset") <= F.col("upto")).select(*log.columns)


def live_columns(table: str) -> list[str]:
    return table_schema(table).fieldNames()
