"""Copies that several checkpoints landed, removed where they can be only.

A second checkpoint over the same topics lands their records again.  What each
batch landed is known as intervals of offsets, so the parts of the log that can hold
copies are found from a few rows; all others pass as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH = ["query_id", "batch_id", "topic", "partition"]
RECORD = ["topic", "partition", "offset"]


def query_spans(positions: DataFrame) -> DataFrame:
    """The offsets of each query in each topic partition, adjoining batches merged.

    Columns query_id, topic, partition, first, last: a row per gap, not per batch.
    """
    before = Window.partitionBy("query_id", "topic", "partition").orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(before.rowsBetween(Window.unboundedPreceding, -1))
    marked = positions.select(
        "query_id", "topic", "partition", "first_offset", "last_offset",
        F.coalesce((F.col("first_offset") > reached + 1).cast("int"), F.lit(0)).alias("gap"),
    )
    numbered = marked.withColumn("span", F.sum("gap").over(before))
    return numbered.groupBy("query_id", "topic", "partition", "span").agg(
        F.min("first_offset").alias("first"), F.max("last_offset").alias("last")
    ).drop("span")


def overlapping_batches(positions: DataFrame) -> DataFrame:
    """(query_id, batch_id, topic, partition) whose offsets another query has landed too."""
    spans = query_spans(positions)
    other = spans.withColumnsRenamed({"query_id": "other", "first": "from", "last": "to"})
    met = spans.join(other, ["topic", "partition"]).where(
        (F.col("query_id") != F.col("other")) & (F.col("first") <= F.col("to")) & (F.col("from") <= F.col("last"))
    )
    regions = met.select(
        "query_id", "topic", "partition", F.greatest("first", "from").alias("from"), F.least("last", "to").alias("to")
    ).distinct()
    return positions.join(regions, ["query_id", "topic", "partition"]).where(
        (F.col("first_offset") <= F.col("to")) & (F.col("from") <= F.col("last_offset"))
    ).select(*BATCH).distinct()


def dedupe_overlaps(log: DataFrame, positions: DataFrame) -> DataFrame:
    """One of each record that several queries landed, all columns as they are.

    ``log`` has topic, partition, offset, query_id and batch_id; ``positions`` are those
    of :func:`changeflow.streaming.whole.landed_positions`.  Rows of batches without
    overlap are neither shuffled nor compared.  Of the others the position and a
    number for the batch are aggregated by hash, without the payload; the row whose
    batch has the least number stays, the same one on every run.
    """
    overlaps = overlapping_batches(positions)
    apart = log.join(overlaps, BATCH, "left_anti")
    met = log.join(overlaps, BATCH, "left_semi").withColumn("_batch", F.xxhash64("query_id", "batch_id"))
    winners = met.select(*RECORD, "_batch").groupBy(*RECORD).agg(F.min("_batch").alias("_batch"))
    kept = met.join(winners, [*RECORD, "_batch"], "left_semi")
    return apart.unionByName(kept.drop("_batch")).select(*log.columns)
