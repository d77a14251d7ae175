"""Mixing sources to target weights by earliest-deadline-first scheduling (Pfair).

Each source's documents are put in a random order and cut into blocks.  Block j
of a source of weight w may not go before slot floor(j / w) and has to go before
ceil((j + 1) / w); of the blocks that may go, the one with the earliest deadline
takes the slot.  With weights that sum to 1 every deadline is kept, so at any
slot each source is less than one block away from its share.

Weights are taken as they are, as exact rationals, and the schedule runs over all
blocks of all sources: nothing is rounded or repeated.  A source that runs out
leaves, and the weights of the others fill the slots.  That is part of the same
schedule: with T(v) = sum of min(w * v, blocks) over the sources, the slots that
an ideal mixture has given when a source of weight w has had w * v blocks, block j
has the release floor(T(j / w)) and the deadline ceil(T((j + 1) / w)).

The driver knows the sources' names and counts and makes the schedule in order, a
range of slots at a time; each range is written as a table, so that its memory
does not grow with the blocks.  Documents meet their block's row by join.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import accumulate
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.session import work_folder

PERIOD = 1000
#: Slots of the schedule that are written at once.
RANGE_SLOTS = 1 << 18
BLOCK_ROWS = 16
#: Parts of a source in which its documents are ranked side by side.
PARTS = 256


def quotas(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots of each source in a period, for schedules that repeat: at least one, by largest remainders."""
    names = sorted(weights)
    period = max(period, 8 * len(names))
    total = sum(weights.values())
    exact = {n: weights[n] / total * (period - len(names)) for n in names}
    given = {n: 1 + int(exact[n]) for n in names}
    rest = period - sum(given.values())
    for n in sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))[:rest]:
        given[n] += 1
    return given


def schedule(blocks: Mapping[str, int], weights: Mapping[str, float | Fraction]) -> Iterator[tuple[str, int]]:
    """The source and its block of every slot, over all blocks of all sources.

    At every slot a source has been given less than one block more or less than
    an ideal mixture gives it, by the weights themselves.
    """
    exact = {n: Fraction(weights[n]) for n in blocks if blocks[n]}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights are greater than 0")
    scale = lcm(*(w.denominator for w in exact.values()))
    share = {n: int(w * scale) for n, w in exact.items()}
    # Sources by when they run out; those before ``k`` are out in segment k.
    leaving = sorted(share, key=lambda n: (Fraction(blocks[n], share[n]), n))
    ends = [Fraction(blocks[n], share[n]) for n in leaving]
    gone = [0, *accumulate(blocks[n] for n in leaving)]
    rate = [*accumulate((share[n] for n in reversed(leaving)), initial=0)][::-1]
    segment = dict.fromkeys(share, 0)

    def ideal(n: str, j: int) -> tuple[int, int]:
        """T(j / w) as whole slots and a remainder."""
        k, w = segment[n], share[n]
        if k < len(ends) and j * ends[k].denominator >= ends[k].numerator * w:
            k = segment[n] = bisect_right(ends, Fraction(j, w), lo=k)
        whole, part = divmod(j * rate[k], w)
        return gone[k] + whole, part

    waiting = [(0, n, 0) for n in sorted(share)]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    for slot in range(gone[-1]):
        while waiting and waiting[0][0] <= slot:
            _, n, j = heapq.heappop(waiting)
            whole, part = ideal(n, j + 1)
            heapq.heappush(ready, (whole + (part > 0), n, j))
        deadline, n, j = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError(f"a block of {n} is late")
        yield n, j
        if j + 1 < blocks[n]:
            heapq.heappush(waiting, (ideal(n, j + 1)[0], n, j + 1))


def edf_period(quota: Mapping[str, int]) -> dict[str, np.ndarray]:
    """The slots that each source's blocks take in a period."""
    slots: dict[str, list[int]] = {n: [] for n in quota}
    for slot, (n, _) in enumerate(schedule(quota, quota)):
        slots[n].append(slot)
    return {n: np.array(s) for n, s in slots.items()}


def plan_of_blocks(
    spark: SparkSession, rows: Mapping[str, int], weights: Mapping[str, float], block_rows: int,
    range_slots: int = RANGE_SLOTS,
) -> DataFrame:
    """The schedule as a table: source, block, slot, and the position of the block's first row."""
    blocks = {s: -(-n // block_rows) for s, n in rows.items()}
    # Only the last block of a source can be short.
    last = {s: rows[s] - (b - 1) * block_rows for s, b in blocks.items()}
    path, schema = work_folder(spark, "mixture"), "source string, block bigint, slot bigint, start bigint"
    slots, at, done = schedule(blocks, weights), 0, 0
    total = sum(blocks.values())
    spark.createDataFrame([], schema).write.parquet(path)
    while done < total:
        names, numbers, starts = [], [], []
        for n, j in slots:
            names.append(n)
            numbers.append(j)
            starts.append(at)
            at += block_rows if j + 1 < blocks[n] else last[n]
            if len(names) == range_slots:
                break
        table = pa.table({
            "source": pa.array(names, pa.string()), "block": pa.array(numbers, pa.int64()),
            "slot": pa.array(range(done, done + len(names)), pa.int64()), "start": pa.array(starts, pa.int64()),
        })
        spark.createDataFrame(table).write.mode("append").parquet(path)
        done += len(names)
    return spark.read.schema(schema).parquet(path)


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
    source_col: str = "source", block_rows: int = BLOCK_ROWS, exponent: float = 0.5,
) -> DataFrame:
    """The place of every document in the mixture.

    ``weights`` are target shares by source; a source that it lacks gets the
    least of them, and all get the same if it is empty; a weight that is not above 0 is
    an error.  Without it a source of n rows has weight n ** ``exponent``,
    which favours small ones.  One row per row of ``docs``: doc_id, source,
    block (of its source), slot (of the mixture), position (0-based, all rows).
    A null source is a source of its own, named by an empty text.  Ties and
    repeated rows have places of their own.  The number of sources must fit the
    driver, which holds their names and counts and goes through the blocks in
    order; rows never pass through it.
    """
    spark = docs.sparkSession
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source")
    ).withColumn("_order", F.xxhash64("doc_id", F.lit(17)))
    parted = named.withColumn("_part", F.pmod(F.shiftright("_order", 3), F.lit(PARTS)).cast("int"))
    sizes = parted.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_order", "doc_id")) - 1
    ranked = parted.withColumn("_rank", rank).join(offsets, ["source", "_part"]).select(
        "doc_id", "source", (F.col("_offset") + F.col("_rank")).alias("_rank")
    ).withColumn("block", F.floor(F.col("_rank") / block_rows).cast("bigint"))

    counts = {r.source: r.n for r in sizes.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    if weights is None:
        target = {s: float(n) ** exponent for s, n in counts.items()}
    else:
        least = min(weights.values(), default=1.0)
        target = {s: float(weights.get(s, least)) for s in counts}
    plan = plan_of_blocks(spark, counts, target, block_rows)
    return ranked.join(plan, ["source", "block"]).select(
        "doc_id", "source", "block", "slot", (F.col("start") + F.col("_rank") % block_rows).alias("position")
    )


def in_mixed_order(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """All rows and columns of ``docs``, sorted by their place in the mixture.

    Written, its files follow each other in the order of the mixture.  Rows that
    share an id, or have none, follow each other at the first place that one of
    them has, ordered by a hash of their columns but maps and variants; rows equal in
    all of these are in no order.  Extra columns may have any name.  An empty table
    gives no rows.
    """
    places = mix_sources(docs, id_col=id_col, source_col=source_col, **how).groupBy(
        F.col("doc_id").alias("id")
    ).agg(F.min("position").alias("position"))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    packed = docs.select(F.col(id_col).alias("own"), F.xxhash64(*hashed).alias("tie"), F.struct("*").alias("row"))
    placed = packed.join(places, F.col("own").eqNullSafe(F.col("id")))
    return placed.orderBy("position", "tie").select("row.*")
