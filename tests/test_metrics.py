from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.metrics import counter_delta, counter_delta_by_time
from changeflow.streaming.deltas import land_deltas, read_deltas
from tests.conftest import rows

SCHEMA = "hostname string, timestamp timestamp_ntz, offset long, total long"


def samples(seed, n=600):
    """One host with most of the samples, repeated timestamps, a NULL host."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        host = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        when = start + dt.timedelta(seconds=rng.randrange(20 if host == "hot" else 5000))
        data.append((host, when, i, rng.randrange(10**6)))
    return data


def brute_force(data):
    last, found = {}, []
    for host, when, offset, total in sorted(data, key=lambda r: (r[1], r[2])):
        found.append((offset, total - last[host] if host in last else None))
        last[host] = total
    return sorted(found, key=repr)


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_deltas_across_slices(spark, fresh, slices):
    data = samples(slices)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    found = counter_delta(
        df, ["total"], order=["timestamp", "offset"], slices=slices, folder=fresh()
    )
    assert rows(found, "offset", "total_delta") == brute_force(data)


def test_more_slices_than_rows_and_no_rows(spark, fresh):
    data = samples(3, n=4)
    df = spark.createDataFrame(data, SCHEMA)
    found = counter_delta(df, ["total"], order=["timestamp", "offset"], slices=20, folder=fresh())
    assert rows(found, "offset", "total_delta") == brute_force(data)
    none = counter_delta(df.where("offset < 0"), ["total"], slices=3, folder=fresh())
    assert none.count() == 0


def test_a_busy_host_is_spread(spark, fresh):
    df = spark.range(4000).select(
        F.lit("only").alias("hostname"), F.col("id").alias("offset"), (F.col("id") * 2).alias("total")
    )
    folder = fresh()
    found = counter_delta(df, ["total"], order=["offset"], slices=8, folder=folder)
    assert found.agg(F.sum("total_delta"), F.count("total_delta")).first() == (3999 * 2, 3999)
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


@pytest.mark.parametrize("width", [1, 7, 600, 10**6])
def test_deltas_by_time_span(spark, width):
    """Spans without samples, a host in one span, NULL hosts and times; one exchange of the samples."""
    data = samples(width)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    found = counter_delta_by_time(df, ["total"], order=["timestamp", "offset"], width=width)
    assert rows(found, "offset", "total_delta") == brute_force(data)
    assert found.columns == [*df.columns, "total_delta"]


def test_deltas_by_time_need_one_exchange_of_the_samples(spark, plan_of):
    df = spark.createDataFrame(
        [(*r, "p") for r in samples(2)], SCHEMA + ", payload string"
    )
    plan = plan_of(counter_delta_by_time(df, ["total"], order=["timestamp", "offset"]))
    # Of four exchanges one has samples: the others bring combined readings by span,
    # then by host, then back to their spans.
    assert plan.count("Exchange hashpartitioning") == 4 and "rangepartitioning" not in plan
    window = plan[: plan.index("Window [row_number")] if "Window [row_number" in plan else plan
    assert window.count("Exchange hashpartitioning") == 0


def test_null_times_come_first(spark):
    df = spark.createDataFrame([("a", None, 0, 5), ("a", dt.datetime(2024, 1, 1), 1, 9)], SCHEMA)
    found = counter_delta_by_time(df, ["total"], order=["timestamp", "offset"])
    assert rows(found, "offset", "total_delta") == [(0, None), (1, 4)]


def test_batches_carry_the_last_reading(spark, fresh):
    path, kept = fresh("deltas"), fresh("kept")
    data = sorted(samples(9, 200), key=lambda r: (r[1], r[2]))
    for number, at in enumerate(range(0, 200, 50)):
        batch = spark.createDataFrame(data[at : at + 50], SCHEMA)
        for _ in range(2):  # delivered twice
            land_deltas(batch, path, kept, "q", number, ["total"], order=["timestamp", "offset"])
    schema = spark.createDataFrame([], SCHEMA).schema
    assert rows(read_deltas(spark, path, schema, ["total"]), "offset", "total_delta") == brute_force(data)
