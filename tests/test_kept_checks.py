"""Constraint counts kept per fold, checks of all groups in one scan, fields that a schema does not take."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import decode, quality
from changeflow.plans import constraints, live
from changeflow.schemas import HOST_METRICS
from changeflow.streaming import whole
from tests.conftest import rows
from tests.test_landed_log import batch


def test_inserts_of_keys_that_are_there(spark):
    draw = random.Random(2)
    changes = [(f"k{draw.randrange(12)}", draw.choice(["INSERT", "UPDATE", "DELETE"]), i) for i in range(400)]
    changes += [("busy", draw.choice(["INSERT", "DELETE"]), 400 + i) for i in range(200)]
    want, last = [], {}
    for key, op, at in changes:
        if op == "INSERT" and last.get(key, "DELETE") != "DELETE":
            want.append((key, at))
        last[key] = op
    schema = "uuid string, operation string, offset bigint"
    for cut in (0, 150, 450):
        before = {}
        for c in changes[:cut]:
            before[c[0]] = c
        late = changes[max(0, cut - 40) : cut]
        new = spark.createDataFrame(late + changes[cut:] + changes[cut:][:50], schema)
        known = spark.createDataFrame(list(before.values()), schema)
        for span in (7, 1 << 20):
            found = rows(constraints.repeated_inserts(new, known, "uuid", span=span), "uuid", "offset")
            assert found == sorted([w for w in want if w[1] >= cut], key=repr)


def test_folds_are_counted_once_and_from_their_own_batches(spark, fresh):
    lake, kept, counts = fresh(), fresh(), fresh()
    parts = [
        [("a", "E", "INSERT", 0), ("b", None, "INSERT", 1), ("c", "LONGER", "INSERT", 2)],
        [("a", "E", "INSERT", 3), ("b", "E", "DELETE", 4)],
        [("b", "E", "INSERT", 5), ("c", "LONGER", "UPDATE", 6), ("a", "E", "INSERT", 0)],
    ]
    args = (spark, lake, "robot", kept, counts, ("uuid", "event_id"), {"event_id": 3})

    def counted():
        return {(r.rule, r.column): r.violations for r in constraints.read_checks(spark, counts).collect()}

    whole.land_whole(batch(spark, parts[0]), lake, "q", 0)
    live.fold_landed(spark, lake, "robot", kept, buckets=4)
    assert constraints.check_folded(*args) == [0] and constraints.check_folded(*args) == []
    assert counted() == {("not_null", "uuid"): 0, ("not_null", "event_id"): 1, ("length", "event_id"): 1, ("unique", "uuid"): 0}
    for i in (1, 2):  # two folds wait, the later one already there when the earlier is counted
        whole.land_whole(batch(spark, parts[i]), lake, "q", i)
        live.fold_landed(spark, lake, "robot", kept, buckets=4)
    assert constraints.check_folded(*args) == [1, 2]
    # b was deleted before it was inserted again, and the last row is a late copy.
    assert counted() == {("not_null", "uuid"): 0, ("not_null", "event_id"): 1, ("length", "event_id"): 2, ("unique", "uuid"): 1}


def test_groups_keep_n_rows_before_the_exchange(spark, plan_of):
    draw = random.Random(4)
    given = [(draw.choice("xyz"), f"k{draw.randrange(9)}", draw.randrange(3)) for _ in range(300)]
    df = spark.createDataFrame([*given, (None, "k", 1)], "g string, uuid string, v int").repartition(5)
    found = quality.topk_by_group(df, ["g"], 20)
    want = []
    for g in ("x", "y", "z", None):
        want += sorted((r for r in [*given, (None, "k", 1)] if r[0] == g), key=lambda r: r[1:])[:20]
    assert rows(found, "g", "uuid", "v") == sorted(want, key=repr)
    plan = plan_of(found)
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    whole_sums = {r.g: (r.sampled_rows, r.sample_checksum) for r in quality.partial_checksum_by_group(df, ["g"], 20).collect()}
    for g in ("x", "y", "z"):
        own = df.where(F.col("g") == g).drop("g")
        one = quality.partial_checksum(own, 20).first()
        assert whole_sums[g] == (one.sampled_rows, one.sample_checksum)
        mine = quality.checksum_by_group(df, ["g"]).where(F.col("g") == g).drop("g").first()
        assert tuple(mine) == tuple(quality.table_checksum(own).first())
    with pytest.raises(ValueError, match="exchange"):
        quality.topk_by_group(df, ["g"], 100_000)


def test_fields_that_the_schema_does_not_take(spark):
    texts = [
        '{"hostname": "h", "cpu_percent": "n/a", "Cpu_Percent": 1.5}', '{"CPU_percent": "x", "odd": {"a": 1}, "ODD": null}',
        '{"timestamp": "noon", "odd": 2}', "[1]", "", None, '{"cpu_percent": null}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    report = {(r.field, r.problem): r.records for r in decode.field_report(df, HOST_METRICS).collect()}
    assert report == {("cpu_percent", "not_cast"): 1, ("timestamp", "not_cast"): 1, ("odd", "unknown"): 2}
    kept = [r.unmatched for r in decode.keep_unmatched(df, HOST_METRICS.fieldNames(), "value").collect()]
    shown = [None if k is None else [(e.key, e.value) for e in k] for k in kept]
    assert shown == [[], [("odd", '{"a":1}'), ("ODD", None)], [("odd", "2")], None, None, None, []]
    assert decode.field_report(df.limit(0), HOST_METRICS).count() == 0
