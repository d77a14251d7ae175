"""Pipeline stages on tables with odd columns, ties, repeated and null ids, and texts as ids."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from changeflow.llm import digest_index, jaccard_join, mixing, quality_model
from tests.conftest import rows

#: Names that the stages use, or used, for columns of their own.
CLASHING = [
    "_kept_id", "_kept_digest", "_digest", "_gone", "_id", "_position", "_order", "_rank", "_part", "id", "row", "own",
    "pair", "digest", "position", "tie", "slot", "block", "start", "kept", "keep_id", "group_size", "n", "key", "hub",
    "component_id", "n_shingles", "score", "predicted", "held_out", "label", "features", "spot", "doc", "a.b", "rows",
]


@pytest.fixture(scope="module")
def clashing(spark):
    base = [(1, "A b c d e f", "s"), (2, "a B c d e f", "s"), (3, None, "t"), (4, "g h i j k l", None), (None, "x", "t")]
    docs = spark.createDataFrame(base, "doc_id bigint, text string, source string")
    extra = [F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(name) for name in CLASHING]
    return docs.select("*", *extra, F.create_map(F.lit("k"), F.col("text")).alias("m"))


def plain(df):
    return sorted(([*r[:-1], sorted((r[-1] or {}).items())] for r in df.collect()), key=repr)


@pytest.mark.parametrize(("stage", "kept"), [
    (digest_index.keep_first_copies, [2, 3, 4, None]),
    (lambda d: jaccard_join.keep_one_of_each(d, percent=80, k=5), [1, 3, 4, None]),
    (mixing.in_mixed_order, [1, 2, 3, 4, None]),
])
def test_rows_pass_with_columns_of_any_name(clashing, stage, kept):
    found = stage(clashing)
    assert found.columns == clashing.columns
    want = [r for r in plain(clashing) if r[0] in kept]
    assert plain(found) == want
    assert stage(clashing.limit(0)).collect() == []


def test_the_quality_stage_passes_columns_of_any_name(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4)], "doc_id bigint, quality int")
    found = quality_model.keep_good(clashing, labels)
    assert found.columns == clashing.columns
    assert {repr(r) for r in plain(found)} <= {repr(r) for r in plain(clashing)}


def test_one_row_of_an_id_and_text_stays_whatever_the_order(spark):
    given = [(1, "Same", 7, None), (1, "same", 3, "z"), (1, "same", 3, "a"), (None, "n", 2, "q"), (None, "N", 1, "q"), (2, "alone", 0, "")]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(given)
        docs = spark.createDataFrame(given, "doc_id bigint, text string, n int, s string").repartition(seed + 1)
        found = rows(digest_index.keep_first_copies(docs))
        assert [(r[0], r[1].lower()) for r in found] == [(1, "same"), (2, "alone"), (None, "n")]
        assert want in (None, found)
        want = found


def test_texts_as_ids_rank_by_their_order(spark):
    docs = spark.createDataFrame([("a", "X"), ("b", "x"), ("c", "y"), (None, "y"), (None, None)], "doc_id string, text string")
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in digest_index.exact_dedup(docs).collect()}
    assert found == {("a", "b", 2, False), ("b", "b", 2, True), ("c", "c", 2, True), (None, "c", 2, False), (None, None, 1, True)}
    assert rows(digest_index.keep_first_copies(docs), "doc_id") == [("b",), ("c",), (None,)]
    assert sorted(r.position for r in mixing.mix_sources(docs.withColumn("source", F.lit("s"))).collect()) == list(range(5))


def test_weights(spark):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2).alias("source"))
    even = mixing.mix_sources(docs, weights={}, block_rows=4).select("slot", "source").distinct().orderBy("slot").collect()
    assert all(a.source != b.source for a, b in zip(even[::2], even[1::2]))
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, weights={"s0": 1, "s1": 0})


def test_rows_of_one_id_follow_each_other_in_a_fixed_order(spark):
    given = [(i % 5 if i % 7 else None, f"t{i}", f"s{i % 3}") for i in range(60)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(given)
        docs = spark.createDataFrame(given, "doc_id bigint, text string, source string").repartition(seed + 1)
        found = [tuple(r) for r in mixing.in_mixed_order(docs, block_rows=2).collect()]
        ids = [r[0] for r in found]
        assert sorted(found, key=repr) == sorted(given, key=repr)
        assert sum(a != b for a, b in zip(ids, ids[1:])) == len(set(ids)) - 1
        for i in set(ids):
            own = [r for r in found if r[0] == i]
            assert want is None or own == [r for r in want if r[0] == i]
        want = want or found
