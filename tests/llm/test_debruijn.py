"""Substring dedup against every window of every document, compared as words."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from changeflow.llm import debruijn, queries

DOCS = "doc_id bigint, text string"


def expected(rows, window=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc, _), own in zip(rows, words):
        for i in range(len(own) - window + 1 if doc is not None else 0):
            key = tuple(own[i : i + window])
            first[key] = min(doc, first.get(key, doc))
    out = []
    for (doc, _), own in zip(rows, words):
        gone = set()
        for i in range(len(own) - window + 1 if doc is not None else 0):
            if first[tuple(own[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in debruijn.remove_repeats(df, **options).collect()), key=repr)


def test_query_over_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op11_substring_dedup(spark, small).collect()), key=repr)
    assert got == expected(rows)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("vocabulary, window, anchor", [(2, 8, 3), (3, 5, 5), (30, 50, 20)])
def test_branching_passages(spark, vocabulary, window, anchor):
    """Passages cut into one another, few words, repeated and null ids, texts of one word."""
    pick = random.Random(vocabulary)
    base = [[pick.choice("abcdefghijklmnopqrstuvwxyzABCD"[:vocabulary]) for _ in range(200)] for _ in range(4)]
    rows = [(500, None), (501, ""), (502, "a " * 3000), (3, "a " * 400), (503, "é ü " * 60), (504, "É ü " * 60)]
    for doc in range(60):
        text = list(pick.choice(base))
        for _ in range(pick.randint(0, 4)):
            at, to = sorted(pick.randrange(len(text) + 1) for _ in range(2))
            text[at:at] = pick.choice(["x", "y", ""]).split() + pick.choice(base)[at:to]
        rows.append((pick.choice([doc, doc, doc // 2, None]), pick.choice(["  ", "\n"]).join(text)))
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert found(df, window=window, anchor=anchor) == expected(rows, window)


def test_spans_name_their_source(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"a b {passage} c"), (2, f"{passage} d"), (3, f"x {passage}")]
    spans = debruijn.repeated_spans(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in spans} == {2, 3}
    assert {r.source for r in spans} == {1}
    covered = {(r.doc_id, r.at + i) for r in spans for i in range(r.n)}
    assert covered == {(2, i) for i in range(11)} | {(3, i + 1) for i in range(11)}
    texts = debruijn.remove_repeats(spark.createDataFrame(rows, DOCS), keep_text=True).collect()
    assert {r.doc_id: r.kept_text for r in texts} == {1: rows[0][1], 2: "d", 3: "x"}


def test_odd_tables(spark):
    assert found(spark.createDataFrame([], DOCS)) == []
    named = spark.createDataFrame(
        [("b", "u v w " * 40, 1, 2), ("a", "u v w " * 40, 3, 4)], "doc_id string, text string, anchor int, source int"
    )
    assert [r[:3] for r in found(named)] == [("a", 120, 0), ("b", 120, 120)]
    with pytest.raises(ValueError, match="anchors"):
        debruijn.repeated_spans(named, window=5, anchor=6)
