"""Queries over both topics land every published row, and their digests see every column."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures, queries

from .conftest import rows


def test_every_published_row_is_landed(spark, small):
    total = fixtures.events(spark, small).count()
    found = queries.append_stream_all(spark, small).groupBy("tbl").count().collect()
    assert {r.tbl for r in found} == set(queries.TABLES) and sum(r["count"] for r in found) == total


@pytest.mark.parametrize("name", ["table_checksum_all", "partial_checksum_all", "row_hash_all", "topk_by_key_all"])
def test_digests_see_a_wrong_operator(spark, small, monkeypatch, name):
    right, log = rows(queries.QUERIES[name](spark, small)), queries._log
    wrong = F.concat("teleoperator_id", F.lit("x"))
    monkeypatch.setattr(queries, "_log", lambda *a: log(*a).withColumn("teleoperator_id", wrong))
    assert rows(queries.QUERIES[name](spark, small)) != right
