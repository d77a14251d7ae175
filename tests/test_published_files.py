"""The published log comes in files of a bounded size: they grow in number, and the batches stay three."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeflow import fixtures, queries
from changeflow.sources import stream

from .conftest import rows


def longest_file(records):
    return records.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]


def test_files_grow_in_number_not_in_size(spark, small, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 50, raising=False)
    root, files = queries._publish(spark, small)
    topics = list(queries.schemas.EVENT_TOPICS.values())
    published = stream.read_change_batch(spark, topics, root)
    total = fixtures.events(spark, small).count()
    assert published.count() == total and files == -(-total // 150)
    assert longest_file(published) <= 100
    for topic in topics:
        own = stream.read_change_batch(spark, topic, root)
        assert 2 * files < own.select(F.input_file_name()).distinct().count() <= 3 * files


def test_one_file_a_batch_while_the_log_is_small(spark, small):
    assert queries._publish(spark, small)[1] == 1


@pytest.mark.parametrize(
    "name", ["trigger", "trigger_all", "append_batches_all", "split_batches", "replicate_events", "dedupe_replays_stream"]
)
def test_rows_and_batches_are_the_same_in_many_files(spark, small, monkeypatch, name):
    whole = rows(queries.QUERIES[name](spark, small))
    monkeypatch.setattr(queries, "FILE_ROWS", 50, raising=False)
    assert rows(queries.QUERIES[name](spark, small)) == whole


def test_the_log_that_comes_twice_is_published_in_small_files(spark, small, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 50, raising=False)
    most, publish = [], stream.publish_changes

    def seen(changes, root, **options):
        publish(changes, root, **options)
        most.append(longest_file(stream.read_change_batch(spark, list(queries.schemas.EVENT_TOPICS.values()), root)))

    monkeypatch.setattr(stream, "publish_changes", seen)
    queries.dedupe_replays_stream(spark, small)
    assert len(most) == 2 and max(most) <= 100
