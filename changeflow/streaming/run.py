"""Running several queries of one session."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def run_many(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until any of the queries ends; a failed one raises and stops the others.

    Other queries of the session do not count, nor do those that have ended before.
    """
    try:
        while queries and not any(query.awaitTermination(0.5) for query in queries):
            pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
        spark.streams.resetTerminated()


def finish_all(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until queries that read what is there have all ended.

    Without a ``timeout`` (seconds) it waits as long as they take.
    """
    deadline = time.monotonic() + (timeout or 0)
    for query in queries:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(max(1, int(deadline - time.monotonic()))):
            for running in queries:
                running.stop()
            raise TimeoutError(f"query {query.name or query.id} did not end in {timeout} s")
