"""Headline timings over the supplied tables; prints one JSON line.

    BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default: all)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from changeflow import fixtures, queries, schemas  # noqa: E402
from changeflow.operators import decode, metrics, quality, state  # noqa: E402
from changeflow.plans import qa, replicate  # noqa: E402
from changeflow.session import build_session, session_config, work_folder  # noqa: E402
from changeflow.sources import stream, tables  # noqa: E402
from changeflow.streaming import run  # noqa: E402

REPEATS = 3


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 1)
    conf = session_config(
        "changeflow-bench", f"local[{cpus}]", shuffle_partitions=cpus,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark = build_session(conf)
    spark.sparkContext.setLogLevel("ERROR")

    events = fixtures.events(spark, sf_dir)
    log = fixtures.change_log(events)
    captured = replicate.capture_changes(log)
    topics = work_folder(spark, "bench-topics")
    stream.publish_changes(captured, topics, timestamp="timestamp")
    names = list(schemas.EVENT_TOPICS.values())
    records = stream.read_change_batch(spark, names, topics)
    decoded = decode.accepted(decode.parse_flat(records))
    n = events.count()

    lake = work_folder(spark, "bench-lake")
    landing: dict[str, float] = {}

    def replicate_stream() -> None:
        nonlocal lake
        lake = work_folder(spark, "bench-lake")
        query = replicate.replicate_events(
            spark, topics, lake, work_folder(spark, "bench-checkpoint"), once=True
        )
        run.finish_all([query])
        busy = [p for p in query.recentProgress if p["numInputRows"]]
        seconds = sum(p["durationMs"]["triggerExecution"] for p in busy) / 1000
        landing["rows_per_sec"] = sum(p["numInputRows"] for p in busy) / max(seconds, 1e-9)

    live = fixtures.source_rows(events)
    sources = {
        t: live.where(F.col("table") == t).select(*schemas.table_schema(t).fieldNames())
        for t in schemas.TABLES
    }

    def write_log() -> None:
        tables.write_table(
            decoded.drop("has_data"), work_folder(spark, "bench-table"), ["robot_id"]
        )

    samples = fixtures.host_samples(events)
    work: dict[str, Callable[[], object]] = {
        "encode": lambda: consume(captured),
        "publish": lambda: stream.publish_changes(
            captured, work_folder(spark, "bench-topics"), timestamp="timestamp"
        ),
        "decode": lambda: consume(decoded),
        "decode_and_write": write_log,
        "replicate_stream": replicate_stream,
        "current_state": lambda: consume(state.current_state(decoded, ["table", "uuid"])),
        "dedupe_replays": lambda: consume(state.dedupe_replays(records.unionByName(records))),
        "table_checksum": lambda: quality.table_checksum(log).collect(),
        "partial_checksum": lambda: quality.partial_checksum(log).collect(),
        "check_unique_key": lambda: consume(quality.check_unique_key(log)),
        "counter_delta": lambda: consume(
            metrics.counter_delta(samples, ["disk_read_total"], order=["timestamp", "offset"])
        ),
        "reconcile": lambda: qa.run_qa(spark, sources, lake)[0].collect(),
        "replicated_matches_source": lambda: queries.replicated_matches_source(
            spark, sf_dir
        ).collect(),
    }
    seconds = {name: min(timed(run_it) for _ in range(REPEATS)) for name, run_it in work.items()}
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": n,
                "stream_rows_per_sec": round(landing["rows_per_sec"]),
                "cpus": cpus,
                "memory_gb": round(
                    os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30, 1
                ),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
