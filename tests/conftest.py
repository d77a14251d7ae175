from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def fresh(tmp_path):
    """A function that names a new folder each time."""
    made = []

    def folder(purpose: str = "f") -> str:
        made.append(purpose)
        return str(tmp_path / f"{purpose}-{len(made)}")

    return folder


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    shown = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in shown.collect()), key=repr)


@pytest.fixture(scope="session")
def plan_of():
    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
