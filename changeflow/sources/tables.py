"""Batch tables: lake tables by path or name, relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from changeflow.operators.layout import rebalance


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a lake table by path.

    Give the schema for parquet: an empty partitioned folder has none, and no
    footer is read to infer it.  Delta keeps its own.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a relational read.

    ``query`` runs in the database and returns its result (a count, an
    aggregate).  ``partition`` is (column, lower, upper, tasks): without it one
    task reads the whole table.  Rows outside the bounds are read too, by the
    first and last task.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if query is not None:
        if partition:
            raise ValueError("a query cannot be partitioned; read the table")
        return {**options, "query": query}
    options["dbtable"] = table
    if partition:
        column, lower, upper, tasks = partition
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(tasks),
        )
    return options


def read_source_table(spark: SparkSession, source: Mapping[str, object]) -> DataFrame:
    """The source side of a check.

    ``source`` has ``format`` and either JDBC settings (see
    :func:`jdbc_options`) or the ``path`` of a snapshot.
    """
    settings = dict(source)
    fmt = settings.pop("format", "jdbc")
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
    return read_table(spark, settings["path"], settings.get("schema"), fmt)


def count_query(table: str) -> str:
    """Count in the database: one row crosses the connection."""
    return f"SELECT COUNT(*) AS row_count FROM {table}"


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
) -> None:
    """Insert rows into a relational table, columns by name.

    ``connections`` bounds the sessions the database sees at a time.
    """
    options = {"batchsize": str(batch_size), "numPartitions": str(connections), **(properties or {})}
    df.write.mode("append").options(**options).jdbc(url, table)


def _column_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def init_tables(
    spark: SparkSession,
    tables: Mapping[str, tuple[T.StructType, Sequence[str]]],
    root: str,
    fmt: str = "parquet",
    overwrite: bool = False,
) -> list[str]:
    """Create empty partitioned tables that do not exist yet.

    ``tables`` maps a name to (schema, partition columns).  An existing table
    keeps its rows; ``overwrite`` empties it, and the caller must then also
    start from a new stream checkpoint.
    """
    for name, (schema, partitions) in tables.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_column_ddl(schema)}) USING {fmt} "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{root}/{name}'"
        )
        if overwrite:
            empty = spark.createDataFrame([], spark.table(name).schema)
            static = empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
            static.insertInto(name)
    return list(tables)


def append_table(df: DataFrame, name: str, partitions: Sequence[str], fmt: str = "parquet") -> None:
    """Append a batch to a table made by :func:`init_tables`, columns by name."""
    columns = df.sparkSession.table(name).columns
    rows = rebalance(df.select(*columns), partitions)
    rows.write.mode("append").format(fmt).partitionBy(*partitions).saveAsTable(name)


def write_table(
    df: DataFrame, path: str, partitions: Sequence[str] = (), fmt: str = "parquet",
    mode: str = "append",
) -> None:
    """Write a batch to a path in well-sized files per partition value."""
    rows = rebalance(df, partitions) if partitions else df
    writer = rows.write.format(fmt).mode(mode)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def save_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
    fmt: str = "parquet", arranged: bool = False,
) -> None:
    """Write a table bucketed and sorted by its keys.

    Later joins and aggregations on the keys read it without a shuffle.  The
    rows are brought together by bucket first, so each bucket is one file.
    ``arranged`` leaves that shuffle out, for rows that come from a join on the
    keys of a table with the same buckets (``operators.state.fold_changes``).
    """
    rows = df if arranged else df.repartition(buckets, *keys)
    writer = rows.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
