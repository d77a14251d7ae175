"""Row changes to change-event JSON, and stream records around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.text import JSON_TIMESTAMP, JSON_TIMESTAMP_NTZ
from changeflow.schemas import BARE, DELETE, FLAT, KEY, NESTED, WRAPPED

# to_json writes milliseconds and drops NULL fields unless told otherwise.
JSON_OPTIONS = {
    "timestampNTZFormat": JSON_TIMESTAMP_NTZ,
    "timestampFormat": JSON_TIMESTAMP,
    "ignoreNullFields": "false",
}


def to_json_text(value: Column) -> Column:
    return F.to_json(value, JSON_OPTIONS)


def row_image(operation: Column, old: Column, new: Column) -> Column:
    """The image a change event carries: OLD for a delete, NEW otherwise."""
    return F.when(operation == DELETE, old).otherwise(new)


def encode_nested(row: Column, operation: Column) -> Column:
    return to_json_text(F.struct(operation.alias("action"), row.alias("data")))


def encode_wrapped(row: Column, operation: Column, table: Column) -> Column:
    return to_json_text(
        F.struct(table.alias("table"), operation.alias("action"), row.alias("data"))
    )


def encode_bare(row: Column) -> Column:
    return to_json_text(row)


def encode_flat(row: Column, operation: Column, table: Column, fields: Sequence[str]) -> Column:
    columns = [operation.alias("operation"), table.alias("table")]
    columns += [row[name].alias(name) for name in fields]
    return to_json_text(F.struct(*columns))


def encode_changes(
    changes: DataFrame,
    envelope: str,
    fields: Sequence[str],
    optional: Sequence[str] = (),
    operation: str = "operation",
    table: str = "table",
) -> DataFrame:
    """Add ``value``: the change event of each row as JSON text.

    ``changes`` has one row per change with ``operation``, ``table`` and either
    the row's columns or ``old`` and ``new`` structs of them.  ``fields`` are
    the columns every event carries; ``optional`` ones appear only where they
    are not NULL (a table without the column never shows it).
    """
    op, tbl = F.col(operation), F.col(table)
    if {"old", "new"} <= set(changes.columns):
        image = row_image(op, F.col("old"), F.col("new"))
    else:
        image = F.struct(*[F.col(f"`{name}`") for name in [*fields, *optional]])

    def event(names: Sequence[str]) -> Column:
        row = F.struct(*[image[name].alias(name) for name in names])
        if envelope == NESTED:
            return encode_nested(row, op)
        if envelope == WRAPPED:
            return encode_wrapped(row, op, tbl)
        if envelope == BARE:
            return encode_bare(row)
        if envelope == FLAT:
            return encode_flat(row, op, tbl, names)
        raise ValueError(f"unknown envelope {envelope!r}")

    value = event(fields)
    if optional:
        present = [image[name].isNotNull() for name in optional]
        any_present = present[0]
        for condition in present[1:]:
            any_present = any_present | condition
        value = F.when(any_present, event([*fields, *optional])).otherwise(value)
    return changes.withColumn("value", value)


def record_key(df: DataFrame, column: str = KEY) -> DataFrame:
    """Add the record key.  One row's changes share a key, so they land in one
    stream partition and their offsets give their order."""
    return df.withColumn("key", F.col(column).cast("binary"))
