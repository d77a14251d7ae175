"""Change-event JSON to typed rows, with malformed records set aside.

``decode_changes`` is a narrow plan: no shuffle, no Python, one pass over the
records, usable on a batch or a stream.  It never fails on a record and never
drops one: what cannot be decoded keeps its raw text and says why in ``error``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions import json_fields as J
from changeflow.functions.text import quoted
from changeflow.schemas import (
    BARE,
    ENVELOPES,
    FLAT,
    INSERT,
    KEY,
    METRICS,
    NESTED,
    OPERATIONS,
    WRAPPED,
    row_schema,
)

# Reasons in the ``error`` column.
NULL_VALUE = "null_value"
NOT_AN_OBJECT = "not_json_object"
DATA_NOT_AN_OBJECT = "data_not_object"
NO_KEY = "no_key"
BAD_OPERATION = "bad_operation"
NO_DATA = "no_data"
NO_TOPIC = "no_topic"
BAD_FIELD = "bad_"

_POSITION = ("topic", "partition", "offset")


def decode_value(records: DataFrame) -> DataFrame:
    """Record value (bytes) to text."""
    return records.withColumn("value", F.col("value").cast("string"))


def _evaluate_once(parsed: DataFrame, keep: Sequence[str], fields: Sequence[Column]) -> DataFrame:
    """Add the fields through ``inline``.

    A filter on a plain projection is pushed down by repeating the projected
    expressions in it, here the whole JSON parse, several times over.  It cannot
    pass a generator's output, while filters on the kept columns (topic,
    offset) still reach the scan.
    """
    return parsed.select(*keep, F.inline(F.array(F.struct(*fields))))


def _keep_position(records: DataFrame) -> list[Column]:
    kept = [F.col(name) for name in _POSITION if name in records.columns]
    if "timestamp" in records.columns:
        kept.append(F.col("timestamp").alias("record_timestamp"))
    elif "record_timestamp" in records.columns:
        kept.append(F.col("record_timestamp"))
    return kept


def decode_changes(
    records: DataFrame,
    envelope: str,
    zoned: bool | None = None,
    schema: T.StructType | None = None,
    key: str = KEY,
    strict: bool = True,
) -> DataFrame:
    """Decode change events of one envelope.

    Output: ``operation``, ``table``, the row's columns, ``has_data``, the
    record's position, ``raw`` and ``error``.  ``table`` is NULL for envelopes
    that do not name it; bare rows are inserts by definition.  ``zoned`` reads
    timestamps as instants (default for bare and wrapped rows, whose source
    column has a zone).  With ``strict`` a field that does not cast is an
    error; otherwise it becomes NULL.
    """
    if envelope not in ENVELOPES:
        raise ValueError(f"unknown envelope {envelope!r}; expected one of {ENVELOPES}")
    if zoned is None:
        zoned = envelope in (BARE, WRAPPED)
    schema = schema or row_schema(zoned)
    names = schema.fieldNames()
    records = decode_value(records)
    position = _keep_position(records)
    source = records.select(F.col("value").alias("raw"), *position)
    extra = source.columns

    if envelope in (NESTED, WRAPPED):
        parsed = J.read_object(source, "raw", ("table", "action", "data"), "o")
        parsed = parsed.withColumn("data_text", F.col("o.data"))
        parsed = J.read_object(parsed, "data_text", names, "d")
        is_data = F.col("data_text").isNull() | F.col("d.is_object")
        # Only NULL and {} are no data; unknown columns alone are data.
        has_data = F.col("d.is_object") & (F.col("data_text") != "{}")
        has_data = F.coalesce(has_data, F.lit(False))
        row, operation, table = "d", F.col("o.action"), F.col("o.table")
    else:
        outer = names if envelope == BARE else ["operation", "table", *names]
        parsed = J.read_object(source, "raw", outer, "o")
        is_data, has_data, row = F.lit(True), F.lit(True), "o"
        if envelope == BARE:
            operation, table = F.lit(INSERT), F.lit(None).cast("string")
        else:
            operation, table = F.col("o.operation"), F.col("o.table")

    operation = F.upper(operation)
    texts = {name: F.col(f"{row}.`{name}`") for name in names}
    typed = {f.name: texts[f.name].try_cast(f.dataType) for f in schema.fields}
    error = (
        F.when(F.col("raw").isNull(), NULL_VALUE)
        .when(~F.col("o.is_object"), NOT_AN_OBJECT)
        .when(~is_data, DATA_NOT_AN_OBJECT)
        .when(has_data & (texts[key].isNull() | (texts[key] == "")), NO_KEY)
        .when(~F.coalesce(operation.isin(*OPERATIONS), F.lit(False)), BAD_OPERATION)
    )
    if strict:
        for f in schema.fields:
            if not isinstance(f.dataType, T.StringType):
                lost = texts[f.name].isNotNull() & typed[f.name].isNull()
                error = error.when(lost, BAD_FIELD + f.name)

    fields = [
        operation.alias("operation"),
        table.alias("table"),
        *[typed[name].alias(name) for name in names],
        has_data.alias("has_data"),
        error.alias("error"),
    ]
    decoded = _evaluate_once(parsed, extra, fields)
    return decoded.select(
        "operation", "table", *names, "has_data", *[n for n in extra if n != "raw"], "raw", "error"
    )


def parse_nested(records: DataFrame, zoned: bool = False) -> DataFrame:
    return decode_changes(records, NESTED, zoned)


def parse_wrapped(records: DataFrame, zoned: bool = True) -> DataFrame:
    return decode_changes(records, WRAPPED, zoned)


def parse_bare(records: DataFrame, zoned: bool = True) -> DataFrame:
    return decode_changes(records, BARE, zoned)


def parse_flat(records: DataFrame, zoned: bool = False) -> DataFrame:
    return decode_changes(records, FLAT, zoned)


def parse_metrics(records: DataFrame, kind: str = "host") -> DataFrame:
    """Decode metrics samples (``text``, ``broker`` or ``host``).

    A field that does not cast is NULL and the sample stays; only text that is
    no JSON object is an error.
    """
    schema = METRICS[kind]
    names = schema.fieldNames()
    records = decode_value(records)
    source = records.select(F.col("value").alias("raw"), *_keep_position(records))
    parsed = J.read_object(source, "raw", names, "o")
    error = F.when(F.col("raw").isNull(), NULL_VALUE).when(~F.col("o.is_object"), NOT_AN_OBJECT)
    fields = [F.col(f"o.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    decoded = _evaluate_once(parsed, source.columns, [*fields, error.alias("error")])
    return decoded.select(*names, *[n for n in source.columns if n != "raw"], "raw", "error")


def accepted(decoded: DataFrame) -> DataFrame:
    """Records that decoded, without the diagnostic columns."""
    return decoded.where(F.col("error").isNull()).drop("raw", "error")


def quarantine_malformed(decoded: DataFrame) -> DataFrame:
    """Records that did not decode: raw text, reason and position.

    A NULL value (a tombstone) is no change and no error; it is left out here
    and counted by :func:`decode_report`.
    """
    bad = decoded.where(F.col("error").isNotNull() & (F.col("error") != NULL_VALUE))
    kept = [n for n in (*_POSITION, "record_timestamp") if n in decoded.columns]
    return bad.select("raw", "error", *kept)


def without_data(decoded: DataFrame) -> DataFrame:
    """Accepted changes that carry no row: operation, raw text and position."""
    kept = [n for n in (*_POSITION, "record_timestamp") if n in decoded.columns]
    bare = decoded.where(F.col("error").isNull() & ~F.col("has_data"))
    return bare.select("operation", "raw", *kept)


def decode_report(decoded: DataFrame) -> DataFrame:
    """Records per outcome; ``ok`` for the accepted ones.  Batch only."""
    outcome = F.coalesce("error", F.lit("ok")).alias("outcome")
    return decoded.groupBy(outcome).agg(F.count("*").alias("records"))


def keep_unmatched(df: DataFrame, names: Sequence[str], text: str = "raw", into: str = "unmatched") -> DataFrame:
    """Add the fields of the JSON object in ``text`` that no name matches, whatever their case.

    They are an array of (key, value), keys spelled as given, so that repeated keys stay;
    empty if all fields match, NULL if the text is not one object.
    """
    known = ", ".join("'" + n.lower().replace("'", "\\'") + "'" for n in names)
    entries = "map_entries(CASE WHEN size(_maps) = 1 THEN _maps[0] END)"
    parsed = df.withColumn("_maps", F.expr(J.parse_maps(quoted(text))))
    unknown = F.expr(f"filter({entries}, e -> lower(e.key) NOT IN ({known}))")
    return parsed.withColumn(into, unknown).drop("_maps")


def field_report(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records per field that was not taken as it is: ``field``, ``problem``, ``records``.  Batch only.

    ``not_cast`` counts values that are there and became NULL, ``unknown`` fields that
    the schema lacks, in lower case.  A record counts once for a field and problem; records
    that are no JSON object are those of :func:`decode_report`.
    """
    names = schema.fieldNames()
    source = decode_value(records).select(F.col("value").alias("raw"))
    parsed = J.read_object(keep_unmatched(source, names), "raw", names, "o")
    lost = [
        F.when(F.col(f"o.`{f.name}`").isNotNull() & F.col(f"o.`{f.name}`").try_cast(f.dataType).isNull(), f.name)
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    unknown = F.coalesce(F.transform("unmatched", lambda e: F.lower(e["key"])), F.expr("CAST(array() AS array<string>)"))
    found = parsed.select(
        _problems(F.array(*lost) if lost else F.expr("CAST(array() AS array<string>)"), "not_cast").alias("a"),
        _problems(unknown, "unknown").alias("b"),
    )
    each = found.select(F.inline(F.concat("a", "b")))
    return each.groupBy("field", "problem").agg(F.count("*").alias("records"))


def _problems(fields: Column, problem: str) -> Column:
    named = F.array_distinct(F.array_compact(fields))
    return F.transform(named, lambda x: F.struct(x.alias("field"), F.lit(problem).alias("problem")))


def flatten(df: DataFrame, column: str) -> DataFrame:
    """Expand a struct column into its fields."""
    return df.select(f"{column}.*")


def open_wrapper(records: DataFrame) -> DataFrame:
    """Read only the outer object of wrapped events; ``data`` stays JSON text.

    For forwarding a row without interpreting it: nothing in the row is lost,
    whatever columns it has.
    """
    records = decode_value(records)
    kept = [F.col(n) for n in ("key", "channel") if n in records.columns]
    source = records.select(F.col("value").alias("raw"), *kept, *_keep_position(records))
    parsed = J.read_object(source, "raw", ("table", "action", "data"), "o")
    data = F.col("o.data")
    error = (
        F.when(F.col("raw").isNull(), NULL_VALUE)
        .when(~F.col("o.is_object"), NOT_AN_OBJECT)
        .when(~data.startswith("{"), DATA_NOT_AN_OBJECT)
    )
    fields = [
        F.col("o.table").alias("table"),
        F.upper(F.col("o.action")).alias("operation"),
        data.alias("data"),
        F.coalesce(data.startswith("{") & (data != "{}"), F.lit(False)).alias("has_data"),
        error.alias("error"),
    ]
    return _evaluate_once(parsed, source.columns, fields)


def unwrap_data(opened: DataFrame) -> DataFrame:
    """The bare row becomes the record value."""
    return opened.withColumn("value", F.col("data")).drop("data", "raw", "error", "has_data")


def project_to_table(
    df: DataFrame, schema: T.StructType, keep: Sequence[str] = ("operation", *_POSITION, "record_timestamp")
) -> DataFrame:
    """Exactly the target table's columns and types, plus position columns."""
    names = schema.fieldNames()
    kept = [n for n in keep if n in df.columns and n not in names]
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields], *kept
    )
