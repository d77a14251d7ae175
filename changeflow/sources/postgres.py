"""Check values computed inside PostgreSQL, in the text format of this library.

Reading a whole source table to compare it costs more than comparing: these
queries run in the database and return one row, to be read with
``jdbc_options(url, query=...)`` and given to ``reconcile.stats_from_query``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from changeflow.functions.text import NULL_MARK, PLACES, SEPARATOR
from changeflow.operators.quality import SAMPLE_ROWS
from changeflow.operators.reconcile import (
    CHECKS,
    KEY_CHECKSUM,
    ROW_CHECKSUM,
    ROW_COUNT,
    SAMPLE_CHECKSUM,
)

# Fixed value: the timestamp format of the row text.
TIMESTAMP_FORMAT = "YYYY-MM-DD HH24:MI:SS.US"


def value_sql(name: str, dtype: T.DataType, scale: int | None = None) -> str:
    """SQL text of one column's value, as ``functions.text.value_text`` writes it."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return rf"replace(replace({name}, '\', '\\'), '{SEPARATOR}', '\{SEPARATOR}')"
    if isinstance(dtype, T.TimestampNTZType):
        return f"to_char({name}, '{TIMESTAMP_FORMAT}')"
    if isinstance(dtype, T.TimestampType):
        return f"to_char({name} AT TIME ZONE 'UTC', '{TIMESTAMP_FORMAT}')"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        plain = f"CAST({name} AS numeric(38, {PLACES if scale is None else scale}))"
        cases = [f"WHEN {name} = '{v}' THEN '{v}'" for v in ("NaN", "Infinity", "-Infinity")]
        cases.append(f"WHEN abs({name}) >= 1e32 THEN CAST({name} AS text)")
        if scale is None:
            of_type = "double precision" if isinstance(dtype, T.DoubleType) else "real"
            cases.append(f"WHEN CAST({plain} AS {of_type}) <> {name} THEN CAST({name} AS text)")
        return f"CASE {' '.join(cases)} ELSE CAST({plain} AS text) END"
    if isinstance(dtype, T.BinaryType):
        return f"upper(encode({name}, 'hex'))"
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType)):
        return f"CAST({name} AS text)"
    raise ValueError(f"{name}: no common text for {dtype.simpleString()}")


def row_sql(schema: T.StructType, columns: Sequence[str] | None = None) -> str:
    names = list(columns or schema.fieldNames())
    parts = [f"coalesce({value_sql(n, schema[n].dataType)}, '{NULL_MARK}')" for n in names]
    return f"concat_ws('{SEPARATOR}', {', '.join(parts)})"


def _digest(text: str) -> str:
    number = f"CAST(CAST('x' || substr(md5({text}), 1, 8) AS bit(32)) AS bigint)"
    return f"concat(coalesce(sum({number}), 0), ':', coalesce(bit_xor({number}), 0))"


def stats_query(
    table: str,
    schema: T.StructType,
    key: str = "uuid",
    checks: Sequence[str] = CHECKS,
    sample: int = SAMPLE_ROWS,
) -> str:
    """One row with a column per check.  Needs ``bit_xor`` (PostgreSQL 14)."""
    text = row_sql(schema)
    columns = {
        ROW_COUNT: "count(*)",
        KEY_CHECKSUM: _digest(row_sql(schema, [key])),
        ROW_CHECKSUM: _digest(text),
        SAMPLE_CHECKSUM: (
            "(SELECT coalesce(md5(string_agg(t, '' ORDER BY k, t)), '') FROM "
            f'(SELECT {key} COLLATE "C" AS k, {text} COLLATE "C" AS t FROM {table} '
            f"ORDER BY 1, 2 LIMIT {sample}) s)"
        ),
    }
    return "SELECT " + ", ".join(f"{columns[c]} AS {c}" for c in checks) + f" FROM {table}"
