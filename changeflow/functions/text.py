"""Canonical text of a row, and digests over it, as Spark SQL expressions.

The text must come out the same in every engine that computes it, so each type
has one fixed format, NULL has a mark of its own, and the separator is escaped
inside values: two different rows never share a text.

Expressions are built as SQL text and handed over once: a row has many small
parts, and building each as a column object costs a call to the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the row text format ---------------------------------------
SEPARATOR = "|"
NULL_MARK = r"\N"
JSON_TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
PLACES = 6  # decimals of a double that has no more
# ------------------------------------------------------------------------------


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


# A backslash as SQL: how a literal spells one depends on a session setting.
_BACKSLASH = "char(92)"
_NULL = f"concat({_BACKSLASH}, '{NULL_MARK[1:]}')"


def _escaped(text: str) -> str:
    doubled = f"replace({text}, {_BACKSLASH}, repeat({_BACKSLASH}, 2))"
    return f"replace({doubled}, '{SEPARATOR}', concat({_BACKSLASH}, '{SEPARATOR}'))"


def _time_text(value: str, dtype: T.DataType) -> str:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS``; instants are written in UTC.

    Neither form passes through the session zone.
    """
    if isinstance(dtype, T.TimestampType):
        epoch = "timestamp_ntz'1970-01-01 00:00:00'"
        value = f"timestampadd(MICROSECOND, unix_micros({value}), {epoch})"
    shown = f"cast({value} AS string)"
    return f"concat(substring({shown}, 1, 19), '.', rpad(substring({shown}, 21, 6), 6, '0'))"


def _plain_decimal(shown: str, scale: int) -> str:
    """Small decimals are printed with an exponent or without, as a session
    setting says; always without it here."""
    digits = f"replace(replace(split_part({shown}, 'E', 1), '-', ''), '.', '')"
    sign = f"CASE WHEN startswith({shown}, '-') THEN '-' ELSE '' END"
    plain = f"concat({sign}, '0.', lpad({digits}, {scale}, '0'))"
    return f"CASE WHEN contains({shown}, 'E') THEN {plain} ELSE {shown} END"


def value_text(name: str, dtype: T.DataType, scale: int | None = None) -> str:
    """Text of one column's value, NULL kept as NULL.

    A double with at most six decimals is written with six, any other (also NaN
    and infinity) as Spark prints it: different doubles have different texts.
    Engines print the others differently; ``scale`` rounds them on request.
    """
    value = quoted(name)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return _escaped(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _time_text(value, dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        plain = f"try_cast({value} AS decimal(38, {PLACES if scale is None else scale}))"
        fits = f"{plain} IS NOT NULL"
        if scale is None:
            fits += f" AND cast({plain} AS {dtype.simpleString()}) = {value}"
        return f"CASE WHEN {fits} THEN cast({plain} AS string) ELSE cast({value} AS string) END"
    if isinstance(dtype, T.DecimalType) and dtype.scale > PLACES:
        return _plain_decimal(f"cast({value} AS string)", dtype.scale)
    if isinstance(dtype, T.BinaryType):
        return f"hex({value})"
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return _escaped(f"to_json({value}, map('ignoreNullFields', 'false'))")
    return f"cast({value} AS string)"


def row_sql(df: DataFrame, columns: Sequence[str] | None = None, scale: int | None = None) -> str:
    """The row as one text, columns in the given (default: table) order."""
    schema = df.schema
    parts = [
        f"coalesce({value_text(name, schema[name].dataType, scale)}, {_NULL})"
        for name in columns or schema.fieldNames()
    ]
    return f"concat_ws('{SEPARATOR}', {', '.join(parts)})"


def row_text(df: DataFrame, columns: Sequence[str] | None = None, scale: int | None = None) -> Column:
    return F.expr(row_sql(df, columns, scale))


def digest_number(text: str) -> str:
    """The first eight hex digits of the MD5 as BIGINT (0 to 2**32 - 1)."""
    return f"cast(conv(substring(md5({text}), 1, 8), 16, 10) AS bigint)"


def exact_sum(number: str) -> str:
    """Sum of 32-bit numbers as decimal text, exact far beyond BIGINT.

    A BIGINT sum of 32-bit digests overflows after 2**31 rows.  The two 16-bit
    halves are summed apart, which holds for 2**47 rows and keeps the
    aggregation buffer in fixed-width longs, and are joined once at the end.
    """
    high = f"cast(coalesce(sum(shiftright({number}, 16)), 0) AS decimal(38, 0))"
    low = f"cast(coalesce(sum({number} & 65535), 0) AS decimal(38, 0))"
    return f"cast(cast({high} * cast(65536 AS decimal(6, 0)) + {low} AS decimal(38, 0)) AS string)"


def exact_xor(number: str) -> str:
    return f"coalesce(bit_xor({number}), 0)"
