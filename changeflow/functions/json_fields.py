"""Case-insensitive reading of JSON objects with built-in functions.

``from_json`` matches names exactly.  Almost every record spells its keys the
way the schema does, so each record is first parsed straight into a struct of
strings.  Only records that this cannot settle (a key that is not lower case,
text that does not fit) take the second route: parse into a map, fold the key
case, look the fields up.  ``when`` evaluates the second route for those
records alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def string_types(names: Sequence[str]) -> str:
    return ", ".join(f"`{name}`: string" for name in names)


def parse_exact(text: str, names: Sequence[str]) -> str:
    """Parse into an array of structs of strings; one element for one JSON value.

    The brackets make text after the value an error: a second value would be a
    second element, anything else gives NULL.
    """
    return f"from_json(concat('[', {text}, ']'), 'array<struct<{string_types(names)}>>')"


def has_plain_keys(text: str) -> str:
    """True for one JSON object whose keys are lower case already.

    Listing the keys is much cheaper than a regular expression over the text,
    and sees them unescaped.
    """
    keys = f"array_join(json_object_keys({text}), ' ')"
    return f"{keys} = lower({keys})"


def parse_maps(text: str) -> str:
    """Parse into an array of maps; one element for one JSON object and nothing else."""
    return f"from_json(concat('[', {text}, ']'), 'array<map<string,string>>')"


def folded_entries(maps: str) -> str:
    """The object's entries with lower-case keys; NULL if it is not one object.

    Entries stay an array: building a map again would fail on two keys that
    differ only in case unless the session sets a de-duplication policy.
    """
    entries = f"map_entries(CASE WHEN size({maps}) = 1 THEN {maps}[0] END)"
    return f"transform({entries}, e -> struct(lower(e.key) AS key, e.value AS value))"


def entry_value(entries: str, name: str) -> str:
    """Value of the last entry with this key, NULL when there is none."""
    return f"try_element_at(filter({entries}, e -> e.key = '{name}'), -1).value"


def read_object(df: DataFrame, text: str, names: Sequence[str], into: str) -> DataFrame:
    """Add struct ``into``: ``is_object`` and the text of each named field.

    Each step is a projection of its own, so that nothing is parsed twice.
    """
    exact, fast, maps, entries = (f"_{into}_{step}" for step in ("exact", "fast", "maps", "entries"))
    fits = f"size({exact}) = 1 AND {exact}[0] IS NOT NULL"
    parsed = (
        df.selectExpr(
            "*", f"{parse_exact(text, names)} AS {exact}", f"{has_plain_keys(text)} AS _plain"
        )
        .selectExpr("*", f"coalesce(_plain AND {fits}, false) AS {fast}")
        .selectExpr("*", f"CASE WHEN NOT {fast} THEN {parse_maps(text)} END AS {maps}")
        .selectExpr("*", f"{folded_entries(maps)} AS {entries}")
    )
    fields = [f"({fast} OR {entries} IS NOT NULL) AS is_object"]
    fields += [
        f"CASE WHEN {fast} THEN {exact}[0].`{n}` ELSE {entry_value(entries, n)} END AS `{n}`"
        for n in names
    ]
    kept = [F.col(f"`{c}`") for c in df.columns]
    return parsed.select(*kept, F.expr(f"struct({', '.join(fields)})").alias(into))
