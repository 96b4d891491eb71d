"""Column expressions over registry names and identifiers.

A registry entry names a watched table as ``connector:catalog.schema.table``.
Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a connector folds unquoted identifiers when its information_schema is
# queried. "exact" compares as written, "fold" compares upper() of both sides.
CASES = ("upper", "lower", "exact", "fold")


def _part(c: Column, delim: str, n: int) -> Column:
    return F.split_part(c, F.lit(delim), F.lit(n))


def registry_parts(name: Column, lower_all: bool = True) -> dict[str, Column]:
    """Split ``connector:catalog.schema.table`` into its four parts.

    A missing part is the empty string, as with SQL ``split_part``.
    Detection lowers every part; capture lowers only the connector.
    """
    rest = _part(name, ":", 2)
    parts = {
        "source": F.lower(_part(name, ":", 1)),
        "catalog_name": _part(rest, ".", 1),
        "schema_name": _part(rest, ".", 2),
        "tbl_name": _part(rest, ".", 3),
    }
    if lower_all:
        parts = {k: (v if k == "source" else F.lower(v)) for k, v in parts.items()}
    return parts


def qualified_name(source: Column, catalog: Column, schema: Column, table: Column) -> Column:
    """``source:catalog.schema.table`` with the three identifiers lowered.

    NULL in any part gives NULL, like SQL ``||``.
    """
    return F.concat(
        source, F.lit(":"), F.lower(catalog), F.lit("."), F.lower(schema), F.lit("."), F.lower(table)
    )


def fold(c: Column, case: str) -> Column:
    """Apply one identifier case rule to a registry-side literal."""
    if case == "upper":
        return F.upper(c)
    if case == "lower":
        return F.lower(c)
    if case in ("exact", "fold"):
        return c
    raise ValueError(f"unknown identifier case {case!r}; expected one of {CASES}")


def fold_by_source(c: Column, source: Column, cases: Mapping[str, str], default: str) -> Column:
    """Per-connector case rule, decided per row from the entry's connector."""
    out = fold(c, default)
    for src, case in cases.items():
        out = F.when(source == F.lit(src), fold(c, case)).otherwise(out)
    return out


def ts_ntz(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime, date or ISO string.

    Built from text so the value never passes through a time zone.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else str(value)
    return F.lit(text).cast("timestamp_ntz")
