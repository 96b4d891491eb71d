"""Live metadata: match registry entries to information_schema rows.

The original issued one information_schema query per registered table. Here
the live columns of a source (one read per connector and catalog, see
:mod:`driftlens.sources.information_schema`) meet all entries in a single
equi-join on (catalog, schema, table). No side is hinted: the optimizer
broadcasts one whose size it knows to be small, AQE one that it has measured.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import fold, fold_by_source, qualified_name

# Connector whose identifiers are folded to upper case at detection time
# (fixed value of the original rule; every other connector folds to lower).
UPPER_CASE_CONNECTORS = {"snowflake_uat": "upper"}

_PARTS = (("catalog", "catalog_name", "table_catalog"), ("schema", "schema_name", "table_schema"), ("table", "tbl_name", "table_name"))


def _conditions(
    e: DataFrame, c: DataFrame, case: str | Mapping[str, str], source_case: Mapping[str, str] | None
) -> list[Column]:
    """Join conditions entry-part = live-part under the case rules.

    ``case`` is one mode for all parts or a mode per part (``catalog``,
    ``schema``, ``table``). ``source_case`` overrides the mode per connector
    (upper/lower/exact only). ``fold`` compares upper() of both sides.
    """
    conds = []
    for part, entry_col, live_col in _PARTS:
        mode = case.get(part, "exact") if isinstance(case, Mapping) else case
        ev, lv = e[entry_col], c[live_col]
        if mode == "fold":
            conds.append(F.upper(lv) == F.upper(ev))
        elif source_case:
            conds.append(lv == fold_by_source(ev, e["source"], source_case, mode))
        else:
            conds.append(lv == fold(ev, mode))
    if "source" in c.columns:
        conds.append(c["source"] == e["source"])
    return conds


def _match(entries: DataFrame, columns: DataFrame, case, source_case) -> tuple[DataFrame, DataFrame]:
    e = entries.select("config_id", "source", "catalog_name", "schema_name", "tbl_name")
    return e.join(columns, _conditions(e, columns, case, source_case), "inner"), e


def snapshot(
    columns: DataFrame,
    entries: DataFrame,
    case: str | Mapping[str, str] = "lower",
    source_case: Mapping[str, str] | None = None,
) -> DataFrame:
    """Current column metadata of every entry, in the layout the diff compares.

    ``entries`` comes from ``parse_registry(lower_all=True)``. Identifiers and
    types are lowered, a NULL length becomes 0, the ordinal becomes an int,
    and rows are de-duplicated (``SELECT DISTINCT``) per entry.
    """
    j, e = _match(entries, columns, case, source_case)
    return j.select(
        e["config_id"],
        qualified_name(e["source"], columns["table_catalog"], columns["table_schema"], columns["table_name"]).alias(
            "table_name"
        ),
        F.lower(columns["column_name"]).alias("column_name"),
        F.lower(columns["data_type"]).alias("data_type"),
        F.lower(columns["is_nullable"]).alias("is_nullable"),
        F.coalesce(columns["character_maximum_length"], F.lit(0)).cast("int").alias("character_maximum_length"),
        columns["ordinal_position"].cast("int").alias("ordinal_position"),
    ).distinct()


def capture(
    entries: DataFrame,
    columns: DataFrame,
    case: str | Mapping[str, str] = "exact",
    source_case: Mapping[str, str] | None = None,
) -> DataFrame:
    """Baseline rows (schema_configuration layout) for the given entries.

    Capture compares identifiers exactly by default and keeps duplicates (no
    DISTINCT), as the original did. ``entries`` comes from
    :func:`driftlens.operators.registry.due_entries`.
    """
    j, e = _match(entries, columns, case, source_case)
    return j.select(
        e["config_id"],
        F.lower(columns["column_name"]).alias("column_name"),
        F.lower(columns["data_type"]).alias("data_type"),
        F.lower(columns["is_nullable"]).alias("is_nullable"),
        F.coalesce(columns["character_maximum_length"], F.lit(0)).cast("int").alias("character_maximum_length"),
        columns["ordinal_position"].cast("int").alias("ordinal_position"),
    )


def unmatched_entries(entries: DataFrame, columns: DataFrame, case="exact", source_case=None) -> DataFrame:
    """Entries whose table has no live column (the original skipped them
    silently and the HWM then passed them by).

    The matched entries come from the same join as the capture and are
    de-duplicated (partially before any shuffle) ahead of the anti join.
    """
    cols = ["config_id", "source", "catalog_name", "schema_name", "tbl_name"]
    j, e = _match(entries, columns, case, source_case)
    matched = j.select(*[e[c] for c in cols]).distinct()
    return entries.select(*cols).join(matched, cols, "left_anti")
