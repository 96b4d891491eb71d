"""Per-rule comparisons of a baseline snapshot (``old``) with a live one (``new``).

Every join carries ``config_id``: the same physical table may be registered by
two entries, and each entry is compared with its own baseline.

These are the building blocks; :func:`driftlens.operators.detect.detect`
evaluates all rules in one pass and is what a detection run uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.functions.predicates import changed, distinct_from
from driftlens.types import ATTRIBUTES, KEYS, TABLE_KEYS


def _check_attr(attr: str) -> None:
    if attr not in ATTRIBUTES:
        raise ValueError(f"unknown attribute {attr!r}; expected one of {sorted(ATTRIBUTES)}")


def value_change(old: DataFrame, new: DataFrame, attr: str, include_unmatched: bool = True) -> DataFrame:
    """Columns whose ``attr`` differs between baseline and live.

    ``include_unmatched=True`` keeps the original rule: a left join, where a
    baseline column missing from the live side (NULL) counts as changed, and so
    does NULL against NULL. ``False`` compares matched columns only, NULL-safe.

    Output: keys, ``<attr>_old``, ``<attr>``. Duplicate keys multiply, as in
    any equi join.
    """
    _check_attr(attr)
    o = old.select(*KEYS, F.col(attr).alias(f"{attr}_old"))
    n = new.select(*KEYS, F.col(attr))
    if include_unmatched:
        j = o.join(n, KEYS, "left")
        return j.where(changed(F.col(f"{attr}_old"), F.col(attr)))
    j = o.join(n, KEYS, "inner")
    return j.where(distinct_from(F.col(f"{attr}_old"), F.col(attr)))


def new_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Live columns with no baseline row: one output row per live row."""
    return new.select(*KEYS).join(old.select(*KEYS), KEYS, "left_anti")


def missing_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Baseline columns with no live row: one output row per baseline row."""
    return old.select(*KEYS).join(new.select(*KEYS), KEYS, "left_anti")


def dropped_tables(old: DataFrame, new: DataFrame) -> DataFrame:
    """(config_id, table_name) of baseline tables with no live column: both
    sides are reduced to distinct tables (partial aggregation, one row per
    table however many columns it has) before they meet."""
    return old.select(*TABLE_KEYS).distinct().join(new.select(*TABLE_KEYS).distinct(), TABLE_KEYS, "left_anti")


def join_tables(rows: DataFrame, tables: DataFrame, how: str) -> DataFrame:
    """``rows`` joined to a table-level set on (config_id, table_name).

    The name's length is a third key, which changes no match. It makes the
    planner shuffle the aggregated set once more (it is one row per table), so
    that both join inputs are plain shuffles: AQE can then broadcast a set it
    measured to be small, or split a table that holds many of the rows.
    """
    length = F.length("table_name")
    joined = rows.withColumn("_length", length).join(tables.withColumn("_length", length), [*TABLE_KEYS, "_length"], how)
    return joined.drop("_length")


def missing_tables(old: DataFrame, new: DataFrame, distinct: bool = False) -> DataFrame:
    """Registered tables with no live column at all.

    The original rule reports one row per baseline column of a dropped table;
    ``distinct=True`` gives one row per table.
    """
    gone = dropped_tables(old, new)
    return gone if distinct else join_tables(old.select(*TABLE_KEYS), gone, "left_semi")


def diff_status(old: DataFrame, new: DataFrame) -> DataFrame:
    """The full outer join's indicator kept as data: ``both``, ``left_only``
    or ``right_only`` per key. Each input is shuffled once."""
    o = old.select(*KEYS, F.lit(True).alias("_in_old"))
    n = new.select(*KEYS, F.lit(True).alias("_in_new"))
    status = F.when(F.col("_in_old").isNull(), "right_only").when(F.col("_in_new").isNull(), "left_only").otherwise("both")
    return o.join(n, KEYS, "full").select(*KEYS, status.alias("status"))
