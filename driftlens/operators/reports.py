"""The seven daily anomaly reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import ts_ntz
from driftlens.operators.detect import Rule, rule_specs

# Report key -> (title, rule name, value column shown as
# Previous/Current or None for attribute-only reports, show Attributes).
REPORTS: dict[str, tuple[str, str, str | None, bool]] = {
    "missing_attributes": ("Missing Attributes", "missing_column", None, True),
    "new_attributes": ("New Attributes", "new_column", None, True),
    "datatype_changes": ("Datatype Changes", "datatype", "data_type", True),
    "length_changes": ("Length Changes", "length", "character_maximum_length", True),
    "ordinal_position": ("Ordinal Position", "ordinal", "ordinal_position", True),
    "nullable_changes": ("Nullable Changes", "is_null", "is_nullable", True),
    "missing_data_source": ("Missing Data Source", "table_miss", None, False),
}


# Fixed value: the report of dropped columns takes every rule that the
# dispatch classes as one, whatever the catalogue calls it.
MISSING_COLUMN = "missing_column"


def _anomaly_ids(specs: list[Rule], rule_name: str) -> list[int]:
    """Ids of all rules a report shows; without any the report is empty."""
    if rule_name == MISSING_COLUMN:
        return [s.anamoly_id for s in specs if s.kind == "missing"]
    return [s.anamoly_id for s in specs if s.name == rule_name]


def _day_bounds(day) -> tuple:
    d = dt.date.fromisoformat(day) if isinstance(day, str) else (day.date() if isinstance(day, dt.datetime) else day)
    return ts_ntz(dt.datetime.combine(d, dt.time())), ts_ntz(dt.datetime.combine(d + dt.timedelta(days=1), dt.time()))


def report(
    anomalies: DataFrame,
    registry: DataFrame,
    rules: DataFrame | list[Rule],
    kind: str,
    day,
    link: str,
) -> DataFrame:
    """One report: the run day's anomalies of one rule with the entry's name.

    The day is a half-open timestamp range (``>= day``, ``< day + 1``), not
    ``date(updated_at) = day``, so it can prune a run-date partitioned sink and
    push down to the scan. The anomaly id comes from the rule catalogue.
    Sorted by source then attribute.

    Identical report rows are common (a dropped table gives one row per
    baseline column, all alike), so they are counted first (partial
    aggregation before the shuffle), the distinct rows are sorted, and the
    copies are expanded after the sort: every row is kept and in order, and
    no range partition of the sort holds one hot group.
    """
    if kind not in REPORTS:
        raise KeyError(f"unknown report {kind!r}; expected one of {sorted(REPORTS)}")
    _, rule_name, value_col, with_attr = REPORTS[kind]
    specs = rules if isinstance(rules, list) else rule_specs(rules)
    ids = _anomaly_ids(specs, rule_name)
    lo, hi = _day_bounds(day)
    a = anomalies.where(F.col("anamoly_id").isin(ids) & (F.col("updated_at") >= lo) & (F.col("updated_at") < hi))
    r = registry.select("config_id", F.col("table_name").alias("Data_Source"))
    j = a.join(r, "config_id", "inner")
    cols = [F.col("Data_Source")]
    if with_attr:
        cols.append(F.col("column_name").alias("Attributes"))
    if value_col:
        cols += [F.col(f"{value_col}_old").alias("Previous"), F.col(value_col).alias("Current")]
    cols.append(F.lit(link).alias("validation"))
    order = ["Data_Source", "Attributes"] if with_attr else ["Data_Source"]
    rows = j.select(*cols)
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies")).orderBy(*order)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return counted.select(*names, copies.alias("_copy")).drop("_copy")


def all_reports(anomalies, registry, rules, day, link) -> dict[str, DataFrame]:
    """All seven reports, titled as the alert shows them."""
    specs = rules if isinstance(rules, list) else rule_specs(rules)
    return {REPORTS[k][0]: report(anomalies, registry, specs, k, day, link) for k in REPORTS}
