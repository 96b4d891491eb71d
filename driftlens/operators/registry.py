"""The registry of watched tables: parsing and incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import registry_parts, ts_ntz
from driftlens.operators.common import not_in
from driftlens.operators.state import NO_STATE, current_hwm

PARTS = ["source", "catalog_name", "schema_name", "tbl_name"]


def parse_registry(
    registry: DataFrame, check_type: str = "schema", lower_all: bool = True, active_only: bool = False
) -> DataFrame:
    """Entries of one check type with their name split into connector,
    catalog, schema and table.

    Detection lowers all four parts; capture (``lower_all=False``) lowers only
    the connector. The original never filters on ``is_active``/``is_deleted``;
    ``active_only`` is opt-in.
    """
    r = registry.where(F.col("check_type") == check_type)
    if active_only:
        r = r.where(F.coalesce(F.col("is_active"), F.lit(True)) & ~F.coalesce(F.col("is_deleted"), F.lit(False)))
    parts = registry_parts(F.col("table_name"), lower_all)
    return r.select(
        "config_id",
        "table_name",
        *[parts[p].alias(p) for p in PARTS],
        F.col("is_deleted").cast("string").alias("is_deleted"),
        "updated_at",
    )


def due_entries(
    registry: DataFrame, baseline: DataFrame, state: DataFrame, check_type: str = "schema", hwm=NO_STATE
) -> DataFrame:
    """Entries newer than the high-water mark and not captured yet.

    * strictly newer: ``updated_at > hwm``; a NULL HWM selects nothing, as in SQL;
    * no state row at all: every entry is due (the original raised);
    * "not captured" is ``config_id NOT IN (captured ids)`` with SQL NULL rules,
      so one NULL id in the baseline stops all capture, as in the original.

    The HWM is a single scalar read once (pass ``hwm`` to reuse one already
    read); as a literal it is pushed down to the registry scan.
    """
    if hwm is NO_STATE:
        hwm = current_hwm(state, check_type)
    entries = parse_registry(registry, check_type, lower_all=False).where(is_newer(hwm))
    return not_in(entries, "config_id", baseline.select("config_id"))


def is_newer(hwm) -> Column:
    """Strictly newer than a high-water mark: nothing is if it is NULL,
    everything without a state row (:data:`NO_STATE`)."""
    if hwm is None or hwm is NO_STATE:
        return F.lit(hwm is NO_STATE)
    return F.col("updated_at") > ts_ntz(hwm)


def captured_configs(baseline: DataFrame) -> DataFrame:
    """Entries that already have a baseline."""
    return baseline.select("config_id").distinct()
