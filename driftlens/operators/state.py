"""High-water-mark state (master_config_status)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _NoState:
    """Marker: the state table has no row for the check type."""

    def __repr__(self) -> str:
        return "NO_STATE"


NO_STATE = _NoState()


def hwm_rows(state: DataFrame, check_type: str = "schema") -> DataFrame:
    """The stored high-water mark of one check type, as ``last_run_date``."""
    return state.where(F.col("check_type") == check_type).select(F.col("updated_at").alias("last_run_date"))


def current_hwm(state: DataFrame, check_type: str = "schema"):
    """The HWM as a driver scalar: a datetime, ``None`` when the stored value
    is NULL, or :data:`NO_STATE` when there is no row. Several rows: the latest.
    """
    r = (
        state.where(F.col("check_type") == check_type)
        .agg(F.max("updated_at").alias("hwm"), F.count(F.lit(1)).alias("n"))
        .first()
    )
    if r is None or r["n"] == 0:
        return NO_STATE
    return r["hwm"]


def advance_hwm(state: DataFrame, registry: DataFrame, check_type: str = "schema") -> DataFrame:
    """New state: the check type's HWM becomes the latest ``updated_at`` of its
    entries in the registry snapshot that was processed.

    Computing the max from the same snapshot the run read (not at update time)
    means an entry added during the run is picked up next time. With no
    entries the old value is kept instead of becoming NULL. Other check types
    pass through. The max is an uncorrelated scalar subquery, evaluated once.
    """
    latest = registry.where(F.col("check_type") == check_type).agg(F.max("updated_at")).scalar()
    return state.select(
        "check_type",
        F.when(F.col("check_type") == check_type, F.coalesce(latest, F.col("updated_at")))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )
