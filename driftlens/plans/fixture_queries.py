"""The registered queries: every operator run over the fixture views.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL is in :mod:`driftlens.plans.oracle`. Column names are aliased to
match the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.operators import (
    advance_hwm,
    baseline_view,
    capture,
    captured_configs,
    detect,
    diff_status,
    due_entries,
    missing_columns,
    missing_tables,
    new_columns,
    parse_registry,
    report,
    snapshot,
    stored,
    to_anomaly_rows,
    value_change,
)
from driftlens.operators.common import not_in
from driftlens.plans.capture import incremental_capture
from driftlens.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# Fixture case rules: detection sees the source's upper-case identifiers;
# capture compares catalog and table exactly and folds the schema part,
# because the fixture registry spells it "Public" and the source "PUBLIC".
SNAPSHOT_CASE = "upper"
CAPTURE_CASE = {"catalog": "exact", "schema": "fold", "table": "exact"}
CONNECTOR_CASE = {"redshift_dev": "upper", "postgres_dev": "lower"}


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = fx.baseline(spark, sf_dir)
    return b, fx.cur(spark, sf_dir, b)


def _value(attr: str) -> Query:
    def q(spark, sf_dir):
        b, c = _pair(spark, sf_dir)
        return value_change(b, c, attr)

    return q


def value_change_nulls(spark, sf_dir):
    v = value_change(fx.baseline_nulls(spark, sf_dir), fx.cur_nulls(spark, sf_dir), "data_type")
    return v.select("config_id", "column_name", "data_type_old", "data_type")


def value_change_strict(spark, sf_dir):
    v = value_change(fx.baseline_nulls(spark, sf_dir), fx.cur_nulls(spark, sf_dir), "data_type", include_unmatched=False)
    return v.select("config_id", "column_name", "data_type_old", "data_type")


def new_column(spark, sf_dir):
    return new_columns(*_pair(spark, sf_dir))


def missing_column(spark, sf_dir):
    return missing_columns(*_pair(spark, sf_dir))


def table_miss(spark, sf_dir):
    return missing_tables(*_pair(spark, sf_dir))


def table_miss_distinct(spark, sf_dir):
    return missing_tables(*_pair(spark, sf_dir), distinct=True)


def schema_diff_status(spark, sf_dir):
    return diff_status(*_pair(spark, sf_dir)).select("config_id", "column_name", "status")


def registry_parsed(spark, sf_dir):
    p = parse_registry(fx.registry(spark, sf_dir))
    return p.select("config_id", "source", "catalog_name", "schema_name", "tbl_name")


def _due(spark, sf_dir):
    return due_entries(fx.registry(spark, sf_dir), fx.baseline(spark, sf_dir), fx.state(spark))


def due_entries_q(spark, sf_dir):
    return _due(spark, sf_dir).select("config_id", "is_deleted")


def due_entries_null_aware(spark, sf_dir):
    entries = parse_registry(fx.registry(spark, sf_dir)).select("config_id")
    b = fx.baseline(spark, sf_dir)
    ids = b.select(F.when((F.col("config_id") % 1000) == 7, F.lit(None)).otherwise(F.col("config_id")))
    return not_in(entries, "config_id", ids)


def due_entries_null_left(spark, sf_dir):
    """NULL ids on the left of NOT IN are in no result unless nothing is
    captured; the others are kept when they match no captured id."""
    r = fx.registry(spark, sf_dir)
    entries = r.select(F.when((F.col("config_id") % 7) != 0, F.col("config_id")).alias("config_id"), "check_type")
    return not_in(entries, "config_id", fx.baseline(spark, sf_dir).where((F.col("config_id") % 3) == 0).select("config_id"))


def current_snapshot(spark, sf_dir):
    entries = parse_registry(fx.registry(spark, sf_dir))
    return snapshot(fx.live_columns(spark, sf_dir), entries, case=SNAPSHOT_CASE)


def current_snapshot_case(spark, sf_dir):
    """Two connectors, each matched by its own case rule."""
    entries = parse_registry(fx.registry_two(spark, sf_dir))
    return snapshot(fx.live_columns_two(spark, sf_dir), entries, case="exact", source_case=CONNECTOR_CASE)


def stored_snapshot(spark, sf_dir):
    entries = parse_registry(fx.registry(spark, sf_dir))
    s = stored(fx.baseline(spark, sf_dir), entries, match="eq")
    return s.select("config_id", "table_name", "column_name", "data_type")


def stored_snapshot_like(spark, sf_dir):
    r = fx.registry(spark, sf_dir).where(F.col("check_type") == "schema")
    entries = r.select("config_id", F.replace(F.lower("table_name"), F.lit("_1"), F.lit("__")).alias("pattern"))
    s = stored(fx.baseline(spark, sf_dir), entries, match="like", pattern_col="pattern")
    return s.select("config_id", "table_name", "column_name")


def hwm_advance(spark, sf_dir):
    return advance_hwm(fx.state(spark), fx.registry(spark, sf_dir))


def detect_all(spark, sf_dir):
    b, c = _pair(spark, sf_dir)
    return detect(b, c, fx.rules(spark))


def anomaly_rows(spark, sf_dir):
    return to_anomaly_rows(detect_all(spark, sf_dir), fx.run_timestamp())


def _report(kind: str) -> Query:
    def q(spark, sf_dir):
        return report(
            anomaly_rows(spark, sf_dir), fx.registry(spark, sf_dir), fx.rules(spark), kind, fx.REPORT_DAY, fx.REVIEW_LINK
        )

    return q


def captured_configs_q(spark, sf_dir):
    return captured_configs(fx.baseline(spark, sf_dir))


def capture_baseline(spark, sf_dir):
    reg = fx.registry(spark, sf_dir)
    due = due_entries(reg, fx.baseline(spark, sf_dir), fx.state(spark))
    return capture(due, fx.live_columns(spark, sf_dir), case=CAPTURE_CASE)


def incremental_capture_q(spark, sf_dir):
    """The baseline after one capture run: old rows plus the captured ones."""
    b = fx.baseline(spark, sf_dir)
    run = incremental_capture(
        fx.registry(spark, sf_dir), fx.live_columns(spark, sf_dir), b, fx.state(spark), case=CAPTURE_CASE
    )
    return run.baseline_after


def detect_captured(spark, sf_dir):
    """Detection on what capture wrote: the baseline after one capture run,
    named by the registry, against the live metadata."""
    reg = fx.registry(spark, sf_dir)
    entries = parse_registry(reg)
    view = baseline_view(incremental_capture_q(spark, sf_dir), reg)
    current = snapshot(fx.live_columns(spark, sf_dir), entries, case=SNAPSHOT_CASE)
    return detect(stored(view, entries), current, fx.rules(spark))


QUERIES: dict[str, Query] = {
    "value_change_datatype": _value("data_type"),
    "value_change_length": _value("character_maximum_length"),
    "value_change_is_null": _value("is_nullable"),
    "value_change_ordinal": _value("ordinal_position"),
    "value_change_nulls": value_change_nulls,
    "value_change_strict": value_change_strict,
    "new_column": new_column,
    "missing_column": missing_column,
    "table_miss": table_miss,
    "table_miss_distinct": table_miss_distinct,
    "schema_diff_status": schema_diff_status,
    "registry_parsed": registry_parsed,
    "due_entries": due_entries_q,
    "due_entries_null_aware": due_entries_null_aware,
    "due_entries_null_left": due_entries_null_left,
    "current_snapshot": current_snapshot,
    "current_snapshot_case": current_snapshot_case,
    "stored_snapshot": stored_snapshot,
    "stored_snapshot_like": stored_snapshot_like,
    "hwm_advance": hwm_advance,
    "detect_all": detect_all,
    "anomaly_rows": anomaly_rows,
    "report_missing_attributes": _report("missing_attributes"),
    "report_new_attributes": _report("new_attributes"),
    "report_datatype_changes": _report("datatype_changes"),
    "report_length_changes": _report("length_changes"),
    "report_ordinal_position": _report("ordinal_position"),
    "report_nullable_changes": _report("nullable_changes"),
    "report_missing_data_source": _report("missing_data_source"),
    "captured_configs": captured_configs_q,
    "capture_baseline": capture_baseline,
    "incremental_capture": incremental_capture_q,
    "detect_captured": detect_captured,
}
