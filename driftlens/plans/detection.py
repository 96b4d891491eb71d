"""Detection run (job 2) and its reports.

registry -> entries -> live snapshot (read once, checkpointed) and stored
baseline -> all rules in one pass -> anomaly rows -> run-date partition of
the anomaly table. One plan, one write; only the rule catalogue and the number
of anomalies reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from driftlens.operators.detect import detect, rule_specs, to_anomaly_rows
from driftlens.operators.registry import parse_registry
from driftlens.operators.reports import all_reports
from driftlens.operators.snapshot import UPPER_CASE_CONNECTORS, snapshot
from driftlens.operators.stored import baseline_view as named
from driftlens.operators.stored import stored
from driftlens.sinks.store import Store
from driftlens.sources.connectors import Connector, case_rules
from driftlens.sources.live import LiveMetadata, live_for_detection
from driftlens.types import BASELINE


@dataclass
class DetectionRun:
    entries: DataFrame
    current: DataFrame
    baseline: DataFrame
    anomalies: DataFrame
    found: int | None = None  # anomalies written, once they are


def plan_detection(
    registry: DataFrame,
    live_columns: DataFrame | LiveMetadata,
    baseline_view: DataFrame,
    rules: DataFrame,
    run_ts,
    case: str | Mapping[str, str] = "lower",
    source_case: Mapping[str, str] | None = UPPER_CASE_CONNECTORS,
    match: str = "eq",
    check_type: str = "schema",
    freeze_live: bool = True,
    connectors: Mapping[str, Connector] | None = None,
) -> DetectionRun:
    """Build the detection plan.

    ``baseline_view`` is the captured baseline, with ``table_name`` or as
    :func:`driftlens.plans.capture.run_capture` writes it.

    With ``connectors``, names are matched by each connector's
    ``identifier_case``, the setting its metadata was read with. Without, the
    original rule holds: ``snowflake_uat`` folds to upper case, every other
    connector to ``case`` (lower).

    ``live_columns`` may be :class:`driftlens.sources.live.LiveMetadata`, which
    brings the case rule that it was read under.

    ``freeze_live`` checkpoints the live snapshot (reliable checkpoint in
    ``spark.checkpoint.dir``): live metadata is read exactly once per run, so
    every rule sees the same state even if a source changes meanwhile, and a
    lost executor does not re-query the sources. The stored baseline, which the
    rules read twice (by column and by table), is frozen with it.
    """
    if connectors is not None:
        source_case = case_rules(connectors)
    entries = parse_registry(registry, check_type, lower_all=True)
    if isinstance(live_columns, LiveMetadata):
        current = live_columns.snapshot(entries)
    else:
        current = snapshot(live_columns, entries, case=case, source_case=source_case)
    if "table_name" not in baseline_view.columns:  # as run_capture writes it
        baseline_view = named(baseline_view, registry, check_type)
    old = stored(baseline_view, entries, match=match)
    if freeze_live:
        current, old = current.checkpoint(eager=True), old.checkpoint(eager=True)
    detected = detect(old, current, rule_specs(rules))
    return DetectionRun(entries, current, old, to_anomaly_rows(detected, run_ts))


def run_detection(spark: SparkSession, out_path: str, run_key: str | None = None, **kwargs) -> DetectionRun:
    """Plan and write. The partition of the run's date and key is replaced, so
    a rerun does not duplicate or leave rows; give runs over different entries
    different keys. The default key is the check type."""
    from driftlens.sinks import write_run

    run = plan_detection(**kwargs)
    found = write_run(run.anomalies, out_path, kwargs["run_ts"].date(), run_key or kwargs.get("check_type", "schema"))
    return replace(run, found=found)


def detect_from_connectors(
    spark: SparkSession, out_path: str, registry: DataFrame, connectors: Mapping[str, Connector], store: Store, rules: DataFrame, run_ts,
    check_type: str = "schema", run_key: str | None = None, match: str = "eq", **options
) -> DetectionRun:
    """Detection from the registered sources against the store's baseline: the
    sources are read and matched by each connector's case setting."""
    live = live_for_detection(spark, parse_registry(registry, check_type, lower_all=True), connectors, **options)
    return run_detection(
        spark, out_path, run_key, registry=registry, live_columns=live, baseline_view=store.read("baseline", BASELINE), rules=rules,
        run_ts=run_ts, match=match, check_type=check_type,
    )


def daily_reports(
    spark: SparkSession, anomalies_path: str, registry: DataFrame, rules: DataFrame, day, link: str
) -> dict[str, DataFrame]:
    """The seven reports of one day over the written anomaly table; the day
    range prunes the run-date partitions."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    import datetime as dt

    from driftlens.types import ANOMALY

    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    # the schema is given: a table of runs that found nothing has no rows to infer it from
    layout = T.StructType([*ANOMALY.fields, T.StructField("run_date", T.DateType()), T.StructField("run_key", T.StringType())])
    a = spark.read.schema(layout).parquet(anomalies_path).where(
        (F.col("run_date") >= F.lit(d)) & (F.col("run_date") <= F.lit(d))
    )
    return all_reports(a, registry, rules, d, link)
