"""Incremental baseline capture (job 1).

read HWM -> due entries -> capture their live columns -> append baseline ->
advance HWM. :func:`incremental_capture` is that plan as DataFrames;
:func:`run_capture` is the scheduled job over a versioned store: each step is
written once and read back, counts are observed while writing, and baseline,
state, pending and rejected rows are published together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.operators.quarantine import BASELINE_KEYS, ENTRY_KEYS, REJECTED, accepted, mark
from driftlens.operators.registry import due_entries, is_newer, parse_registry
from driftlens.operators.snapshot import capture, unmatched_entries
from driftlens.operators.state import NO_STATE, advance_hwm, current_hwm
from driftlens.sinks.store import Commit, Store
from driftlens.sources.connectors import Connector
from driftlens.sources.live import LiveMetadata, live_for_capture
from driftlens.types import BASELINE, PENDING, STATE


@dataclass
class CaptureRun:
    due: DataFrame  # entries selected by this run
    captured: DataFrame  # new baseline rows (schema_configuration layout)
    unmatched: DataFrame  # due entries with no live table (never retried by the HWM)
    state_after: DataFrame  # master_config_status after the run
    baseline_after: DataFrame  # old baseline rows plus the captured rows
    hwm: object  # the HWM the run started from


def incremental_capture(
    registry: DataFrame,
    columns: DataFrame,
    baseline: DataFrame,
    state: DataFrame,
    check_type: str = "schema",
    case: str | Mapping[str, str] = "exact",
    source_case: Mapping[str, str] | None = None,
) -> CaptureRun:
    """The capture run as DataFrames; nothing is written here."""
    hwm = current_hwm(state, check_type)
    due = due_entries(registry, baseline, state, check_type, hwm=hwm)
    captured = capture(due, columns, case=case, source_case=source_case)
    names = [f.name for f in BASELINE.fields]
    return CaptureRun(
        due=due,
        captured=captured.select(*names),
        unmatched=unmatched_entries(due, columns, case=case, source_case=source_case),
        state_after=advance_hwm(state, registry, check_type),
        baseline_after=baseline.select(*names).unionByName(captured.select(*names)),
        hwm=None if hwm is NO_STATE else hwm,
    )


@dataclass(frozen=True)
class CaptureReport:
    """What a run did. ``due``, ``captured``, ``unmatched`` and ``rejected`` are
    counts; a run key that was published before reports that run again."""

    commit: Commit
    counts: Mapping[str, int] = field(default_factory=dict)
    replayed: bool = False


Live = LiveMetadata | Callable[[DataFrame], LiveMetadata]


def run_capture(registry: DataFrame, live: Live, store: Store, run_key: str, check_type: str = "schema") -> CaptureReport:
    """One scheduled capture into the store's tables ``baseline``, ``state``,
    ``pending`` and ``rejected``.

    Due are entries newer than the high-water mark and entries that were due
    before but had no live table (``pending``), if they are not captured yet.
    Entries and captured rows without their keys are set aside in ``rejected``
    with the reason and stop nothing. Due entries without a live table are
    pending for the next run. ``live`` may be a function of the due entries, so
    that only their tables are read; it is read once.

    Nothing is visible before the commit at the end: a run that stops anywhere
    is run again with the same or another key and loses and doubles nothing. An
    empty run writes no baseline file.
    """
    spark = registry.sparkSession
    run = store.begin(run_key)
    if run.done is not None:
        return CaptureReport(run.base, run.done, replayed=True)
    baseline, state, pending = (run.read(n, s) for n, s in (("baseline", BASELINE), ("state", STATE), ("pending", PENDING)))

    # the registry as this run saw it: the due entries and the new mark come from it
    frozen, _, _ = run.write("registry", registry.where(F.col("check_type") == check_type))
    retry = pending.where(F.col("check_type") == check_type).select("config_id").distinct().withColumn("_retry", F.lit(True))
    newer = is_newer(current_hwm(state, check_type))
    wanted = parse_registry(frozen, check_type, lower_all=False).join(retry, "config_id", "left").where(newer | F.col("_retry")).drop("_retry")
    captured_ids = baseline.select("config_id").where("config_id is not null").distinct()
    marked = mark(wanted.join(captured_ids, "config_id", "left_anti"), ENTRY_KEYS)
    entries, entries_folder, seen = run.write("due", marked, by=REJECTED, rejected=F.count_if(REJECTED))
    counts = {"due": seen["rows"] - seen["rejected"], "captured": 0, "unmatched": 0, "rejected": seen["rejected"]}
    if seen["rejected"]:
        run.append("rejected", f"{entries_folder}/{REJECTED}=true")
    run.replace("pending", None)

    if counts["due"]:
        due = accepted(entries)
        found = live(due) if callable(live) else live
        rows = mark(found.capture(due).select(*[f.name for f in BASELINE.fields]), BASELINE_KEYS)
        written, folder, seen = run.write("baseline", rows, by=REJECTED, rejected=F.count_if(REJECTED))
        counts["captured"] = seen["rows"] - seen["rejected"]
        counts["rejected"] += seen["rejected"]
        if counts["captured"]:
            run.append("baseline", f"{folder}/{REJECTED}=false")
        if seen["rejected"]:
            run.append("rejected", f"{folder}/{REJECTED}=true")
        empty = folder if not seen["rows"] else None
        left = due.join(written.select("config_id").distinct(), "config_id", "left_anti")
        _, folder, seen = run.write("pending", left.select("config_id", "table_name", F.lit(check_type).alias("check_type"), F.lit(run_key).alias("run_key")))
        counts["unmatched"] = seen["rows"]
        if seen["rows"]:
            run.replace("pending", folder)
        if empty:
            run.discard(empty)

    _, folder, _ = run.write("state", advance_hwm(state, frozen, check_type))
    run.replace("state", folder)
    return CaptureReport(run.publish(counts), counts)


def capture_from_connectors(
    spark: SparkSession, registry: DataFrame, connectors: Mapping[str, Connector], store: Store, run_key: str, check_type: str = "schema", **options
) -> CaptureReport:
    """Capture from the registered sources: only the due entries' metadata is
    read, and matched by the rule it was read under."""
    return run_capture(registry, lambda due: live_for_capture(spark, due, connectors, **options), store, run_key, check_type)
