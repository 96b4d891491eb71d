"""Registry, rules, baseline, state and anomalies in a metadata database.

Reads are tables of the database as DataFrames: the column names that the
database spells differently are mapped, timestamps stay without a time zone.

A write is idempotent. Spark writes the rows into a staging table of the run
(any number of connections, any number of attempts), and then one transaction
on one connection moves them: what the run has moved before is recognised by
its key in the table itself, so a run that stopped anywhere is run again.

* baseline: rows of entries that have none yet (``NOT EXISTS`` on
  ``config_id``, which holds all rows of an entry or none), together with the
  high-water mark, which only moves forward;
* anomalies: rows of a run time that has none yet.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlens.operators.quarantine import BASELINE_KEYS, ENTRY_KEYS, accepted, mark
from driftlens.operators.registry import due_entries
from driftlens.operators.state import advance_hwm, current_hwm
from driftlens.plans.capture import Live
from driftlens.plans.detection import plan_detection
from driftlens.session import ensure_checkpoint_dir
from driftlens.sources.connectors import Connector
from driftlens.sources.jdbc import append, read_table, sql_literal
from driftlens.sources.live import live_for_capture, live_for_detection
from driftlens.types import ANOMALY, BASELINE, REGISTRY, RULES, STATE

# The database's tables, and the columns it spells differently.
REGISTRY_TABLE, BASELINE_TABLE, STATE_TABLE = "master_configuration", "schema_configuration", "master_config_status"
RULES_TABLE, ANOMALY_TABLE = "anamoly_master", "schema_anamoly"
SPELT = {REGISTRY_TABLE: {"updated_at": "updatedAt"}}


@dataclass(frozen=True)
class MetadataDb:
    conn: Connector
    schema: str | None = None

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def staging(self, name: str, run_key: str) -> str:
        return self.table(f"{name}_{hashlib.sha256(run_key.encode()).hexdigest()[:12]}")

    def read(self, spark: SparkSession, name: str, layout: T.StructType) -> DataFrame:
        """A table in the engine's layout; filters on it reach the database."""
        rows = read_table(spark, self._ntz(), self.table(name))
        return in_layout(rows, layout, SPELT.get(name, {}))

    def _ntz(self) -> Connector:
        options = {**self.conn.options, "preferTimestampNTZ": "true"}
        return Connector(self.conn.name, self.conn.kind, self.conn.url, self.conn.user, self.conn.password, self.conn.identifier_case, options)

    def registry(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, REGISTRY_TABLE, REGISTRY)

    def rules(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, RULES_TABLE, RULES)

    def baseline(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, BASELINE_TABLE, BASELINE)

    def state(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, STATE_TABLE, STATE)


def in_layout(rows: DataFrame, layout: T.StructType, spelt: Mapping[str, str]) -> DataFrame:
    """Columns of a layout, whatever case the database gives their names."""
    there = {c.lower(): c for c in rows.columns}
    named = [F.col(f"`{there[spelt.get(f.name, f.name).lower()]}`").cast(f.dataType).alias(f.name) for f in layout.fields]
    return rows.select(*named)


def _names(layout: T.StructType) -> str:
    return ", ".join(f.name for f in layout.fields)


def move_baseline(db: MetadataDb, staging: str) -> str:
    """Staged rows of entries that have no baseline yet."""
    target = db.table(BASELINE_TABLE)
    return (
        f"INSERT INTO {target} ({_names(BASELINE)}) SELECT {_names(BASELINE)} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.config_id = s.config_id)"
    )


def move_mark(db: MetadataDb, check_type: str, mark_: dt.datetime) -> str:
    """The high-water mark forward, never back."""
    value = f"TIMESTAMP {sql_literal(mark_.isoformat(sep=' '))}"
    return f"UPDATE {db.table(STATE_TABLE)} SET updated_at = {value} WHERE check_type = {sql_literal(check_type)} AND (updated_at IS NULL OR updated_at < {value})"


def move_anomalies(db: MetadataDb, staging: str) -> str:
    """Staged rows of run times that have none yet: a run's rows share one time
    and are moved by one statement, so the table holds all of them or none."""
    target = db.table(ANOMALY_TABLE)
    return (
        f"INSERT INTO {target} ({_names(ANOMALY)}) SELECT {_names(ANOMALY)} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.updated_at = s.updated_at)"
    )


def execute(spark: SparkSession, conn: Connector, statements: Sequence[str]) -> None:
    """Statements in one transaction on one connection of the driver."""
    jvm, options = spark._jvm, conn.jdbc_options()
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    properties = jvm.java.util.Properties()
    for k, v in options.items():
        if k not in ("url", "driver"):
            properties.setProperty(k, str(v))
    link = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        link.setAutoCommit(False)
        for sql in statements:
            statement = link.createStatement()
            statement.executeUpdate(sql)
            statement.close()
        link.commit()
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()


def stage(rows: DataFrame, db: MetadataDb, name: str, run_key: str, writer=append) -> str:
    """Rows in the run's staging table, replacing what an earlier attempt left."""
    staging = db.staging(name, run_key)
    writer(rows, db.conn, staging, mode="overwrite")
    return staging


def capture_to_database(
    spark: SparkSession, db: MetadataDb, connectors: Mapping[str, Connector], run_key: str, check_type: str = "schema", live: Live | None = None, **options
) -> dict[str, int]:
    """Capture with registry, baseline and state in the database. Rows without
    their keys are left out and counted. Returns the run's counts."""
    ensure_checkpoint_dir(spark)
    registry = db.registry(spark).where(F.col("check_type") == check_type).checkpoint()
    state, baseline = db.state(spark), db.baseline(spark).where("config_id is not null")
    marked = mark(due_entries(registry, baseline, state, check_type, hwm=current_hwm(state, check_type)), ENTRY_KEYS).checkpoint()
    due = accepted(marked)
    n_due = due.count()
    counts = {"due": n_due, "captured": 0, "rejected": marked.count() - n_due}
    statements = []
    if n_due:
        found = live_for_capture(spark, due, connectors, **options) if live is None else live(due) if callable(live) else live
        rows = mark(found.capture(due).select(*[f.name for f in BASELINE.fields]), BASELINE_KEYS).checkpoint()
        good = accepted(rows)
        counts["captured"] = good.count()
        counts["rejected"] += rows.count() - counts["captured"]
        if counts["captured"]:
            statements.append(move_baseline(db, stage(good, db, BASELINE_TABLE, run_key)))
    new = current_hwm(advance_hwm(state, registry, check_type), check_type)
    if isinstance(new, dt.datetime):
        statements.append(move_mark(db, check_type, new))
    if statements:
        execute(spark, db.conn, statements)
    return counts


def detect_to_database(
    spark: SparkSession, db: MetadataDb, connectors: Mapping[str, Connector], run_ts: dt.datetime, run_key: str, check_type: str = "schema", live=None, **options
) -> int:
    """Detection with everything in the database; returns the anomalies found.
    ``run_ts`` is the run's time: a rerun with it moves nothing twice."""
    from driftlens.operators.registry import parse_registry

    registry = db.registry(spark)
    live = live or live_for_detection(spark, parse_registry(registry, check_type, lower_all=True), connectors, **options)
    run = plan_detection(registry=registry, live_columns=live, baseline_view=db.baseline(spark), rules=db.rules(spark), run_ts=run_ts, check_type=check_type)
    rows = run.anomalies.checkpoint()
    found = rows.count()
    if found:
        execute(spark, db.conn, [move_anomalies(db, stage(rows, db, ANOMALY_TABLE, run_key))])
    return found
