"""Sources and sinks: JDBC over in-process Derby, idempotent anomaly writes,
lakehouse snapshot, end-to-end detection."""

import datetime as dt
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from driftlens.operators import parse_registry
from driftlens.plans.capture import run_capture
from driftlens.plans.detection import daily_reports, run_detection
from driftlens.sinks.store import Store
from driftlens.sources import fixtures as fx
from driftlens.sources.connectors import Connector, case_rules
from driftlens.sources.information_schema import read_live_columns
from driftlens.sources.jdbc import append, read_query, read_table
from driftlens.sources.lakehouse import snapshot_from_tables
from driftlens.sources.live import LiveMetadata
from driftlens.types import BASELINE

from conftest import SF_SMALL
from helpers import bag


@pytest.fixture()
def derby():
    return Connector("metadb", "derby", url=f"jdbc:derby:memory:dl{uuid.uuid4().hex[:8]};create=true")


def test_jdbc_append_and_query_roundtrip(spark, derby):
    rows = fx.baseline(spark, SF_SMALL).select(*[f.name for f in BASELINE.fields]).where("config_id < 20")
    append(rows, derby, "SCHEMA_CONFIGURATION")
    back = read_table(spark, derby, "SCHEMA_CONFIGURATION")
    back = back.toDF(*[c.lower() for c in back.columns])
    assert bag(back) == bag(rows)
    q = read_query(spark, derby, 'SELECT COUNT(DISTINCT "config_id") AS N FROM SCHEMA_CONFIGURATION')
    assert q.first()[0] == rows.select("config_id").distinct().count()


def test_information_schema_read_per_catalog(spark, derby):
    # a tiny information_schema-shaped table in Derby stands in for a source
    live = fx.live_columns(spark, SF_SMALL).where("table_name in ('T_1', 'T_2', 'T_3')")
    # unquoted identifiers in Derby are upper case, as in an information_schema
    types = ", ".join(f"{c.upper()} VARCHAR(128)" for c in live.columns if c != "character_maximum_length")
    append(live.toDF(*[c.upper() for c in live.columns]), derby, "INFO_COLS", create_column_types=types)
    reg = fx.registry(spark, SF_SMALL).where("config_id in (1, 2, 3)")
    entries = parse_registry(reg)
    conns = {"redshift_dev": Connector("redshift_dev", "derby", url=derby.url, identifier_case="upper")}
    import driftlens.sources.information_schema as isch

    orig = isch.catalog_relation
    isch.catalog_relation = lambda catalog, case, qualified=True: "(SELECT * FROM INFO_COLS) info_cols"
    try:
        got = read_live_columns(spark, entries, conns)
    finally:
        isch.catalog_relation = orig
    assert got.count() == live.count()
    assert set(r["source"] for r in got.collect()) == {"redshift_dev"}
    assert case_rules(conns) == {"redshift_dev": "upper"}


def test_unknown_connector_kind_is_an_error():
    with pytest.raises(ValueError):
        Connector("x", "mysql-ish")


def test_lakehouse_snapshot_matches_duckdb_information_schema(spark):
    names = ["lineitem", "orders", "events", "documents", "embeddings"]
    snap = snapshot_from_tables(spark, {n: fx.table(spark, SF_SMALL, n) for n in names})
    con = duckdb.connect()
    for n in names:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF_SMALL}/{n}.parquet')")
    duck = con.execute(
        "SELECT table_name, column_name, data_type, is_nullable, ordinal_position FROM information_schema.columns"
    ).fetchall()
    ours = [(r["table_name"], r["column_name"], r["data_type"], r["is_nullable"], int(r["ordinal_position"])) for r in snap.collect()]
    assert sorted(ours) == sorted(duck)


def test_detection_job_end_to_end(spark, scratch):
    reg = fx.registry(spark, SF_SMALL)
    live = fx.live_columns(spark, SF_SMALL)
    base = fx.baseline(spark, SF_SMALL)
    out = f"{scratch}/schema_anamoly"
    kwargs = dict(
        registry=reg, live_columns=live, baseline_view=base, rules=fx.rules(spark),
        run_ts=dt.datetime(2023, 4, 19, 7, 0), case="upper",
    )
    run = run_detection(spark, out, **kwargs)
    n = spark.read.parquet(out).count()
    assert n == run.anomalies.count() > 0
    run_detection(spark, out, **kwargs)
    assert spark.read.parquet(out).count() == n
    reports = daily_reports(spark, out, reg, fx.rules(spark), "2023-04-19", "https://example.com/review")
    assert len(reports) == 7
    total = sum(r.count() for r in reports.values())
    # every anomaly of the day appears in exactly one report, once per registry row of its entry
    assert total == spark.read.parquet(out).join(reg.select("config_id"), "config_id").count()


def test_clean_rerun_and_other_runs_of_a_day(spark, scratch):
    reg, base = fx.registry(spark, SF_SMALL), fx.baseline(spark, SF_SMALL)
    out = f"{scratch}/schema_anamoly"
    kwargs = dict(registry=reg, live_columns=fx.live_columns(spark, SF_SMALL), rules=fx.rules(spark), run_ts=dt.datetime(2023, 4, 19, 7, 0), case="upper")
    # a first run that finds nothing still gives seven reports
    run_detection(spark, out, baseline_view=base.where("false"), **{**kwargs, "live_columns": kwargs["live_columns"].where("false")})
    assert [r.count() for r in daily_reports(spark, out, reg, fx.rules(spark), "2023-04-19", "l").values()] == [0] * 7
    run_detection(spark, out, baseline_view=base, **kwargs)
    found = spark.read.parquet(out).count()
    # another run of the day adds to it, and one that finds nothing clears its own rows only
    run_detection(spark, out, run_key="second", baseline_view=base, **kwargs)
    assert spark.read.parquet(out).count() == 2 * found > 0
    run_detection(spark, out, baseline_view=base.where("false"), **{**kwargs, "live_columns": kwargs["live_columns"].where("false")})
    assert spark.read.parquet(out).count() == found


def test_capture_output_feeds_detection_and_reports(spark, scratch):
    reg, live = fx.registry(spark, SF_SMALL).where("config_id < 200"), fx.live_columns(spark, SF_SMALL)
    store, out = Store(spark, f"{scratch}/store"), f"{scratch}/anomalies"
    run_capture(reg, LiveMetadata(live, {"catalog": "exact", "schema": "fold", "table": "exact"}), store, "first")
    base = store.read("baseline", BASELINE)
    conns = {"redshift_dev": Connector("redshift_dev", "redshift", identifier_case="upper")}
    drifted = live.where("column_name <> 'C2'").withColumn("data_type", F.when(F.col("column_name") == "C1", "TEXT").otherwise(F.col("data_type")))
    kwargs = dict(registry=reg, baseline_view=base, rules=fx.rules(spark), run_ts=dt.datetime(2023, 4, 19, 7, 0), connectors=conns)
    run = run_detection(spark, out, live_columns=drifted, **kwargs)
    assert run.found == spark.read.parquet(out).count()
    found = {r["anamoly_id"]: r["n"] for r in spark.read.parquet(out).groupBy("anamoly_id").agg(F.count("*").alias("n")).collect()}
    assert found[0] >= base.where("column_name = 'c2'").count() > 0  # dropped columns
    assert found[2] > found[0] and 1 not in found
    reports = daily_reports(spark, out, reg, fx.rules(spark), "2023-04-19", "link")
    assert reports["Missing Attributes"].count() == found[0]
