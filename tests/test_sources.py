"""Metadata reads: what is registered reaches the source's query, ranges cover
every row once in the source's own order, and lakehouse tables are found.

DuckDB, or a Spark view, stands in for the source database."""

import datetime as dt
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import driftlens.sources.information_schema as isch
from driftlens.operators import detect, parse_registry
from driftlens.plans.capture import capture_from_connectors
from driftlens.plans.detection import detect_from_connectors
from driftlens.sinks.store import Store
from driftlens.sources import fixtures as fx
from driftlens.sources.connectors import Connector
from driftlens.sources.information_schema import list_predicates, range_predicates, read_live_columns, registered_schemas, split_query
from driftlens.sources.lakehouse import lakehouse_columns, schema_rows
from driftlens.sources.live import live_for_capture, live_for_detection
from driftlens.types import BASELINE, LIVE_COLUMNS, REGISTRY

from conftest import SF_SMALL
from helpers import bag


def source(collation, n=5000):
    """A database with n tables of mixed-case names in one schema."""
    con = duckdb.connect()
    con.execute("CREATE SCHEMA information_schema2")
    con.execute(f"CREATE TABLE names (table_schema VARCHAR, table_name VARCHAR {collation})")
    con.execute(f"INSERT INTO names SELECT 'PUBLIC', CASE WHEN i % 3 = 0 THEN upper('t_' || i) WHEN i % 7 = 0 THEN 'é' || i ELSE 't_' || i END FROM range({n}) t(i)")
    con.execute("INSERT INTO names SELECT 'OTHER', 't_' || i FROM range(50) t(i)")
    return con


@pytest.mark.parametrize("collation", ["", "COLLATE NOCASE", "COLLATE NOACCENT.NOCASE"])
@pytest.mark.parametrize("case", ["upper", "fold"])
def test_ranges_cover_each_row_once_in_the_sources_own_order(collation, case):
    con = source(collation)
    query = split_query("cat", "public", case, per_partition=100).replace('"cat".information_schema.tables', "names")
    points = [r[0] for r in sorted(con.execute(query).fetchall(), key=lambda r: r[1])]
    preds = range_predicates("public", points, case)
    assert len(points) == 50 and len(preds) == 51
    sizes, got = [], Counter()
    for p in preds:
        rows = con.execute(f"SELECT table_name FROM names WHERE {p}").fetchall()
        sizes.append(len(rows))
        got.update(r[0] for r in rows)
    assert got == Counter(r[0] for r in con.execute("SELECT table_name FROM names WHERE table_schema = 'PUBLIC'").fetchall())
    assert max(sizes) <= 200  # even ranges, but for names that the collation holds equal


def test_predicates_grow_linearly():
    one, two = (sum(map(len, range_predicates("s", [f"t_{i:06d}" for i in range(n)], "exact"))) for n in (1000, 2000))
    assert two < 2.01 * one
    assert range_predicates("s", [], "exact") == ["table_schema = 's'"]


def test_ten_of_a_million_tables_read_ten():
    con = source("", n=1_000_000)
    preds = list_predicates("public", [f"t_{i * 99_999}" for i in range(10)], "upper", per_partition=4)
    assert len(preds) == 3
    assert sum(con.execute(f"SELECT count(*) FROM names WHERE {p}").fetchone()[0] for p in preds) == 10


def test_registry_text_is_quoted():
    assert isch.catalog_relation('a".b; drop', "exact").endswith('FROM "a"".b; drop".information_schema.columns) info_cols')
    assert isch.information_schema("columns", "Sales", "upper") == '"SALES".information_schema.columns'
    assert list_predicates("x'y", ["o'k"], "exact") == ["table_schema = 'x''y' AND table_name IN ('o''k')"]


def test_names_of_large_schemas_stay_on_the_executors(spark):
    entries = parse_registry(fx.registry(spark, SF_SMALL))
    n = entries.select("tbl_name").distinct().count()
    assert registered_schemas(entries, list_tables=n - 1) == {("redshift_dev", "tpch"): {"public": None}}
    assert len(registered_schemas(entries, list_tables=n)[("redshift_dev", "tpch")]["public"]) == n


@pytest.fixture()
def database(spark, monkeypatch):
    """A Spark view in the place of a JDBC database's information_schema."""
    asked = []

    def partitioned(spark, conn, relation, predicates):
        asked.extend(predicates)
        parts = [spark.table("source_columns").where(p) for p in predicates]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def query(spark, conn, sql):
        asked.append(sql)
        return spark.sql(sql.replace(isch.information_schema("tables", "Sales", conn.identifier_case), "(SELECT DISTINCT table_schema, table_name FROM source_columns)"))

    monkeypatch.setattr(isch, "read_partitioned", partitioned)
    monkeypatch.setattr(isch, "read_query", query)
    return asked


def registry(spark, names):
    rows = [(i, n, "schema", "u", True, False, dt.datetime(2024, 1, 1)) for i, n in enumerate(names, 1)]
    return spark.createDataFrame(rows, REGISTRY)


def test_mixed_case_names_are_read_and_matched_by_one_rule(spark, database, scratch):
    rows = [(c, s, t, col, "INT", "YES", None, "1") for c, s, t in (("Sales", "Eu", "Orders"), ("SALES", "EU", "ORDERS"), ("sales", "eu", "orders")) for col in ("A", "B")]
    spark.createDataFrame(rows, LIVE_COLUMNS).createOrReplaceTempView("source_columns")
    reg = registry(spark, ["Crm:Sales.Eu.Orders"])
    conns = {"crm": Connector("crm", "redshift", identifier_case="upper")}
    exact = live_for_capture(spark, parse_registry(reg, lower_all=False), conns)
    assert {r.table_name for r in exact.columns.collect()} == {"Orders"}
    assert exact.capture(parse_registry(reg, lower_all=False)).count() == 2
    folded = live_for_detection(spark, parse_registry(reg), conns)
    assert {r.table_name for r in folded.columns.collect()} == {"ORDERS"}
    assert folded.snapshot(parse_registry(reg)).count() == 2
    # the jobs need no flag either
    store = Store(spark, f"{scratch}/store")
    out = capture_from_connectors(spark, reg, conns, store, "a")
    assert out.counts == {"due": 1, "captured": 2, "unmatched": 0, "rejected": 0}
    spark.createDataFrame([r for r in rows if r[3] == "A"], LIVE_COLUMNS).createOrReplaceTempView("source_columns")
    run = detect_from_connectors(spark, f"{scratch}/found", reg, conns, store, fx.rules(spark), dt.datetime(2024, 1, 2))
    assert [(r.column_name, r.anamoly_id) for r in run.anomalies.collect() if r.anamoly_id == 0] == [("b", 0)]


def test_large_schema_is_read_in_the_sources_ranges(spark, database):
    rows = [("Sales", "Eu", f"{'T' if i % 2 else 't'}{i}", c, "INT", "YES", None, "1") for i in range(60) for c in ("a", "b")]
    spark.createDataFrame(rows, LIVE_COLUMNS).createOrReplaceTempView("source_columns")
    entries = parse_registry(registry(spark, [f"crm:Sales.Eu.{'T' if i % 2 else 't'}{i}" for i in range(60)]), lower_all=False)
    conns = {"crm": Connector("crm", "redshift", identifier_case="exact")}
    got = read_live_columns(spark, entries, conns, list_tables=10, tables_per_partition=7)
    assert bag(got.drop("source")) == bag(spark.table("source_columns"))
    assert len([p for p in database if "<=" in p or ">" in p]) == 9  # 60 // 7 points, one range more
    assert bag(read_live_columns(spark, entries, conns).drop("source")) == bag(spark.table("source_columns"))


def lake(spark, root, drift=False):
    """Two schemas of Parquet folders; Spark writes lengths beside the type."""
    sized = T.StructField("name", T.StringType(), True, {"__CHAR_VARCHAR_TYPE_STRING": f"varchar({40 if drift else 20})"})
    spark.createDataFrame([("x", 1)], T.StructType([sized, T.StructField("n", T.IntegerType())])).write.mode("overwrite").parquet(f"{root}/lake/s1/people")
    cols = ["a"] if drift else ["a", "b"]
    spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"{c} long" for c in cols)).withColumn("day", F.lit(3)).write.mode("overwrite").partitionBy("day").parquet(f"{root}/lake/s2/facts")


def test_lakehouse_drift_in_two_schemas_of_folders(spark, scratch):
    conns = {"lake": Connector("lake", "deltalake", options={"location": f"file:{scratch}/{{catalog}}/{{schema}}/{{table}}"})}
    reg, store = registry(spark, ["lake:lake.s1.people", "lake:lake.s2.facts"]), Store(spark, f"{scratch}/store")
    lake(spark, scratch)
    assert capture_from_connectors(spark, reg, conns, store, "a").counts["captured"] == 5
    assert {(r.column_name, r.data_type, r.character_maximum_length) for r in store.read("baseline", BASELINE).collect()} == {
        ("name", "varchar", 20), ("n", "integer", 0), ("a", "bigint", 0), ("b", "bigint", 0), ("day", "integer", 0),
    }
    lake(spark, scratch, drift=True)
    run = detect_from_connectors(spark, f"{scratch}/found", reg, conns, store, fx.rules(spark), dt.datetime(2024, 1, 2))
    found = {(r.column_name, r.anamoly_id): (r.character_maximum_length_old, r.character_maximum_length) for r in run.anomalies.collect()}
    assert found[("name", 3)] == (20, 40) and ("b", 0) in found and ("day", 4) in found
    assert {k[0] for k in found} == {"name", "b", "day"} and run.found == run.anomalies.count()


def test_lakehouse_table_that_is_not_there(spark, scratch):
    conns = {"lake": Connector("lake", "deltalake", options={"location": f"file:{scratch}/{{catalog}}/{{schema}}/{{table}}"})}
    lake(spark, scratch)
    entries = parse_registry(registry(spark, ["lake:lake.s1.people", "lake:lake.s1.gone", "lake:lake.s9.gone"]))
    with pytest.raises(ValueError, match="2 registered tables not found.*lake.s1.gone"):
        read_live_columns(spark, entries, conns)
    got = read_live_columns(spark, entries, conns, missing="drop")
    assert {r.table_name for r in got.collect()} == {"people"}
    old = spark.createDataFrame([(2, "lake:lake.s1.gone", "a", "int", "yes", 0, 1)], "config_id long, table_name string, column_name string, data_type string, is_nullable string, character_maximum_length int, ordinal_position int")
    assert (2, 6) in {(r.config_id, r.anamoly_id) for r in detect(old, live_for_detection(spark, entries, conns, missing="drop").snapshot(entries), fx.rules(spark)).collect()}


def test_lakehouse_tables_of_a_spark_catalog(spark, scratch):
    spark.sql(f"CREATE DATABASE s1 LOCATION '{scratch}/s1'")
    spark.sql(f"CREATE DATABASE s2 LOCATION '{scratch}/s2'")
    try:
        spark.sql(f"CREATE TABLE s1.t (a VARCHAR(20), b INT, c CHAR(3), p STRING) USING parquet PARTITIONED BY (p) LOCATION '{scratch}/s1t'")
        spark.sql(f"CREATE TABLE s2.t (a ARRAY<INT>) USING json LOCATION '{scratch}/s2t'")
        spark.sql("CREATE VIEW s2.v AS SELECT 1 AS one")
        conn = Connector("hive", "deltalake")
        entries = parse_registry(registry(spark, ["hive:spark_catalog.s1.T", "hive:spark_catalog.s2.t", "hive:spark_catalog.s2.v", "hive:spark_catalog.s1.T"]))
        got = read_live_columns(spark, entries, {"hive": conn})
        assert sorted((r.table_schema, r.table_name, r.column_name, r.data_type, r.character_maximum_length, r.ordinal_position) for r in got.collect()) == [
            ("s1", "t", "a", "VARCHAR", 20, "1"), ("s1", "t", "b", "INTEGER", None, "2"), ("s1", "t", "c", "CHAR", 3, "3"), ("s1", "t", "p", "VARCHAR", None, "4"),
            ("s2", "t", "a", "INTEGER[]", None, "1"), ("s2", "v", "one", "INTEGER", None, "1"),
        ]
        gone = parse_registry(registry(spark, ["hive:spark_catalog.s1.x", "hive:spark_catalog.s3.t"]))
        with pytest.raises(ValueError, match="2 registered tables not found"):
            read_live_columns(spark, gone, {"hive": conn})
    finally:
        spark.sql("DROP DATABASE s1 CASCADE")
        spark.sql("DROP DATABASE s2 CASCADE")


def test_lakehouse_information_schema_is_read_by_sql(spark, monkeypatch):
    import driftlens.sources.lakehouse as lh

    rows = schema_rows("cat", "s1", "t", T.StructType([T.StructField("a", T.StringType())])) + [("cat", "s1", "other", "z", "INT", "NO", None, "1")]
    info = spark.createDataFrame(rows, LIVE_COLUMNS)
    monkeypatch.setattr(lh, "_has", lambda spark, name: name == "`cat`.information_schema.columns")
    monkeypatch.setattr(type(spark), "table", lambda self, name: info)
    tables = spark.createDataFrame([("Cat", "S1", "T"), ("cat", "s1", "gone")], "catalog_name string, schema_name string, tbl_name string")
    got = lakehouse_columns(spark, tables, Connector("lake", "deltalake"), missing="drop")
    assert [(r.table_schema, r.table_name, r.column_name) for r in got.collect()] == [("s1", "t", "a")]
    with pytest.raises(ValueError, match="cat.s1.gone"):
        lakehouse_columns(spark, tables, Connector("lake", "deltalake"))
