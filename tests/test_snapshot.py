"""Live snapshot and capture: identifier case rules (F4, B15), DISTINCT vs
duplicates, qualified names, NULL length and ordinal casts."""

import datetime as dt

from pyspark.sql import functions as F

from driftlens.operators import capture, parse_registry, snapshot
from driftlens.operators.snapshot import UPPER_CASE_CONNECTORS
from driftlens.types import LIVE_COLUMNS, REGISTRY

D = dt.datetime(2023, 1, 1)


def registry(spark, names):
    return spark.createDataFrame(
        [(i, n, "schema", "user@example.com", True, False, D) for i, n in enumerate(names, start=1)], REGISTRY
    )


def live(spark, rows):
    return spark.createDataFrame(rows, LIVE_COLUMNS)


def test_connector_case_rule_upper_for_snowflake_uat_lower_otherwise(spark):
    reg = registry(spark, ["snowflake_uat:Db.Sch.Orders", "pg_dev:Db.Sch.Orders"])
    cols = live(
        spark,
        [
            ("DB", "SCH", "ORDERS", "ID", "NUMBER", "NO", None, "1"),
            ("db", "sch", "orders", "id", "integer", "NO", None, "1"),
        ],
    )
    got = snapshot(cols, parse_registry(reg), case="lower", source_case=UPPER_CASE_CONNECTORS).collect()
    by_id = {r["config_id"]: (r["table_name"], r["data_type"], r["character_maximum_length"], r["ordinal_position"]) for r in got}
    # both entries see the rows their connector's case rule selects; names and types are lowered
    assert by_id == {1: ("snowflake_uat:db.sch.orders", "number", 0, 1), 2: ("pg_dev:db.sch.orders", "integer", 0, 1)}


def test_snapshot_is_distinct_capture_keeps_duplicates(spark):
    reg = registry(spark, ["pg:db.s.t"])
    row = ("db", "s", "t", "A", "TEXT", "YES", 5, "2")
    cols = live(spark, [row, row])
    assert snapshot(cols, parse_registry(reg)).count() == 1
    entries = parse_registry(reg, lower_all=False)
    assert capture(entries, cols).count() == 2


def test_capture_compares_exactly_detection_folds(spark):
    reg = registry(spark, ["pg:DB.S.T"])
    cols = live(spark, [("db", "s", "t", "a", "text", "YES", None, "1")])
    assert capture(parse_registry(reg, lower_all=False), cols).count() == 0  # exact: 'DB' != 'db'
    assert capture(parse_registry(reg, lower_all=False), cols, case="fold").count() == 1
    assert snapshot(cols, parse_registry(reg)).count() == 1  # detection lowers the registry parts


def test_live_rows_carry_their_connector(spark):
    reg = registry(spark, ["a:db.s.t", "b:db.s.t"])
    cols = live(spark, [("db", "s", "t", "c", "int", "NO", None, "1")]).withColumn("source", F.lit("a"))
    got = [r["config_id"] for r in snapshot(cols, parse_registry(reg)).collect()]
    assert got == [1]  # a source's information_schema only answers for its own entries
