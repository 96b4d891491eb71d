"""Reports: order, multiplicity of identical rows (a dropped table gives one
alike row per baseline column), and no hot group in one sort partition."""

import datetime as dt

from driftlens.operators import report
from driftlens.sources.fixtures import RULE_ROWS
from driftlens.types import ANOMALY, RULES

DAY = dt.datetime(2023, 4, 19, 7)


def _anomaly(cid, col, aid, when=DAY, dtype=None, dtype_old=None):
    return (cid, col, dtype, dtype_old, None, None, None, None, None, None, aid, when)


def _registry(spark, ids):
    return spark.createDataFrame(
        [(i, f"src:c.s.t{i}", "schema", "u", True, False, DAY) for i in ids],
        "config_id long, table_name string, check_type string, created_by string, is_active boolean, is_deleted boolean, updated_at timestamp_ntz",
    )


def test_missing_data_source_keeps_every_alike_row_in_order(spark):
    # table 7 dropped with 5000 columns (one alike row each), table 3 with 2,
    # table 9 with 1; one row of table 3 from another day is excluded
    rows = [_anomaly(7, None, 6)] * 5000 + [_anomaly(3, None, 6)] * 2 + [_anomaly(9, None, 6)]
    rows += [_anomaly(3, None, 6, when=DAY - dt.timedelta(days=1))]
    a = spark.createDataFrame(rows, ANOMALY).repartition(8)
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    got = report(a, _registry(spark, [3, 7, 9]), rules, "missing_data_source", "2023-04-19", "L")
    out = [tuple(r) for r in got.collect()]
    assert got.columns == ["Data_Source", "validation"]
    assert out == [("src:c.s.t3", "L")] * 2 + [("src:c.s.t7", "L")] * 5000 + [("src:c.s.t9", "L")]
    # alike rows are counted before the sort's range exchange
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Sort [") < plan.index("HashAggregate"), plan


def test_value_report_order_and_duplicates(spark):
    rows = [
        _anomaly(2, "b", 2, dtype="int", dtype_old="text"),
        _anomaly(2, "a", 2, dtype="int", dtype_old="text"),
        _anomaly(1, "z", 2, dtype="x", dtype_old="y"),
        _anomaly(1, "z", 2, dtype="x", dtype_old="y"),
        _anomaly(1, "c", 3),
    ]
    a = spark.createDataFrame(rows, ANOMALY)
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    got = report(a, _registry(spark, [1, 2]), rules, "datatype_changes", dt.date(2023, 4, 19), "L")
    assert got.columns == ["Data_Source", "Attributes", "Previous", "Current", "validation"]
    assert [tuple(r) for r in got.collect()] == [
        ("src:c.s.t1", "z", "y", "x", "L"),
        ("src:c.s.t1", "z", "y", "x", "L"),
        ("src:c.s.t2", "a", "text", "int", "L"),
        ("src:c.s.t2", "b", "text", "int", "L"),
    ]


def test_dropped_columns_under_any_rule_name_and_all_ids_of_a_name(spark):
    from driftlens.operators.detect import rule_specs

    rules = spark.createDataFrame([("column_gone", None, 90), ("datatype", ["data_type"], 1), ("datatype", ["data_type"], 91), ("odd", None, None)], RULES)
    assert len(rule_specs(rules)) == 4
    many = spark.range(12_000).selectExpr("'column_gone' anamoly", "cast(null as array<string>) compare_columns", "cast(id as int) anamoly_type")
    assert len(rule_specs(many)) == 12_000
    a = spark.createDataFrame([_anomaly(1, "c", 90), _anomaly(1, "d", 1), _anomaly(1, "e", 91)], ANOMALY)
    reg = _registry(spark, [1])
    got = {k: sorted(r["Attributes"] for r in report(a, reg, rules, k, DAY, "l").collect()) for k in ("missing_attributes", "datatype_changes", "length_changes")}
    assert got == {"missing_attributes": ["c"], "datatype_changes": ["d", "e"], "length_changes": []}
