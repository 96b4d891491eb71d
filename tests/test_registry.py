"""Registry parsing, due entries, NOT IN semantics and the high-water mark."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftlens.operators import NO_STATE, advance_hwm, current_hwm, due_entries, parse_registry
from driftlens.operators.common import not_in
from driftlens.types import BASELINE, REGISTRY, STATE

D = dt.datetime


def registry(spark, rows):
    full = [(cid, name, ct, "user@example.com", True, False, ts) for cid, name, ct, ts in rows]
    return spark.createDataFrame(full, REGISTRY)


def baseline(spark, ids):
    return spark.createDataFrame([(i, "c", "int", "yes", 0, 1) for i in ids], BASELINE)


def state(spark, rows):
    return spark.createDataFrame(rows, STATE)


def test_parse_registry_parts_and_missing_parts(spark):
    r = registry(
        spark,
        [(1, "Snow_UAT:Cat.Sch.Tab", "schema", D(2023, 1, 1)), (2, "broken", "schema", D(2023, 1, 1)), (3, "x:a.b.c", "other", D(2023, 1, 1))],
    )
    got = {row["config_id"]: tuple(row)[2:6] for row in parse_registry(r).collect()}
    assert got == {1: ("snow_uat", "cat", "sch", "tab"), 2: ("broken", "", "", "")}
    capture_parts = parse_registry(r, lower_all=False).where("config_id = 1").first()
    assert (capture_parts["source"], capture_parts["catalog_name"], capture_parts["tbl_name"]) == ("snow_uat", "Cat", "Tab")


def test_due_entries_hwm_is_strict_and_excludes_captured(spark):
    r = registry(
        spark,
        [(1, "a:c.s.t1", "schema", D(2023, 1, 1)), (2, "a:c.s.t2", "schema", D(2023, 1, 2)), (3, "a:c.s.t3", "schema", D(2023, 1, 3))],
    )
    s = state(spark, [("schema", D(2023, 1, 1))])
    due = due_entries(r, baseline(spark, [3]), s)
    assert sorted(x["config_id"] for x in due.collect()) == [2]


def test_missing_state_row_means_everything_due_and_null_hwm_nothing(spark):
    r = registry(spark, [(1, "a:c.s.t1", "schema", D(2023, 1, 1))])
    assert current_hwm(state(spark, [("distribution", D(2023, 1, 1))])) is NO_STATE
    assert due_entries(r, baseline(spark, []), state(spark, [("distribution", D(2023, 1, 1))])).count() == 1  # B23
    assert due_entries(r, baseline(spark, []), state(spark, [("schema", None)])).count() == 0  # F2


@pytest.mark.parametrize(
    "keys,subquery",
    [([1, 2, None], [2]), ([1, 2, None], []), ([1, 2, None], [2, None]), ([None], [None]), ([1, 1, 3], [3, 3])],
)
def test_not_in_matches_sql_null_semantics(spark, keys, subquery):
    left = spark.createDataFrame([(k,) for k in keys], "k long")
    sub = spark.createDataFrame([(k,) for k in subquery], "v long")
    ours = sorted((r["k"] for r in not_in(left, "k", sub).collect()), key=str)
    left.createOrReplaceTempView("l_t")
    sub.createOrReplaceTempView("s_t")
    sql = sorted((r["k"] for r in spark.sql("SELECT k FROM l_t WHERE k NOT IN (SELECT v FROM s_t)").collect()), key=str)
    assert ours == sql


def test_one_null_captured_id_blocks_all_capture(spark):
    r = registry(spark, [(1, "a:c.s.t1", "schema", D(2023, 1, 2))])
    b = spark.createDataFrame([(None, "c", "int", "yes", 0, 1)], BASELINE)
    assert due_entries(r, b, state(spark, [("schema", D(2023, 1, 1))])).count() == 0  # B7 kept


def test_advance_hwm_takes_snapshot_max_and_keeps_old_when_empty(spark):
    s = state(spark, [("schema", D(2023, 1, 1)), ("distribution", D(2022, 1, 1))])
    r = registry(spark, [(1, "a:c.s.t", "schema", D(2023, 5, 1)), (2, "a:c.s.u", "distribution", D(2024, 1, 1))])
    got = {x["check_type"]: x["updated_at"] for x in advance_hwm(s, r).collect()}
    assert got == {"schema": D(2023, 5, 1), "distribution": D(2022, 1, 1)}
    empty = r.where(F.lit(False))
    got = {x["check_type"]: x["updated_at"] for x in advance_hwm(s, empty).collect()}
    assert got["schema"] == D(2023, 1, 1)  # B8 fixed: never NULL
