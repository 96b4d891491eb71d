"""Rule semantics on hand-written rows (SURVEY behaviour decisions B1-B6, B22)."""

import datetime as dt

from pyspark.sql import functions as F

from driftlens.operators import detect, detect_union, missing_tables, rule_specs, to_anomaly_rows, value_change
from driftlens.operators.detect import Rule
from driftlens.sources.fixtures import RULE_ROWS
from driftlens.types import ANOMALY, DETECTED, RULES
from helpers import bag, snap

T1 = "pg:db.s.t1"
T2 = "pg:db.s.t2"


def rules(spark, rows=RULE_ROWS):
    return spark.createDataFrame(rows, RULES)


def test_value_rule_keeps_old_value_and_nulls(spark):
    old = snap(spark, [(1, T1, "id", "number", "yes", 0, 1)])
    new = snap(spark, [(1, T1, "id", "double precision", "yes", 0, 1)])
    d = detect(old, new, rules(spark)).where("anamoly_id = 2").collect()
    assert len(d) == 1
    assert (d[0]["data_type_old"], d[0]["data_type"]) == ("number", "double precision")  # B1 fixed
    assert d[0]["is_nullable_old"] is None and d[0]["is_nullable"] is None  # B2: NULL, not 'nan'


def test_dropped_column_fires_value_rules_unless_strict(spark):
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (1, T1, "b", "int", "yes", 0, 2)])
    new = snap(spark, [(1, T1, "a", "int", "yes", 0, 1)])
    d = bag(detect(old, new, rules(spark)), ["column_name", "anamoly_id"])
    # B4: b is missing (0) and also changed under every value rule (2..5)
    assert d == {("b", 0): 1, ("b", 2): 1, ("b", 3): 1, ("b", 4): 1, ("b", 5): 1}
    assert value_change(old, new, "data_type", include_unmatched=False).count() == 0


def test_null_against_null_is_a_change_only_in_default_mode(spark):
    old = snap(spark, [(1, T1, "a", None, "yes", 0, 1)])
    new = snap(spark, [(1, T1, "a", None, "yes", 0, 1)])
    assert value_change(old, new, "data_type").count() == 1  # B5 kept
    assert value_change(old, new, "data_type", include_unmatched=False).count() == 0


def test_table_miss_one_row_per_column_and_distinct_variant(spark):
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (1, T1, "b", "int", "yes", 0, 2), (2, T2, "a", "int", "no", 0, 1)])
    new = snap(spark, [(2, T2, "a", "int", "no", 0, 1)])
    d = detect(old, new, rules(spark)).where("anamoly_id = 6")
    assert bag(d, ["config_id", "table_name", "column_name"]) == {(1, T1, None): 2}  # B6
    assert missing_tables(old, new, distinct=True).count() == 1


def test_config_id_scopes_every_comparison(spark):
    # two entries watch the same table; only entry 2's baseline differs
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (2, T1, "a", "text", "yes", 0, 1)])
    new = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (2, T1, "a", "int", "yes", 0, 1)])
    d = detect(old, new, rules(spark)).collect()
    assert [(r["config_id"], r["anamoly_id"]) for r in d] == [(2, 2)]


def test_duplicate_keys_multiply_like_a_join(spark):
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1)] * 2)
    new = snap(spark, [(1, T1, "a", "text", "yes", 0, 1)] * 3)
    assert detect(old, new, rules(spark)).where("anamoly_id = 2").count() == 6
    assert bag(detect(old, new, rules(spark))) == bag(detect_union(old, new, rules(spark)))


def test_rule_dispatch_is_data_driven(spark):
    custom = [
        ("datatype", ["table_name", "column_name", "data_type"], 12),
        ("gone", ["table_name", "column_name"], 10),  # any other name: missing column
        ("new_column", ["table_name", "column_name"], 11),
    ]
    specs = rule_specs(rules(spark, custom + custom))  # SELECT DISTINCT
    assert [(s.name, s.kind, s.anamoly_id) for s in specs] == [
        ("gone", "missing", 10),
        ("new_column", "new", 11),
        ("datatype", "value", 12),
    ]
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1)])
    new = snap(spark, [(1, T1, "z", "int", "yes", 0, 1)])
    ids = sorted(r["anamoly_id"] for r in detect(old, new, specs).collect())
    assert ids == [10, 11, 12]


def test_zero_rules_and_partial_rule_sets_keep_the_schema(spark):
    old = snap(spark, [(1, T1, "a", "int", "yes", 0, 1)])
    new = snap(spark, [])
    empty = detect(old, new, [])
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in DETECTED]
    assert empty.count() == 0
    only_length = [Rule("length", "value", 3, "character_maximum_length")]
    d = detect(old, new, only_length)
    assert d.schema.fieldNames() == DETECTED.fieldNames()  # B22: no KeyError, fixed layout
    rows = to_anomaly_rows(d, dt.datetime(2023, 4, 19, 7, 0))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in ANOMALY]
    assert rows.first()["updated_at"] == dt.datetime(2023, 4, 19, 7, 0)


def test_value_rule_must_name_a_known_attribute(spark):
    import pytest

    with pytest.raises(ValueError):
        rule_specs(rules(spark, [("datatype", ["table_name", "column_name", "colour"], 2)]))


def test_new_and_missing_swap_when_sides_swap(spark):
    a = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (1, T1, "b", "int", "yes", 0, 2)])
    b = snap(spark, [(1, T1, "a", "int", "yes", 0, 1), (1, T1, "c", "int", "yes", 0, 2)])
    r = rules(spark)
    ab = detect(a, b, r).where("anamoly_id in (0, 1)").select("column_name", "anamoly_id")
    ba = detect(b, a, r).where("anamoly_id in (0, 1)").select("column_name", F.expr("1 - anamoly_id").alias("anamoly_id"))
    assert bag(ab) == bag(ba)
