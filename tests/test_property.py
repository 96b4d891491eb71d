"""Property tests: the single-pass diff equals the union of the per-rule joins."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftlens.operators import detect, detect_union, value_change
from driftlens.sources.fixtures import RULE_ROWS
from driftlens.types import RULES
from helpers import bag, snap

row = st.tuples(
    st.sampled_from([1, 2]),
    st.sampled_from(["s:c.d.t1", "s:c.d.t2", "s:c.d.t3"]),
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from(["int", "text", None]),
    st.sampled_from(["yes", "no", None]),
    st.sampled_from([0, 5, None]),
    st.sampled_from([1, 2, None]),
)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(old=st.lists(row, max_size=8), new=st.lists(row, max_size=8))
def test_single_pass_equals_union(spark, old, new):
    o, n = snap(spark, old), snap(spark, new)
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    assert bag(detect(o, n, rules)) == bag(detect_union(o, n, rules))


@SETTINGS
@given(rows=st.lists(row, max_size=8))
def test_snapshot_against_itself_is_clean_in_strict_mode(spark, rows):
    # de-duplicate keys: a snapshot has one row per column
    uniq = {r[:3]: r for r in rows}
    s = snap(spark, list(uniq.values()))
    for attr in ("data_type", "is_nullable", "character_maximum_length", "ordinal_position"):
        assert value_change(s, s, attr, include_unmatched=False).count() == 0
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    structural = detect(s, s, rules).where("anamoly_id in (0, 1, 6)")
    assert structural.count() == 0


@SETTINGS
@given(old=st.lists(row, max_size=8), new=st.lists(row, max_size=8))
def test_diff_status_equals_full_outer_join(spark, old, new):
    from pyspark.sql import functions as F

    from driftlens.operators import diff_status

    o, n = snap(spark, old), snap(spark, new)
    keys = ["config_id", "table_name", "column_name"]
    oo = o.select(*keys, F.lit(1).alias("_o"))
    nn = n.select(*keys, F.lit(1).alias("_n"))
    full = oo.join(nn, keys, "full").select(
        *keys,
        F.when(F.col("_o").isNull(), "right_only").when(F.col("_n").isNull(), "left_only").otherwise("both").alias("status"),
    )
    assert bag(diff_status(o, n)) == bag(full)
