"""Hot groups: one registered table holding a third of all baseline columns,
and one LIKE index key shared by every name. With broadcasts off and low
skew thresholds AQE must split the hot partition, and the results must not
change (compared with the per-rule specification and with brute force)."""

from collections import Counter
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from driftlens.operators import detect, detect_union
from driftlens.operators.stored import like_join
from driftlens.sources.fixtures import RULE_ROWS
from driftlens.types import RULES
from helpers import bag

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    # at scale a hot partition is far above the shuffled-hash-join map limit,
    # so the join stays sort-merge; emulate that on test-sized data
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_snapshots(spark):
    """60k baseline columns: table 1 holds 20k, 400 others 100 each."""
    hot = spark.range(20_000).select(F.lit(1).alias("config_id"), F.lit("src:c.s.hot").alias("table_name"), F.col("id").alias("i"))
    cold = spark.range(40_000).select(
        (F.col("id") % 400 + 2).alias("config_id"),
        F.concat(F.lit("src:c.s.t"), (F.col("id") % 400 + 2).cast("string")).alias("table_name"),
        F.col("id").alias("i"),
    )
    rows = hot.unionByName(cold)
    i = F.col("i")
    old = rows.select(
        F.col("config_id").cast("long").alias("config_id"),
        "table_name",
        F.concat(F.lit("c"), i.cast("string")).alias("column_name"),
        F.when(i % 3 == 0, "integer").otherwise("varchar").alias("data_type"),
        F.when(i % 2 == 0, "yes").otherwise("no").alias("is_nullable"),
        (i % 50).cast("int").alias("character_maximum_length"),
        (i % 1000).cast("int").alias("ordinal_position"),
    )
    c = F.col("config_id")
    # the hot table is dropped from the live side: all its rows need the
    # table-presence lookup (table_miss fires for each of them)
    new = old.where(~((c == 1) | (c % 37 == 0) | (F.col("ordinal_position") % 41 == 0))).select(
        "config_id",
        "table_name",
        F.when(F.col("ordinal_position") % 43 == 0, F.concat("column_name", F.lit("_x"))).otherwise(F.col("column_name")).alias("column_name"),
        F.when(F.col("ordinal_position") % 11 == 0, "number").otherwise(F.col("data_type")).alias("data_type"),
        "is_nullable",
        "character_maximum_length",
        "ordinal_position",
    )
    return old, new


def test_hot_table_detect_equals_spec_under_skew_split(spark):
    old, new = _hot_snapshots(spark)
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    with conf(spark, SKEW_CONF):
        got = detect(old, new, rules)
        cols = sorted(got.columns)
        rows = got.collect()
        got_bag = Counter(tuple(r[c] for c in cols) for r in rows)
        plan = _executed_plan(got)
        want = bag(detect_union(old, new, rules))
    assert got_bag == want
    assert sum(n for k, n in got_bag.items() if k[0] == 6 and k[-1] == "src:c.s.hot") == 20_000  # table_miss per column
    # the dropped hot table is split in the join with the dropped tables: both
    # of its inputs are plain shuffles, no aggregate stands in between
    assert "isFinalPlan=true" in plan
    assert re.search(r"SortMergeJoin\(skew=true\) \[config_id#\d+L, table_name#\d+, _length#\d+\]", plan), plan
    assert "BroadcastHashJoin" not in plan


def test_detect_shuffles_each_input_in_full_once(spark, scratch):
    old, new = _hot_snapshots(spark)
    old.write.parquet(f"{scratch}/old")
    new.write.parquet(f"{scratch}/new")
    old, new = spark.read.parquet(f"{scratch}/old"), spark.read.parquet(f"{scratch}/new")
    rules = spark.createDataFrame(RULE_ROWS, RULES)
    with conf(spark, SKEW_CONF):
        plan = detect(old, new, rules)._jdf.queryExecution().sparkPlan().toString()
        shuffled = detect(old, new, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1
    on_columns = re.findall(r"Exchange hashpartitioning\(config_id#\d+L, table_name#\d+, column_name#\d+", shuffled)
    assert len(on_columns) == 2, shuffled


def test_like_join_with_one_key_shared_by_every_name(spark):
    # every name shares the prefix, and '%' patterns need only the catch-all key
    names = spark.range(3000).select(F.concat(F.lit("src:c.s.t_"), F.col("id").cast("string")).alias("name"))
    pats = spark.createDataFrame(
        [(1, "%"), (2, "src:c.s.t_1%"), (3, "%_7"), (4, "src:c.s.t__"), (5, "%.t_2%9"), (6, "src:c.s.t_123")],
        "pid int, pattern string",
    )
    with conf(spark, SKEW_CONF):
        got = like_join(pats, "pattern", names, "name").select("pid", "name")
        rows = got.collect()
        got_bag = Counter((r["name"], r["pid"]) for r in rows)
        plan = _executed_plan(got)
    # both inputs of the candidate join are plain shuffles, so it is split where
    # one key is hot; nothing is hinted
    candidate_join = re.search(r"SortMergeJoin(\(skew=true\))? \[_k#\d+L\], \[_k#\d+L\], Inner, _name#\d+ LIKE", plan)
    assert candidate_join and candidate_join.group(1), plan
    ns = [r["name"] for r in names.collect()]

    def like(p, s):
        rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in p)
        return re.fullmatch(rx, s, flags=re.S) is not None

    want = {}
    for r in pats.collect():
        for n in ns:
            if like(r["pattern"], n):
                want[(n, r["pid"])] = want.get((n, r["pid"]), 0) + 1
    assert dict(got_bag) == want
    assert sum(1 for (n, p) in want if p == 1) == len(ns)  # '%' matches every name, none dropped
