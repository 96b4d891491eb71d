"""All anomaly rules in one pass (the detection diff) and the sink layout.

The rule catalogue is data: each row names a rule, the columns it compares
and the anomaly id it writes. Dispatch on the rule name follows the original
application:

* ``datatype``, ``length``, ``is_null``, ``ordinal``: value rules; the last
  compared column is the attribute,
* ``new_column``: live columns absent from the baseline,
* ``table_miss``: baseline tables absent from the live side, one row per
  baseline column,
* any other name: baseline columns absent from the live side.

Plan, the same at every size: baseline FULL OUTER JOIN live on (config_id,
table_name, column_name), so each input is shuffled in full once, on the full
key, and no table's columns have to share a task (only exact duplicates of one
column could be a hot key). Every rule is a condition on the joined row and the
rules that fire are exploded. ``table_miss`` fires first for every baseline
row without a live column; those rows then meet the dropped tables, found at
table level (:func:`driftlens.operators.diff.join_tables`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import ts_ntz
from driftlens.functions.predicates import changed
from driftlens.operators.diff import dropped_tables, join_tables, missing_columns, missing_tables, new_columns, value_change
from driftlens.types import ANOMALY, ATTRIBUTES, DETECTED, KEYS, TABLE_KEYS

# Rule names the dispatch recognises.
VALUE_RULES = ("datatype", "length", "is_null", "ordinal")
NEW_COLUMN = "new_column"
TABLE_MISS = "table_miss"


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str  # value | new | missing | table
    anamoly_id: int
    attr: str | None = None


def rule_specs(rules: DataFrame) -> list[Rule]:
    """Collect the (tiny) distinct rule catalogue to the driver and classify it."""
    rows = rules.select("anamoly", "compare_columns", "anamoly_type").distinct().collect()
    specs = []
    for r in sorted(rows, key=lambda r: (r["anamoly_type"] is None, r["anamoly_type"] or 0, r["anamoly"] or "")):
        name, cols, rid = r["anamoly"], list(r["compare_columns"] or []), r["anamoly_type"]
        if name in VALUE_RULES:
            if not cols or cols[-1] not in ATTRIBUTES:
                raise ValueError(f"value rule {name!r} must compare one of {sorted(ATTRIBUTES)}, got {cols}")
            specs.append(Rule(name, "value", rid, cols[-1]))
        elif name == NEW_COLUMN:
            specs.append(Rule(name, "new", rid))
        elif name == TABLE_MISS:
            specs.append(Rule(name, "table", rid))
        else:
            specs.append(Rule(name, "missing", rid))
    return specs


def _empty(spark) -> DataFrame:
    return spark.createDataFrame([], DETECTED)


def detect(old: DataFrame, new: DataFrame, rules: DataFrame | list[Rule]) -> DataFrame:
    """Every rule over every registered table, one distributed pass.

    ``old``/``new`` need the keys and the compared attributes.
    """
    specs = rules if isinstance(rules, list) else rule_specs(rules)
    if not specs:
        return _empty(old.sparkSession)
    attrs = sorted({s.attr for s in specs if s.kind == "value"})
    o = old.select(*KEYS, *[F.col(a).alias(f"_o_{a}") for a in attrs], F.lit(True).alias("_in_old"))
    n = new.select(*KEYS, *[F.col(a).alias(f"_n_{a}") for a in attrs], F.lit(True).alias("_in_new"))
    in_old, in_new = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()

    # which rules fire on this joined row: explode only their positions,
    # then derive the output columns from the position
    fired = []
    for i, s in enumerate(specs):
        if s.kind == "value":
            cond = in_old & changed(F.col(f"_o_{s.attr}"), F.col(f"_n_{s.attr}"))
        elif s.kind == "new":
            cond = ~in_old
        else:
            cond = ~in_new
        fired.append(F.when(cond, F.lit(i)))
    hits = o.join(n, KEYS, "full").select("*", F.explode(F.filter(F.array(*fired), lambda x: x.isNotNull())).alias("_rule"))
    found = hits.select("_rule", *_layout(specs))
    tables = [i for i, s in enumerate(specs) if s.kind == "table"]
    if tables:
        gone = dropped_tables(old, new).withColumn("_gone", F.lit(True))
        found = join_tables(found, gone, "left").where(~F.col("_rule").isin(tables) | F.col("_gone").isNotNull())
    return found.select(*[f.name for f in DETECTED.fields])


def _layout(specs: list[Rule]) -> list[Column]:
    """DETECTED columns for rows tagged with ``_rule``, a position in ``specs``."""
    rule = F.col("_rule")

    def among(pred) -> Column | None:
        ix = [i for i, s in enumerate(specs) if pred(s)]
        if not ix:
            return None
        return rule == ix[0] if len(ix) == 1 else rule.isin(ix)

    ids = F.array(*[F.lit(s.anamoly_id) for s in specs])
    is_table = among(lambda s: s.kind == "table")
    cols = [
        F.col("config_id"),
        F.col("table_name"),
        (F.when(~is_table, F.col("column_name")) if is_table is not None else F.col("column_name")).alias("column_name"),
        (F.lit(specs[0].anamoly_id) if len(specs) == 1 else F.element_at(ids, rule + 1)).cast("int").alias("anamoly_id"),
    ]
    for attr, dtype in ATTRIBUTES.items():
        mine = among(lambda s: s.kind == "value" and s.attr == attr)
        for side, name in (("_o_", f"{attr}_old"), ("_n_", attr)):
            v = F.when(mine, F.col(f"{side}{attr}")) if mine is not None else F.lit(None)
            cols.append(v.cast(dtype).alias(name))
    return cols


def detect_union(old: DataFrame, new: DataFrame, rules: DataFrame | list[Rule]) -> DataFrame:
    """Same result as :func:`detect`, one join per rule (the reference's shape).

    Kept as the specification the single pass is tested against.
    """
    specs = rules if isinstance(rules, list) else rule_specs(rules)
    if not specs:
        return _empty(old.sparkSession)
    parts = []
    for s in specs:
        if s.kind == "value":
            v = value_change(old, new, s.attr)
            d = v.select(*KEYS, F.col(f"{s.attr}_old"), F.col(s.attr))
        elif s.kind == "new":
            d = new_columns(old, new)
        elif s.kind == "missing":
            d = missing_columns(old, new)
        else:
            d = missing_tables(old, new).withColumn("column_name", F.lit(None).cast("string"))
        parts.append(d.withColumn("anamoly_id", F.lit(s.anamoly_id).cast("int")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DETECTED.fields])


def to_anomaly_rows(detected: DataFrame, run_ts) -> DataFrame:
    """schema_anamoly layout: drop ``table_name``, stamp the run timestamp.

    ``run_ts`` is one timestamp for the whole run (a parameter, never the
    clock at evaluation time) or a Column. Old values are kept and missing
    values stay NULL (typed), never the strings ``nan``/``None``.
    """
    ts = run_ts if isinstance(run_ts, Column) else ts_ntz(run_ts)
    cols = [
        (ts if f.name == "updated_at" else F.col(f.name)).cast(f.dataType).alias(f.name) for f in ANOMALY.fields
    ]
    return detected.select(*cols)
