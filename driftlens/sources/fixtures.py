"""At-scale test inputs derived from the driver's TPC-H-like parquet tables.

``lineitem`` becomes a captured baseline (one registered table per order,
one column per line) and a mutated live snapshot of it; ``orders`` becomes
the registry. Every view grows with the scale factor. The same definitions
exist as SQL CTEs in :mod:`driftlens.plans.oracle` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.functions.names import ts_ntz
from driftlens.types import RULES

# Fixed values of the working rule catalogue: rule name, compared columns,
# anomaly id. Only id 2 (datatype) is documented by the original
# application; the other ids are this project's choice.
RULE_ROWS = [
    ("missing_column", ["table_name", "column_name"], 0),
    ("new_column", ["table_name", "column_name"], 1),
    ("datatype", ["table_name", "column_name", "data_type"], 2),
    ("length", ["table_name", "column_name", "character_maximum_length"], 3),
    ("ordinal", ["table_name", "column_name", "ordinal_position"], 4),
    ("is_null", ["table_name", "column_name", "is_nullable"], 5),
    ("table_miss", ["table_name"], 6),
]

# Two simulated detection runs: rows of every fourth entry were found on the
# earlier day. The reports read the later day.
RUN_EARLY = "2023-04-18 07:00:00"
RUN_LATE = "2023-04-19 07:00:00"
REPORT_DAY = "2023-04-19"
REVIEW_LINK = "https://example.com/review"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured baseline with ``table_name`` (the schema_configuration view)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_returnflag").alias("rf"),
        F.min("l_linestatus").alias("ls"),
        F.max("l_quantity").alias("mq"),
    )
    return g.select(
        F.col("l_orderkey").alias("config_id"),
        F.concat(F.lit("redshift_dev:tpch.public.t_"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.when(F.col("rf") == "A", "integer")
        .when(F.col("rf") == "N", "varchar")
        .otherwise("double precision")
        .alias("data_type"),
        F.col("l_linenumber").alias("ordinal_position"),
        F.when(F.col("ls") == "O", "yes").otherwise("no").alias("is_nullable"),
        F.when(F.col("rf") == "N", F.col("mq").cast("int")).otherwise(F.lit(0)).alias("character_maximum_length"),
    )


def cur(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Live snapshot: the baseline with renamed, retyped and dropped columns and tables."""
    b = base if base is not None else baseline(spark, sf_dir)
    cid, pos = F.col("config_id"), F.col("ordinal_position")
    return b.where(((cid % 23) != 0) & (((cid + pos * 2) % 13) != 0)).select(
        cid,
        F.col("table_name"),
        F.when(((cid * 3 + pos) % 17) == 0, F.concat(F.col("column_name"), F.lit("_new")))
        .otherwise(F.col("column_name"))
        .alias("column_name"),
        F.when(((cid * 7 + pos) % 11) == 0, F.lit("number")).otherwise(F.col("data_type")).alias("data_type"),
        F.when((cid % 19) == 0, pos + 1).otherwise(pos).alias("ordinal_position"),
        F.when(
            ((cid + pos) % 29) == 0,
            F.when(F.col("is_nullable") == "yes", "no").otherwise("yes"),
        )
        .otherwise(F.col("is_nullable"))
        .alias("is_nullable"),
        F.when(
            (F.col("data_type") == "varchar") & (((cid * 5 + pos) % 7) == 0),
            F.col("character_maximum_length") + 10,
        )
        .otherwise(F.col("character_maximum_length"))
        .alias("character_maximum_length"),
    )


def baseline_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = baseline(spark, sf_dir)
    return b.select(
        "config_id",
        "table_name",
        "column_name",
        F.when((F.col("config_id") % 101) == 0, F.lit(None)).otherwise(F.col("data_type")).alias("data_type"),
    )


def cur_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cur(spark, sf_dir)
    return c.select(
        "config_id",
        "table_name",
        "column_name",
        F.when((F.col("config_id") % 101) < 2, F.lit(None)).otherwise(F.col("data_type")).alias("data_type"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """master_configuration: one entry per order, plus a second entry for every
    50th table (two entries naming one table)."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    name = F.concat(F.lit("Redshift_Dev:TPCH.Public.T_"), key.cast("string"))
    main = o.select(
        key.alias("config_id"),
        name.alias("table_name"),
        F.when(F.col("o_orderstatus") == "O", "distribution").otherwise("schema").alias("check_type"),
        F.lit("user@example.com").alias("created_by"),
        ((key % 10) != 1).alias("is_active"),
        ((key % 10) == 0).alias("is_deleted"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )
    dup = o.where((key % 50) == 0).select(
        (key + 1000000000).alias("config_id"),
        name.alias("table_name"),
        F.lit("schema").alias("check_type"),
        F.lit("user@example.com").alias("created_by"),
        F.lit(True).alias("is_active"),
        F.lit(False).alias("is_deleted"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )
    return main.unionByName(dup)


def live_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """information_schema.columns of one source, upper-case identifiers."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    return li.select(
        F.lit("TPCH").alias("table_catalog"),
        F.lit("PUBLIC").alias("table_schema"),
        F.concat(F.lit("T_"), F.col("l_orderkey").cast("string")).alias("table_name"),
        F.concat(F.lit("C"), ln.cast("string")).alias("column_name"),
        F.when((ln % 2) == 0, "VARCHAR").otherwise("INTEGER").alias("data_type"),
        F.when((ln % 3) == 0, "YES").otherwise("NO").alias("is_nullable"),
        F.when((ln % 2) == 0, (ln * 10).cast("int")).alias("character_maximum_length"),
        ln.cast("string").alias("ordinal_position"),
    )


def registry_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry over two connectors: every third entry is of a source that
    folds unquoted names to lower case, the others of one that folds to upper."""
    return registry(spark, sf_dir).withColumn(
        "table_name", F.when((F.col("config_id") % 3) == 0, F.replace("table_name", F.lit("Redshift_Dev:"), F.lit("Postgres_Dev:"))).otherwise(F.col("table_name"))
    )


def live_columns_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """information_schema.columns of both sources, tagged with ``source``. The
    lower-case source has each table twice, by its own rule and as a quoted
    upper-case table that no entry names; it calls integers ``int4``."""
    up = live_columns(spark, sf_dir)
    lower = [F.lower(c).alias(c) for c in ("table_catalog", "table_schema", "table_name", "column_name")]
    rest = ["is_nullable", "character_maximum_length", "ordinal_position"]
    low = up.select(*lower, F.when(F.col("data_type") == "INTEGER", "int4").otherwise(F.lower("data_type")).alias("data_type"), *rest)
    quoted = up.withColumn("data_type", F.lit("quoted"))
    return up.withColumn("source", F.lit("redshift_dev")).unionByName(low.unionByName(quoted).withColumn("source", F.lit("postgres_dev")))


def state(spark: SparkSession) -> DataFrame:
    """master_config_status: one high-water mark per check type."""
    rows = spark.createDataFrame(
        [("schema", "1998-01-01 00:00:00"), ("distribution", "1997-01-01 00:00:00")],
        "check_type string, ts string",
    )
    return rows.select("check_type", ts_ntz(F.col("ts")).alias("updated_at"))


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULE_ROWS, RULES)


def run_timestamp() -> "F.Column":
    """Per-row run timestamp of the two simulated detection runs."""
    return F.when((F.col("config_id") % 4) == 0, ts_ntz(RUN_EARLY)).otherwise(ts_ntz(RUN_LATE))
