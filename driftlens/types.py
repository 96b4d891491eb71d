"""Schemas of the tables the engine reads and writes.

All timestamps are ``TimestampNTZType``: the metadata database stores
``timestamp`` without a time zone, and keeping NTZ end to end means no
result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The metadata tables keep the historical spelling "anamoly" in table and
# column names; that spelling is part of the on-disk contract.

REGISTRY = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("table_name", T.StringType()),  # connector:catalog.schema.table
        T.StructField("check_type", T.StringType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("is_deleted", T.BooleanType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# schema_configuration: one captured column of one registered table.
BASELINE = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("character_maximum_length", T.IntegerType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)

# A snapshot row: what the diff compares, on either side.
SNAPSHOT = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("character_maximum_length", T.IntegerType()),
        T.StructField("ordinal_position", T.IntegerType()),
    ]
)

# master_config_status: high-water mark per check type.
STATE = T.StructType(
    [
        T.StructField("check_type", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# Entries that were due but had no live table yet; they are due again.
PENDING = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("run_key", T.StringType()),
    ]
)

# Rows set aside on the way in: of entries and captured rows alike, the keys
# that both have, and why.
REJECTED = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

# anamoly_master: the data-driven rule catalogue.
RULES = T.StructType(
    [
        T.StructField("anamoly", T.StringType()),
        T.StructField("compare_columns", T.ArrayType(T.StringType())),
        T.StructField("anamoly_type", T.IntegerType()),
    ]
)

# information_schema.columns as a source database exposes it.
LIVE_COLUMNS = T.StructType(
    [
        T.StructField("table_catalog", T.StringType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("character_maximum_length", T.IntegerType()),
        T.StructField("ordinal_position", T.StringType()),
    ]
)

# Attributes a value rule can compare, with their Spark types.
ATTRIBUTES: dict[str, T.DataType] = {
    "data_type": T.StringType(),
    "ordinal_position": T.IntegerType(),
    "is_nullable": T.StringType(),
    "character_maximum_length": T.IntegerType(),
}

KEYS = ["config_id", "table_name", "column_name"]
TABLE_KEYS = ["config_id", "table_name"]

# Output of the diff: one row per detected anomaly, all rules in one layout.
DETECTED = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("anamoly_id", T.IntegerType()),
        T.StructField("data_type_old", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("ordinal_position_old", T.IntegerType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("is_nullable_old", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("character_maximum_length_old", T.IntegerType()),
        T.StructField("character_maximum_length", T.IntegerType()),
    ]
)

# schema_anamoly sink layout (table_name dropped, run timestamp added).
ANOMALY = T.StructType(
    [
        T.StructField("config_id", T.LongType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("data_type_old", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("ordinal_position_old", T.IntegerType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("is_nullable_old", T.StringType()),
        T.StructField("character_maximum_length", T.IntegerType()),
        T.StructField("character_maximum_length_old", T.IntegerType()),
        T.StructField("anamoly_id", T.IntegerType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
