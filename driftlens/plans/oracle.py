"""DuckDB oracle SQL for every registered query.

Only the raw tables are registered in DuckDB, so each query carries the
fixture views as CTEs. The views are the SQL twins of
:mod:`driftlens.sources.fixtures`.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "baseline": """
SELECT l_orderkey AS config_id,
 concat('redshift_dev:tpch.public.t_', cast(l_orderkey AS string)) AS table_name,
 concat('c', cast(l_linenumber AS string)) AS column_name,
 CASE min(l_returnflag) WHEN 'A' THEN 'integer' WHEN 'N' THEN 'varchar' ELSE 'double precision' END AS data_type,
 l_linenumber AS ordinal_position,
 CASE min(l_linestatus) WHEN 'O' THEN 'yes' ELSE 'no' END AS is_nullable,
 CASE WHEN min(l_returnflag) = 'N' THEN cast(max(l_quantity) AS int) ELSE 0 END AS character_maximum_length
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "cur": """
SELECT config_id, table_name,
 CASE WHEN (config_id * 3 + ordinal_position) % 17 = 0 THEN concat(column_name, '_new') ELSE column_name END AS column_name,
 CASE WHEN (config_id * 7 + ordinal_position) % 11 = 0 THEN 'number' ELSE data_type END AS data_type,
 CASE WHEN config_id % 19 = 0 THEN ordinal_position + 1 ELSE ordinal_position END AS ordinal_position,
 CASE WHEN (config_id + ordinal_position) % 29 = 0 THEN CASE is_nullable WHEN 'yes' THEN 'no' ELSE 'yes' END ELSE is_nullable END AS is_nullable,
 CASE WHEN data_type = 'varchar' AND (config_id * 5 + ordinal_position) % 7 = 0 THEN character_maximum_length + 10 ELSE character_maximum_length END AS character_maximum_length
FROM baseline WHERE config_id % 23 <> 0 AND (config_id + ordinal_position * 2) % 13 <> 0""",
    "baseline_nulls": """
SELECT config_id, table_name, column_name, CASE WHEN config_id % 101 = 0 THEN NULL ELSE data_type END AS data_type FROM baseline""",
    "cur_nulls": """
SELECT config_id, table_name, column_name, CASE WHEN config_id % 101 < 2 THEN NULL ELSE data_type END AS data_type FROM cur""",
    "registry": """
SELECT o_orderkey AS config_id,
 concat('Redshift_Dev:TPCH.Public.T_', cast(o_orderkey AS string)) AS table_name,
 CASE WHEN o_orderstatus = 'O' THEN 'distribution' ELSE 'schema' END AS check_type,
 o_orderkey % 10 <> 1 AS is_active, o_orderkey % 10 = 0 AS is_deleted,
 o_orderdate AS updated_at
FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, concat('Redshift_Dev:TPCH.Public.T_', cast(o_orderkey AS string)), 'schema', true, false, o_orderdate
FROM orders WHERE o_orderkey % 50 = 0""",
    "live_columns": """
SELECT 'TPCH' AS table_catalog, 'PUBLIC' AS table_schema,
 concat('T_', cast(l_orderkey AS string)) AS table_name,
 concat('C', cast(l_linenumber AS string)) AS column_name,
 CASE WHEN l_linenumber % 2 = 0 THEN 'VARCHAR' ELSE 'INTEGER' END AS data_type,
 CASE WHEN l_linenumber % 3 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
 CASE WHEN l_linenumber % 2 = 0 THEN cast(l_linenumber * 10 AS int) END AS character_maximum_length,
 cast(l_linenumber AS string) AS ordinal_position
FROM lineitem""",
    "registry_two": """
SELECT * REPLACE (CASE WHEN config_id % 3 = 0 THEN replace(table_name, 'Redshift_Dev:', 'Postgres_Dev:') ELSE table_name END AS table_name) FROM registry""",
    "live_columns_two": """
SELECT *, 'redshift_dev' AS source FROM live_columns
UNION ALL
SELECT lower(table_catalog), lower(table_schema), lower(table_name), lower(column_name),
 CASE data_type WHEN 'INTEGER' THEN 'int4' ELSE lower(data_type) END, is_nullable, character_maximum_length, ordinal_position, 'postgres_dev' FROM live_columns
UNION ALL
SELECT * REPLACE ('quoted' AS data_type), 'postgres_dev' FROM live_columns""",
    "state": """
SELECT 'schema' AS check_type, TIMESTAMP '1998-01-01 00:00:00' AS updated_at
UNION ALL SELECT 'distribution', TIMESTAMP '1997-01-01 00:00:00'""",
}

_NULL_ATTRS = {
    "data_type": "cast(NULL AS string) AS data_type_old, cast(NULL AS string) AS data_type",
    "ordinal_position": "cast(NULL AS int) AS ordinal_position_old, cast(NULL AS int) AS ordinal_position",
    "is_nullable": "cast(NULL AS string) AS is_nullable_old, cast(NULL AS string) AS is_nullable",
    "character_maximum_length": "cast(NULL AS int) AS character_maximum_length_old, cast(NULL AS int) AS character_maximum_length",
}

_JOIN = "o.config_id = n.config_id AND o.table_name = n.table_name AND o.column_name = n.column_name"


def _attrs(only: str | None = None, alias_old: str = "o", alias_new: str = "n") -> str:
    parts = []
    for a, nulls in _NULL_ATTRS.items():
        parts.append(f"{alias_old}.{a} AS {a}_old, {alias_new}.{a} AS {a}" if a == only else nulls)
    return ", ".join(parts)


def _value_branch(attr: str, rid: int) -> str:
    return (
        f"SELECT o.config_id, o.table_name, o.column_name, {rid} AS anamoly_id, {_attrs(attr)}\n"
        f"FROM baseline o LEFT JOIN cur n ON {_JOIN} WHERE coalesce(o.{attr} <> n.{attr}, true)"
    )


VIEWS["detected"] = "\nUNION ALL\n".join(
    [
        _value_branch("data_type", 2),
        _value_branch("character_maximum_length", 3),
        _value_branch("ordinal_position", 4),
        _value_branch("is_nullable", 5),
        f"SELECT n.config_id, n.table_name, n.column_name, 1 AS anamoly_id, {_attrs()}\n"
        f"FROM cur n WHERE NOT EXISTS (SELECT 1 FROM baseline o WHERE {_JOIN})",
        f"SELECT o.config_id, o.table_name, o.column_name, 0 AS anamoly_id, {_attrs()}\n"
        f"FROM baseline o WHERE NOT EXISTS (SELECT 1 FROM cur n WHERE {_JOIN})",
        f"SELECT o.config_id, o.table_name, cast(NULL AS string) AS column_name, 6 AS anamoly_id, {_attrs()}\n"
        "FROM baseline o WHERE NOT EXISTS (SELECT 1 FROM cur n WHERE o.config_id = n.config_id AND o.table_name = n.table_name)",
    ]
)

VIEWS["anomalies"] = """
SELECT d.config_id, d.column_name, d.data_type, d.data_type_old, d.ordinal_position, d.ordinal_position_old, d.is_nullable, d.is_nullable_old,
 d.character_maximum_length, d.character_maximum_length_old, d.anamoly_id,
 CASE WHEN d.config_id % 4 = 0 THEN TIMESTAMP '2023-04-18 07:00:00' ELSE TIMESTAMP '2023-04-19 07:00:00' END AS updated_at
FROM detected d"""

# CTE dependencies, in definition order.
_ORDER = ["baseline", "cur", "baseline_nulls", "cur_nulls", "registry", "live_columns", "registry_two", "live_columns_two", "state", "detected", "anomalies"]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the fixture views as CTEs."""
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in _ORDER)
    return f"WITH {ctes}\n{sql.strip()}"


def _value_sql(attr: str) -> str:
    return (
        f"SELECT o.config_id, o.table_name, o.column_name, o.{attr} AS {attr}_old, n.{attr} AS {attr}\n"
        f"FROM baseline o LEFT JOIN cur n ON {_JOIN}\nWHERE coalesce(o.{attr} <> n.{attr}, true)"
    )


_CURRENT_SNAPSHOT = """
SELECT DISTINCT r.config_id,
 concat(lower(split_part(r.table_name, ':', 1)), ':', lower(c.table_catalog), '.', lower(c.table_schema), '.', lower(c.table_name)) AS table_name,
 lower(c.column_name) AS column_name, lower(c.data_type) AS data_type, lower(c.is_nullable) AS is_nullable,
 coalesce(c.character_maximum_length, 0) AS character_maximum_length, cast(c.ordinal_position AS int) AS ordinal_position
FROM registry r JOIN live_columns c
 ON c.table_catalog = upper(split_part(split_part(r.table_name, ':', 2), '.', 1))
 AND c.table_schema = upper(split_part(split_part(r.table_name, ':', 2), '.', 2))
 AND c.table_name = upper(split_part(split_part(r.table_name, ':', 2), '.', 3))
WHERE r.check_type = 'schema'"""

_CAPTURE = """
SELECT r.config_id, lower(c.column_name) AS column_name, lower(c.data_type) AS data_type, lower(c.is_nullable) AS is_nullable,
 coalesce(c.character_maximum_length, 0) AS character_maximum_length, cast(c.ordinal_position AS int) AS ordinal_position
FROM registry r JOIN live_columns c
 ON c.table_catalog = split_part(split_part(r.table_name, ':', 2), '.', 1)
 AND upper(c.table_schema) = upper(split_part(split_part(r.table_name, ':', 2), '.', 2))
 AND c.table_name = split_part(split_part(r.table_name, ':', 2), '.', 3)
WHERE r.check_type = 'schema' AND r.updated_at > (SELECT updated_at FROM state WHERE check_type = 'schema')
 AND r.config_id NOT IN (SELECT config_id FROM baseline)"""

_REPORT_WHERE = (
    "a.anamoly_id = {rid} AND a.updated_at >= TIMESTAMP '2023-04-19 00:00:00' "
    "AND a.updated_at < TIMESTAMP '2023-04-20 00:00:00'"
)
_LINK = "'https://example.com/review'"


def _report_sql(rid: int, value_col: str | None, with_attr: bool = True) -> str:
    cols = ["r.table_name AS Data_Source"]
    if with_attr:
        cols.append("a.column_name AS Attributes")
    if value_col:
        cols += [f"a.{value_col}_old AS Previous", f"a.{value_col} AS Current"]
    cols.append(f"{_LINK} AS validation")
    order = "1, 2" if with_attr else "1"
    return (
        f"SELECT {', '.join(cols)}\nFROM anomalies a JOIN registry r ON a.config_id = r.config_id\n"
        f"WHERE {_REPORT_WHERE.format(rid=rid)} ORDER BY {order}"
    )


QUERIES_SQL: dict[str, str] = {
    "value_change_datatype": _value_sql("data_type"),
    "value_change_length": _value_sql("character_maximum_length"),
    "value_change_is_null": _value_sql("is_nullable"),
    "value_change_ordinal": _value_sql("ordinal_position"),
    "value_change_nulls": f"""
SELECT o.config_id, o.column_name, o.data_type AS data_type_old, n.data_type AS data_type
FROM baseline_nulls o LEFT JOIN cur_nulls n ON {_JOIN}
WHERE coalesce(o.data_type <> n.data_type, true)""",
    "value_change_strict": f"""
SELECT o.config_id, o.column_name, o.data_type AS data_type_old, n.data_type AS data_type
FROM baseline_nulls o JOIN cur_nulls n ON {_JOIN}
WHERE o.data_type IS DISTINCT FROM n.data_type""",
    "new_column": f"""
SELECT n.config_id, n.table_name, n.column_name FROM cur n
WHERE NOT EXISTS (SELECT 1 FROM baseline o WHERE {_JOIN})""",
    "missing_column": f"""
SELECT o.config_id, o.table_name, o.column_name FROM baseline o
WHERE NOT EXISTS (SELECT 1 FROM cur n WHERE {_JOIN})""",
    "table_miss": """
SELECT o.config_id, o.table_name FROM baseline o
WHERE NOT EXISTS (SELECT 1 FROM cur n WHERE o.config_id = n.config_id AND o.table_name = n.table_name)""",
    "table_miss_distinct": "SELECT DISTINCT config_id, table_name FROM detected WHERE anamoly_id = 6",
    "schema_diff_status": f"""
SELECT coalesce(o.config_id, n.config_id) AS config_id, coalesce(o.column_name, n.column_name) AS column_name,
 CASE WHEN o.config_id IS NULL THEN 'right_only' WHEN n.config_id IS NULL THEN 'left_only' ELSE 'both' END AS status
FROM baseline o FULL OUTER JOIN cur n ON {_JOIN}""",
    "registry_parsed": """
SELECT config_id, lower(split_part(table_name, ':', 1)) AS source,
 lower(split_part(split_part(table_name, ':', 2), '.', 1)) AS catalog_name,
 lower(split_part(split_part(table_name, ':', 2), '.', 2)) AS schema_name,
 lower(split_part(split_part(table_name, ':', 2), '.', 3)) AS tbl_name
FROM registry WHERE check_type = 'schema'""",
    "due_entries": """
SELECT config_id, cast(is_deleted AS string) AS is_deleted FROM registry
WHERE check_type = 'schema' AND updated_at > (SELECT updated_at FROM state WHERE check_type = 'schema')
 AND config_id NOT IN (SELECT DISTINCT config_id FROM baseline)""",
    "due_entries_null_aware": """
SELECT config_id FROM registry WHERE check_type = 'schema'
 AND config_id NOT IN (SELECT CASE WHEN config_id % 1000 = 7 THEN NULL ELSE config_id END FROM baseline)""",
    "due_entries_null_left": """
SELECT config_id, check_type FROM (SELECT CASE WHEN config_id % 7 <> 0 THEN config_id END AS config_id, check_type FROM registry)
WHERE config_id NOT IN (SELECT config_id FROM baseline WHERE config_id % 3 = 0)""",
    "current_snapshot": _CURRENT_SNAPSHOT,
    # per-connector case rule: one folds to upper, the other to lower
    "current_snapshot_case": """
SELECT DISTINCT r.config_id,
 concat(c.source, ':', lower(c.table_catalog), '.', lower(c.table_schema), '.', lower(c.table_name)) AS table_name,
 lower(c.column_name) AS column_name, lower(c.data_type) AS data_type, lower(c.is_nullable) AS is_nullable,
 coalesce(c.character_maximum_length, 0) AS character_maximum_length, cast(c.ordinal_position AS int) AS ordinal_position
FROM registry_two r JOIN live_columns_two c ON c.source = lower(split_part(r.table_name, ':', 1))
 AND concat(c.table_catalog, '.', c.table_schema, '.', c.table_name)
  = CASE c.source WHEN 'redshift_dev' THEN upper(split_part(r.table_name, ':', 2)) ELSE lower(split_part(r.table_name, ':', 2)) END
WHERE r.check_type = 'schema'""",
    "stored_snapshot": """
SELECT r.config_id, lower(b.table_name) AS table_name, b.column_name, b.data_type
FROM registry r JOIN baseline b ON lower(r.table_name) = lower(b.table_name) WHERE r.check_type = 'schema'""",
    "stored_snapshot_like": """
SELECT r.config_id, lower(b.table_name) AS table_name, b.column_name
FROM (SELECT config_id, replace(lower(table_name), '_1', '__') AS pattern FROM registry WHERE check_type = 'schema') r
JOIN baseline b ON b.table_name LIKE r.pattern""",
    "hwm_advance": """
SELECT s.check_type, CASE WHEN s.check_type = 'schema'
 THEN coalesce((SELECT max(updated_at) FROM registry WHERE check_type = 'schema'), s.updated_at)
 ELSE s.updated_at END AS updated_at
FROM state s""",
    "detect_all": "SELECT * FROM detected",
    "anomaly_rows": "SELECT * FROM anomalies",
    "report_missing_attributes": _report_sql(0, None),
    "report_new_attributes": _report_sql(1, None),
    "report_datatype_changes": _report_sql(2, "data_type"),
    "report_length_changes": _report_sql(3, "character_maximum_length"),
    "report_ordinal_position": _report_sql(4, "ordinal_position"),
    "report_nullable_changes": _report_sql(5, "is_nullable"),
    "report_missing_data_source": _report_sql(6, None, with_attr=False),
    "captured_configs": "SELECT DISTINCT config_id FROM baseline",
    "capture_baseline": _CAPTURE,
    "incremental_capture": f"""
SELECT config_id, column_name, data_type, is_nullable, character_maximum_length, ordinal_position FROM baseline
UNION ALL
{_CAPTURE.strip()}""",
}

# The detected view's text over other relations: the captured rows under their
# registered names, and the live metadata.
_OF_CAPTURED = VIEWS["detected"].replace("baseline o", "stored o").replace("cur n", "live n")
QUERIES_SQL["detect_captured"] = f"""
SELECT * FROM (WITH after AS ({QUERIES_SQL["incremental_capture"]}),
named AS (SELECT a.*, r.table_name FROM after a JOIN registry r ON a.config_id = r.config_id WHERE r.check_type = 'schema'),
stored AS (SELECT r.config_id, lower(v.table_name) AS table_name, v.column_name, v.data_type, v.ordinal_position, v.is_nullable,
  coalesce(v.character_maximum_length, 0) AS character_maximum_length
 FROM registry r JOIN named v ON lower(r.table_name) = lower(v.table_name) WHERE r.check_type = 'schema'),
live AS ({_CURRENT_SNAPSHOT})
{_OF_CAPTURED})"""


def oracle_sql() -> dict[str, str]:
    return {k: with_views(v) for k, v in QUERIES_SQL.items()}
