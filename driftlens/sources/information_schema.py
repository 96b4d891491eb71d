"""Live column metadata from every registered source.

The original sent one information_schema query per registered table. Here
each (connector, catalog) is read once, restricted to what is registered, in
parallel partitions; the result is matched to all entries by one join
(:mod:`driftlens.sources.live`).

* A schema with few registered tables is read by lists of their names: ten of
  a million tables read ten.
* A schema with many is read in ranges of table names. The split points are
  every so-many-th name of the source itself, ranked in the source's own order,
  so ranges are even, and two comparisons a range are enough: whatever the
  collation, ``p < name AND name <= q`` over points in its order covers every
  row exactly once.

What reaches the driver: the registered (connector, catalog, schema) triples,
at most ``LIST_TABLES`` names of a schema, and one name per
``TABLES_PER_PARTITION`` tables of a large schema.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.sources.connectors import Connector, lookup
from driftlens.sources.jdbc import read_partitioned, read_query, sql_identifier, sql_literal
from driftlens.types import LIVE_COLUMNS

COLUMNS = [f.name for f in LIVE_COLUMNS.fields]
#: Registered tables up to which a schema is read by name.
LIST_TABLES = 1_000
#: Names per list, and so per JDBC partition.
NAMES_PER_PARTITION = 200
#: Tables per JDBC partition of a schema that is read in ranges.
TABLES_PER_PARTITION = 2_000


def _folded(value: str, case: str) -> str:
    return value.upper() if case in ("upper", "fold") else value.lower() if case == "lower" else value


def _lit(value: str, case: str) -> str:
    return sql_literal(_folded(value, case))


def _col(name: str, case: str) -> str:
    return f"upper({name})" if case == "fold" else name


def information_schema(view: str, catalog: str, case: str = "exact", qualified: bool = True) -> str:
    """The name of an information_schema view. The catalog comes from the
    registry: it is quoted, folded as the source folds unquoted names."""
    return f"{sql_identifier(_folded(catalog, case))}.information_schema.{view}" if qualified else f"information_schema.{view}"


def catalog_relation(catalog: str, case: str = "exact", qualified: bool = True) -> str:
    """The information_schema.columns relation as a subquery with fixed column names."""
    return f"(SELECT {', '.join(COLUMNS)} FROM {information_schema('columns', catalog, case, qualified)}) info_cols"


def list_predicates(schema: str, tables: Sequence[str], case: str, per_partition: int = NAMES_PER_PARTITION) -> list[str]:
    """``table_name IN (...)`` predicates of one schema, one per partition."""
    base = f"{_col('table_schema', case)} = {_lit(schema, case)}"
    names = sorted({_lit(t, case) for t in tables})
    return [f"{base} AND {_col('table_name', case)} IN ({', '.join(names[i : i + per_partition])})" for i in range(0, len(names), per_partition)]


def split_query(catalog: str, schema: str, case: str, source_case: str = "exact", per_partition: int = TABLES_PER_PARTITION, qualified: bool = True) -> str:
    """Every ``per_partition``-th table name of a schema with its rank, in the
    order that the source compares names by."""
    name = _col("table_name", case)
    return (
        f"SELECT table_name, name_rank FROM (SELECT {name} AS table_name, row_number() OVER (ORDER BY {name}) AS name_rank "
        f"FROM {information_schema('tables', catalog, source_case, qualified)} WHERE {_col('table_schema', case)} = {_lit(schema, case)}) ranked "
        f"WHERE mod(name_rank, {per_partition}) = 0"
    )


def range_predicates(schema: str, points: Sequence[str], case: str) -> list[str]:
    """Ranges of table names between points that are in the source's order:
    each row with a name is in exactly one."""
    base, name = f"{_col('table_schema', case)} = {_lit(schema, case)}", _col("table_name", case)
    lits = [sql_literal(p) for p in points]  # as the source gave them
    if not lits:
        return [base]
    between = [f"{base} AND {name} > {a} AND {name} <= {b}" for a, b in zip(lits, lits[1:])]
    return [f"{base} AND {name} <= {lits[0]}", *between, f"{base} AND {name} > {lits[-1]}"]


def registered_schemas(entries: DataFrame, list_tables: int = LIST_TABLES) -> dict[tuple[str, str], dict[str, list[str] | None]]:
    """(connector, catalog) -> {schema: registered names, or None where there
    are more than ``list_tables``}. Counts are a partial aggregation, and names
    of large schemas never leave the executors."""
    keys = ["source", "catalog_name", "schema_name"]
    tables = entries.select(*keys, "tbl_name").distinct()
    counts = tables.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    few = counts.where(F.col("_n") <= list_tables).select(*keys)
    on = [tables[k].eqNullSafe(few[k]) for k in keys]
    named = tables.join(few, on, "left_semi")
    rows = counts.select(*keys, (F.col("_n") > list_tables).alias("_large"), F.lit(None).cast("string").alias("tbl_name"))
    rows = rows.unionByName(named.withColumn("_large", F.lit(False))).collect()
    out: dict[tuple[str, str], dict[str, list[str] | None]] = defaultdict(dict)
    for r in sorted(rows, key=lambda r: (not r["_large"], r["tbl_name"] or "")):
        names = out[(r["source"], r["catalog_name"])].setdefault(r["schema_name"], None if r["_large"] else [])
        if r["tbl_name"] is not None and names is not None:
            names.append(r["tbl_name"])
    return dict(out)


def catalog_predicates(
    spark: SparkSession, conn: Connector, catalog: str, schemas: Mapping[str, list[str] | None], case: str, qualified: bool = True, tables_per_partition: int = TABLES_PER_PARTITION
) -> list[str]:
    """Read partitions of one catalog: names of sparsely registered schemas,
    ranges of the others, whose points are asked of the source."""
    preds = []
    for schema in sorted(schemas):
        if schemas[schema] is not None:
            preds += list_predicates(schema, schemas[schema], case)
        else:
            points = read_query(spark, conn, split_query(catalog, schema, case, conn.identifier_case, tables_per_partition, qualified)).collect()
            preds += range_predicates(schema, [r[0] for r in sorted(points, key=lambda r: r[1])], case)
    return preds


def read_live_columns(
    spark: SparkSession,
    entries: DataFrame,
    connectors: Mapping[str, Connector],
    qualified: bool = True,
    list_tables: int = LIST_TABLES,
    tables_per_partition: int = TABLES_PER_PARTITION,
    case: str | None = None,
    missing: str = "raise",
) -> DataFrame:
    """information_schema.columns of every registered (connector, catalog),
    tagged with ``source``; lakehouse connectors: see
    :mod:`driftlens.sources.lakehouse`, also for ``missing``.

    Names are folded by each connector's ``identifier_case``, as detection
    matches them; capture matches exactly and reads with ``case="exact"``. Use
    :mod:`driftlens.sources.live`, which keeps reading and matching together.
    """
    from driftlens.sources.lakehouse import lakehouse_columns

    parts = []
    by_source: dict[str, list] = defaultdict(list)
    for (source, catalog), schemas in sorted(registered_schemas(entries, list_tables).items(), key=lambda kv: [(x is None, x or "") for x in kv[0]]):
        by_source[source].append((catalog, schemas))
    for source, catalogs in by_source.items():
        conn = lookup(connectors, source)
        if not conn.is_jdbc:
            mine = entries.where(F.col("source") == F.lit(source)).select("catalog_name", "schema_name", "tbl_name")
            parts.append(lakehouse_columns(spark, mine, conn, case, missing).withColumn("source", F.lit(source)))
            continue
        for catalog, schemas in catalogs:
            preds = catalog_predicates(spark, conn, catalog, schemas, case or conn.identifier_case, qualified, tables_per_partition)
            df = read_partitioned(spark, conn, catalog_relation(catalog, conn.identifier_case, qualified), preds)
            parts.append(df.select(*[F.col(c).cast(LIVE_COLUMNS[c].dataType).alias(c) for c in COLUMNS]).withColumn("source", F.lit(source)))
    if not parts:
        return spark.createDataFrame([], LIVE_COLUMNS).withColumn("source", F.lit(None).cast("string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
