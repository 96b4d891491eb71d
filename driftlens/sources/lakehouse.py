"""Column metadata of lakehouse tables in information_schema.columns layout.

The original's lakehouse branch ran SQL through Spark. Where a catalog has an
information_schema, so does this: one distributed query, restricted to the
registered tables. Otherwise the layout is made of the tables' own schemas:

* tables that are folders of Parquet files (the connector's ``location``
  option, ``s3a://lake/{catalog}/{schema}/{table}``): Spark tasks read the
  footers, a group of tables each;
* tables of a Spark catalog without an information_schema: the catalog's client
  is on the driver and nowhere else, so the registered tables are looked up
  there, several at a time, and handed on in portions.

Type names follow the SQL names an information_schema reports for the same
Parquet data; ``varchar(n)`` and ``char(n)`` give their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftlens.functions.names import fold
from driftlens.sources.arrow_fs import filesystem
from driftlens.sources.connectors import Connector
from driftlens.types import LIVE_COLUMNS

#: Tables looked up in a driver-side catalog at a time, and per portion.
LOOKUPS, PORTION = 16, 1_000
#: Names given in an error about tables that were not found.
NAMED = 20

# Spark type -> SQL type name as information_schema shows it.
SIMPLE_TYPES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT",
    T.StringType: "VARCHAR",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.BinaryType: "BLOB",
}


def sql_type_name(dt: T.DataType) -> str:
    for cls, name in SIMPLE_TYPES.items():
        if isinstance(dt, cls):
            return name
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return f"{sql_type_name(dt.elementType)}[]"
    if isinstance(dt, T.MapType):
        return f"MAP({sql_type_name(dt.keyType)}, {sql_type_name(dt.valueType)})"
    if isinstance(dt, T.StructType):
        inner = ", ".join(f"{f.name} {sql_type_name(f.dataType)}" for f in dt.fields)
        return f"STRUCT({inner})"
    return dt.simpleString().upper()


def _column(f: T.StructField) -> tuple[str, int | None]:
    """Type name and length; Spark keeps varchar(n) and char(n) beside the type."""
    raw = re.fullmatch(r"(var)?char\((\d+)\)", (f.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", ""))
    return ("VARCHAR" if raw[1] else "CHAR", int(raw[2])) if raw else (sql_type_name(f.dataType), None)


def schema_rows(catalog: str | None, schema: str | None, table: str, st: T.StructType) -> list[tuple]:
    """One information_schema.columns row per column."""
    rows = []
    for pos, f in enumerate(st.fields, start=1):
        name, length = _column(f)
        rows.append((catalog, schema, table, f.name, name, "YES" if f.nullable else "NO", length, str(pos)))
    return rows


def snapshot_from_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame | T.StructType], catalog: str = "spark_catalog", schema: str = "main"
) -> DataFrame:
    """information_schema.columns rows for the given tables (name -> DataFrame or schema)."""
    rows = []
    for name, t in tables.items():
        rows += schema_rows(catalog, schema, name, t if isinstance(t, T.StructType) else t.schema)
    return spark.createDataFrame(rows, LIVE_COLUMNS)


def _footer_schema(location: str) -> T.StructType | None:
    """Schema of a folder of Parquet files: its newest file's, as Spark wrote it
    into the footer or else as Parquet has it, and the folder's partition
    columns behind it. None if there is no such file."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    system, place = filesystem(location)
    found = system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
    files = [f for f in found if f.is_file and f.size and not re.search(r"/[_.][^/=]*$", f.path[len(place) :])]
    if not files:
        return None
    newest = max(files, key=lambda f: (f.mtime_ns or 0, f.path))
    arrow = pq.read_schema(newest.path, filesystem=system)
    spark_json = (arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    st = T._parse_datatype_json_string(spark_json.decode()) if spark_json else from_arrow_schema(arrow.remove_metadata())
    for part in re.findall(r"/([^/=]+)=([^/]*)(?=/)", newest.path[len(place) :]):
        st = T.StructType([*st.fields, T.StructField(part[0], T.IntegerType() if re.fullmatch(r"-?\d{1,9}", part[1]) else T.StringType())])
    return st


def footer_columns(tables: DataFrame) -> DataFrame:
    """Columns of (table_catalog, table_schema, table_name, location) rows, read
    in tasks; a location without files gives one row without a column name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in LIVE_COLUMNS.fields]
        kinds = [pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string() for f in LIVE_COLUMNS.fields]
        for batch in batches:
            rows = []
            for catalog, schema, table, location in zip(*(c.to_pylist() for c in batch.columns)):
                st = _footer_schema(location)
                rows += schema_rows(catalog, schema, table, st) if st else [(catalog, schema, table, *[None] * 5)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    tasks = int(tables.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tables.select("table_catalog", "table_schema", "table_name", "location").repartition(tasks, "location")
    return dealt.mapInArrow(run, LIVE_COLUMNS)


def catalog_columns(tables: DataFrame) -> DataFrame:
    """Columns of tables of a Spark catalog, looked up on the driver, where the
    catalog's client is; a table that is not there gives one row without a
    column name."""
    spark = tables.sparkSession

    def look(row) -> list[tuple]:
        catalog, schema, table = row["table_catalog"], row["table_schema"], row["table_name"]
        try:
            st = spark.table(".".join("`" + p.replace("`", "``") + "`" for p in (catalog, schema, table))).schema
        except AnalysisException as e:
            if e.getCondition() not in ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
                raise
            return [(catalog, schema, table, *[None] * 5)]
        return schema_rows(catalog, schema, table, st)

    portions, rows, seen = [], [], 0
    with ThreadPoolExecutor(LOOKUPS) as pool:
        for found in pool.map(look, tables.select("table_catalog", "table_schema", "table_name").toLocalIterator()):
            rows += found
            seen += 1
            if seen % PORTION == 0:
                portions.append(spark.createDataFrame(rows, LIVE_COLUMNS))
                rows = []
    portions.append(spark.createDataFrame(rows, LIVE_COLUMNS))
    return reduce(DataFrame.unionByName, portions)


def lakehouse_columns(spark: SparkSession, tables: DataFrame, conn: Connector, case: str | None = None, missing: str = "raise") -> DataFrame:
    """information_schema.columns rows of the registered ``tables``
    (catalog_name, schema_name, tbl_name) of one lakehouse connector.

    Names are folded by ``case`` (the connector's) before they are looked up. A
    registered table that is not there raises; with ``missing="drop"`` it just
    has no columns, which detection reports as a dropped table.
    """
    if missing not in ("raise", "drop"):
        raise ValueError(f"missing must be 'raise' or 'drop', got {missing!r}")
    case = case or conn.identifier_case
    wanted = tables.select(
        fold(F.col("catalog_name"), case).alias("table_catalog"), fold(F.col("schema_name"), case).alias("table_schema"), fold(F.col("tbl_name"), case).alias("table_name")
    ).distinct()
    template = conn.options.get("location")
    if template:
        place = reduce(lambda c, p: F.replace(c, F.lit("{" + p[0] + "}"), F.coalesce(F.col(p[1]), F.lit(""))), (("catalog", "table_catalog"), ("schema", "table_schema"), ("table", "table_name")), F.lit(template))
        found = footer_columns(wanted.withColumn("location", place))
    else:
        catalogs = [r[0] for r in wanted.select("table_catalog").distinct().collect()]
        parts = []
        for catalog in catalogs:
            mine = wanted.where(F.col("table_catalog").eqNullSafe(F.lit(catalog)))
            info = f"`{str(catalog).replace('`', '``')}`.information_schema.columns"
            if _has(spark, info):
                # the registered tables first, so that one that is not there shows
                keys = ["table_schema", "table_name"]
                columns = spark.table(info).select(*[F.col(f.name).cast(f.dataType) for f in LIVE_COLUMNS.fields])
                parts.append(mine.join(columns.drop("table_catalog"), keys, "left").select(*[f.name for f in LIVE_COLUMNS.fields]))
            else:
                parts.append(catalog_columns(mine))
        found = reduce(DataFrame.unionByName, parts, spark.createDataFrame([], LIVE_COLUMNS))
    found = found.checkpoint()  # one consistent read; what is missing is counted on it
    if missing == "raise":
        gone = found.where("column_name is null")
        if names := [".".join(str(p) for p in r) for r in gone.select("table_catalog", "table_schema", "table_name").limit(NAMED).collect()]:
            raise ValueError(f"connector {conn.name!r}: {gone.count()} registered tables not found, among them {', '.join(names)}; missing='drop' reports them as dropped")
    return found.where("column_name is not null")


def _has(spark: SparkSession, table: str) -> bool:
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException:  # no such catalog: the look-up of its tables tells
        return False
