"""JDBC reads and appends that stay DataFrames (never ``toPandas``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from driftlens.sources.connectors import Connector


def read_query(spark: SparkSession, conn: Connector, query: str, fetchsize: int = 10_000) -> DataFrame:
    """One query pushed to the database as written (single partition)."""
    return (
        spark.read.format("jdbc")
        .options(**conn.jdbc_options())
        .option("query", query)
        .option("fetchsize", str(fetchsize))
        .load()
    )


def read_partitioned(
    spark: SparkSession, conn: Connector, relation: str, predicates: Sequence[str], fetchsize: int = 10_000
) -> DataFrame:
    """``relation`` (a table or a parenthesised, aliased subquery) read in one
    partition per predicate, in parallel over several connections."""
    opts = conn.jdbc_options()
    props = {k: v for k, v in opts.items() if k != "url"}
    props["fetchsize"] = str(fetchsize)
    return spark.read.jdbc(opts["url"], relation, predicates=list(predicates), properties=props)


def read_table(spark: SparkSession, conn: Connector, table: str) -> DataFrame:
    """A whole table; filters and projections applied later are pushed down."""
    return spark.read.format("jdbc").options(**conn.jdbc_options()).option("dbtable", table).load()


def append(
    df: DataFrame, conn: Connector, table: str, batchsize: int = 10_000, create_column_types: str | None = None, mode: str = "append"
) -> None:
    """Append rows to a table, one connection per partition; ``mode="overwrite"``
    replaces it.

    ``create_column_types`` sets column types should the table be created.
    """
    w = df.write.format("jdbc").options(**conn.jdbc_options()).option("dbtable", table).option("batchsize", str(batchsize))
    if create_column_types:
        w = w.option("createTableColumnTypes", create_column_types)
    w.mode(mode).save()


def sql_literal(value: str) -> str:
    """A quoted SQL string literal (single quotes doubled)."""
    return "'" + str(value).replace("'", "''") + "'"


def sql_identifier(name: str) -> str:
    """A quoted SQL identifier (double quotes doubled)."""
    return '"' + str(name).replace('"', '""') + '"'
