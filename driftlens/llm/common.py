"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.session import ensure_checkpoint_dir

#: ASCII white space of the corpus contracts, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """A Parquet table in that folder, read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Hadoop's names of file systems that Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def filesystem(uri: str):
    """The Arrow file system of a Hadoop path, and the path in it. Called in
    tasks, which write files of their own format into the shared folder."""
    from pyarrow import fs

    if local := re.match(r"file:/+(.*)", uri):
        return fs.LocalFileSystem(), "/" + local[1]
    scheme, colon, rest = uri.partition("://")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


def words(text: Column) -> Column:
    """Runs of non-white-space, in order; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def values(batch, at: int, rows: int = 256):
    """The values of an Arrow column as Python objects, a few rows at a time."""
    column = batch.column(at)
    for start in range(0, len(column), rows):
        yield from column.slice(start, rows).to_pylist()


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), use)[0]
