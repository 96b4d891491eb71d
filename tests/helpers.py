"""Small-row builders for unit tests."""

from collections import Counter

from driftlens.types import SNAPSHOT


def snap(spark, rows):
    """Snapshot rows: (config_id, table, column, data_type, is_nullable, length, ordinal)."""
    return spark.createDataFrame(rows, SNAPSHOT)


def bag(df, cols=None):
    cols = cols or sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
