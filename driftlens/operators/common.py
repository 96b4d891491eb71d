"""Plan-shaping helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, col: str, sub: DataFrame) -> DataFrame:
    """``df WHERE col NOT IN (SELECT k FROM sub)`` with SQL's NULL rules.

    * empty subquery: every row is kept, NULL keys too;
    * a NULL in the subquery: no row is kept;
    * otherwise rows with a non-NULL key and no match.

    The NULL cases come from two counts over the key set, which the optimizer
    merges into one aggregate; the match is an ordinary anti equi-join on the de-duplicated keys, so it
    shuffles (or broadcasts, if AQE finds it small) instead of falling back to
    a nested loop when the key set is too large to broadcast.
    """
    keys = sub.toDF("_not_in_key")
    total, known = keys.agg(F.count(F.lit(1))).scalar(), keys.agg(F.count("_not_in_key")).scalar()
    keep = (total == 0) | (F.col(col).isNotNull() & (total == known))
    distinct_keys = keys.where(F.col("_not_in_key").isNotNull()).distinct()
    return (
        df.where(keep)
        .join(distinct_keys, F.col(col) == F.col("_not_in_key"), "left_anti")
    )
