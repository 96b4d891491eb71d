"""Rows whose keys are missing are set aside with a reason.

One NULL ``config_id`` among the captured ids would make ``NOT IN`` select
nothing for ever after; one without a column name can match nothing. Such rows
are split off where they come in, in the pass that writes the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"
REJECTED = "rejected"

#: Columns that must be there, by what is taken in.
ENTRY_KEYS = ("config_id", "table_name")
BASELINE_KEYS = ("config_id", "column_name")


def mark(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``reject_reason`` (the first missing key, else NULL) and
    ``rejected``. No row is lost or doubled."""
    reason = F.coalesce(*[F.when(F.col(k).isNull(), F.lit(f"{k} is null")) for k in keys])
    return rows.withColumn(REASON, reason).withColumn(REJECTED, F.col(REASON).isNotNull())


def accepted(marked: DataFrame) -> DataFrame:
    return marked.where(~F.col(REJECTED)).drop(REASON, REJECTED)


def rejected(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REJECTED)).drop(REJECTED)
