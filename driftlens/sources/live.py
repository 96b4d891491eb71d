"""Live metadata together with the case rule it was read under.

Detection folds names by each connector's setting, capture compares them as
written. What is read from a source depends on that rule (it is in the query),
and so does how rows are matched to entries; held in one object the two cannot
differ.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from driftlens.operators.snapshot import capture, snapshot
from driftlens.sources.connectors import Connector, case_rules
from driftlens.sources.information_schema import read_live_columns


@dataclass(frozen=True)
class LiveMetadata:
    columns: DataFrame
    case: str | Mapping[str, str]
    source_case: Mapping[str, str] | None = None

    def snapshot(self, entries: DataFrame) -> DataFrame:
        """What detection compares (``entries``: all parts lowered)."""
        return snapshot(self.columns, entries, case=self.case, source_case=self.source_case)

    def capture(self, entries: DataFrame) -> DataFrame:
        """Baseline rows (``entries``: as registered)."""
        return capture(entries, self.columns, case=self.case, source_case=self.source_case)


def live_for_detection(spark: SparkSession, entries: DataFrame, connectors: Mapping[str, Connector], **options) -> LiveMetadata:
    """Live columns of the entries, read and matched by each connector's case."""
    return LiveMetadata(read_live_columns(spark, entries, connectors, **options), "lower", case_rules(connectors))


def live_for_capture(spark: SparkSession, entries: DataFrame, connectors: Mapping[str, Connector], **options) -> LiveMetadata:
    """Live columns of the entries, read and matched exactly as registered."""
    return LiveMetadata(read_live_columns(spark, entries, connectors, case="exact", **options), "exact")
