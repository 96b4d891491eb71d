"""Writers: anomalies by run here, baseline and state in
:mod:`driftlens.sinks.store`, JDBC in :mod:`driftlens.sources.jdbc`.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_run(anomalies: DataFrame, path: str, run_date, run_key: str) -> int:
    """One run's anomalies as the partition (run_date, run_key) of the table;
    returns their number, observed while writing.

    Exactly that partition is replaced, also by a run that finds nothing, and
    runs with another key on the same day are left alone."""
    scope = f"{path}/run_date={run_date.isoformat()}/run_key={quote(run_key, safe='')}"
    seen = Observation(f"anomalies-{uuid.uuid4().hex}")
    anomalies.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(scope)
    return int(seen.get.get("rows") or 0)
