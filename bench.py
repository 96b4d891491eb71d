"""Benchmark: the registered queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed to completion into Spark's ``noop`` sink (no driver
collect). ``detect_all``, the flagship, runs three times and reports the
median; every other query runs once after a warm-up. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from driftlens.plans.fixture_queries import QUERIES  # noqa: E402
from driftlens.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FLAGSHIP = "detect_all"


def _sf(path: str) -> float | str:
    name = Path(path).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def run(spark, name: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS), app="driftlens-bench")
    only = sys.argv[1:]
    names = only or list(QUERIES)
    run(spark, FLAGSHIP)  # warm-up: JIT, class loading, file listing
    times = {}
    for n in names:
        if n == FLAGSHIP:
            times[n] = round(statistics.median(run(spark, n) for _ in range(3)), 3)
        else:
            times[n] = round(run(spark, n), 3)
    value = times.get(FLAGSHIP, sum(times.values()))
    print(
        json.dumps(
            {
                "metric": f"{FLAGSHIP}_median_sec" if FLAGSHIP in times else "total_sec",
                "value": value,
                "unit": "sec",
                "queries": times,
                "total_sec": round(sum(times.values()), 3),
                "sf": _sf(SF_DIR),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
