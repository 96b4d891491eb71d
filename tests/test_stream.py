"""Streaming capture: equal to batch capture, entries that wait for their
table, restarts and replayed batches."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from driftlens.plans.capture import incremental_capture
from driftlens.sinks.store import Run, Store
from driftlens.sources import fixtures as fx
from driftlens.sources.live import LiveMetadata
from driftlens.streaming.capture_stream import registry_file_batch, start_capture_stream
from driftlens.types import BASELINE, LIVE_COLUMNS, REGISTRY, REJECTED

from conftest import SF_SMALL
from helpers import bag

CASE = {"catalog": "exact", "schema": "fold", "table": "exact"}
T0 = dt.datetime(2024, 1, 1)


def entry(spark, *rows):
    return spark.createDataFrame([(i, n, "schema", "u", True, False, T0 + dt.timedelta(days=d)) for i, n, d in rows], REGISTRY)


def columns(spark, tables):
    return spark.createDataFrame([("c", "s", t, c, "int", "YES", None, str(i)) for t, cols in tables.items() for i, c in enumerate(cols, 1)], LIVE_COLUMNS)


def test_streaming_capture_equals_batch_capture(spark, scratch):
    reg = fx.registry(spark, SF_SMALL).where("config_id < 200")
    later = reg.where("config_id < 50").withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 day"))
    live, reg_dir, store = fx.live_columns(spark, SF_SMALL), f"{scratch}/registry", Store(spark, f"{scratch}/store")
    # two versions of some entries in one batch, then a second start with more
    for part in (reg.where("config_id < 100").unionByName(later), reg.where("config_id >= 100")):
        registry_file_batch(part).write.mode("append").parquet(reg_dir)
        q = start_capture_stream(spark, reg_dir, live, store, f"{scratch}/ckpt", case=CASE)
        assert q.awaitTermination(90)
    batch = incremental_capture(reg, live, spark.createDataFrame([], BASELINE), fx.state(spark).where("false"), case=CASE).captured
    assert bag(store.read("baseline", BASELINE)) == bag(batch)


def test_an_entry_waits_for_its_table_across_a_restart_and_is_captured_once(spark, scratch):
    store, reg_dir = Store(spark, f"{scratch}/store"), f"{scratch}/registry"
    tables = {"here": ["a", "b"]}
    registry_file_batch(entry(spark, (1, "x:c.s.here", 1), (2, "x:c.s.late", 1), (None, "x:c.s.here", 1))).coalesce(1).write.parquet(reg_dir)

    def run_until(done, seconds=60):
        q = start_capture_stream(spark, reg_dir, lambda: LiveMetadata(columns(spark, tables), "exact"), store, f"{scratch}/ckpt", available_now=False, retry_ms=1000, trigger="1 second")
        end = time.time() + seconds
        while time.time() < end and q.isActive and not done():
            time.sleep(1)
        q.stop()
        if q.exception():
            raise q.exception()
        assert done()

    def rows():
        return sorted((r.config_id, r.column_name) for r in store.read("baseline", BASELINE).collect())

    def tries():
        return sum(r.get("due", 0) for r in store.latest().runs.values())

    run_until(lambda: rows() == [(1, "a"), (1, "b")] and tries() >= 4)  # the late one is tried again and again
    tables["late"] = ["z"]
    run_until(lambda: (2, "z") in rows())  # restarted: still held
    assert rows() == [(1, "a"), (1, "b"), (2, "z")]
    assert [r.reject_reason for r in store.read("rejected", REJECTED).collect()] == ["config_id is null"]
    tried = tries()
    # nothing waits any more, and a table that grows is not captured again
    tables["late"] = ["z", "y"]
    q = start_capture_stream(spark, reg_dir, lambda: LiveMetadata(columns(spark, tables), "exact"), store, f"{scratch}/ckpt", available_now=False, retry_ms=1000, trigger="1 second")
    time.sleep(6)
    q.stop()
    assert rows() == [(1, "a"), (1, "b"), (2, "z")] and tries() == tried


@pytest.mark.parametrize("when", ["write", "publish"])
def test_a_batch_that_stopped_is_replayed_without_loss_or_doubles(spark, scratch, monkeypatch, when):
    store, reg_dir = Store(spark, f"{scratch}/store"), f"{scratch}/registry"
    registry_file_batch(entry(spark, (1, "x:c.s.here", 1))).write.parquet(reg_dir)
    original, left = getattr(Run, when), [1]

    def stopping(self, *a, **k):
        out = original(self, *a, **k)
        if left and left.pop():
            raise RuntimeError("stopped")
        return out

    monkeypatch.setattr(Run, when, stopping)
    start = lambda: start_capture_stream(spark, reg_dir, columns(spark, {"here": ["a"]}), store, f"{scratch}/ckpt")
    with pytest.raises(Exception, match="stopped"):
        start().awaitTermination(90)
    assert start().awaitTermination(90)
    assert [(r.config_id, r.column_name) for r in store.read("baseline", BASELINE).collect()] == [(1, "a")]
