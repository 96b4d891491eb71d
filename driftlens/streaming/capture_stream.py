"""Incremental capture as a Structured Streaming query.

New registry entries arrive as files in a directory. The file source's
checkpoint records which files were processed, which replaces the
high-water mark: an entry is picked up whatever its ``updated_at``, and ties or
late inserts are never lost.

An entry may be registered before its table exists. Entries are held in keyed
state from their arrival until they are captured: each is due at once and, on
a timer, again and again until a live table is there. Captured ids come back to
the query as a second stream (files that each micro-batch writes after its
commit) and clear the state, also after a restart.

Each micro-batch captures the live columns of its due entries and publishes
them in the store under a run key of its own, so that a replayed batch changes
nothing; the baseline's ids are a second guard.

Run with ``trigger(availableNow=True)`` from a scheduler (a timer that has run
out fires in the next start), or continuously.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from driftlens.operators.quarantine import BASELINE_KEYS, ENTRY_KEYS, REJECTED, accepted, mark
from driftlens.operators.registry import parse_registry
from driftlens.sinks.store import Store
from driftlens.sources.live import LiveMetadata
from driftlens.types import BASELINE, REGISTRY

#: How long an entry without a live table waits before it is tried again.
RETRY_MS = 20 * 60 * 1000

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_FEED = T.StructType([T.StructField("config_id", T.LongType())])
_HELD = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("check_type", T.StringType()), T.StructField("updated_at", T.TimestampType())])
_DUE = T.StructType([T.StructField("config_id", T.LongType()), *_HELD.fields])


def _due(config_id: int, held) -> Row:
    return Row(**dict(zip(_DUE.fieldNames(), (config_id, *held))))


class Waiting(StatefulProcessor):
    """One entry, from its arrival until it is captured."""

    def __init__(self, retry_ms: int):
        self.retry_ms = retry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _HELD)
        self.captured = handle.getValueState("captured", T.StructType([T.StructField("done", T.BooleanType())]))

    def _wait(self, now: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(now + self.retry_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # a batch may hold several versions of an entry: the latest is captured
        latest, arrived, done = (self.entry.get() if self.entry.exists() else None), False, self.captured.exists()
        for r in rows:
            if r["captured"]:
                done = True
                continue
            new = (r["table_name"], r["check_type"], r["updated_at"])
            if latest is None or (new[2] is not None, new[2], new[0] or "") >= (latest[2] is not None, latest[2], latest[0] or ""):
                latest, arrived = new, True
        if done:
            self.captured.update((True,))
            self.entry.clear()
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        elif arrived:
            self.entry.update(latest)
            self._wait(timerValues.getCurrentProcessingTimeInMs())
            yield _due(key[0], latest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.entry.exists():
            held = self.entry.get()
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms)
            yield _due(key[0], held)

    def close(self) -> None:
        pass


def due_entries_stream(entries: DataFrame, captured: DataFrame, retry_ms: int = RETRY_MS) -> DataFrame:
    """Entries that are to be tried now: newly registered ones, and those held
    without a live table whose timer has run out. ``entries`` without an id
    have no key and are to be split off before."""
    utc = F.col("updated_at").cast("timestamp")
    arriving = entries.select("config_id", "table_name", "check_type", utc.alias("updated_at"), F.lit(False).alias("captured"))
    finished = captured.select("config_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _HELD.fields], F.lit(True).alias("captured"))
    return arriving.unionByName(finished).groupBy("config_id").transformWithState(
        statefulProcessor=Waiting(retry_ms), outputStructType=_DUE, outputMode="Append", timeMode="ProcessingTime"
    )


def start_capture_stream(
    spark: SparkSession,
    registry_dir: str,
    live_columns: Callable[[], DataFrame | LiveMetadata] | DataFrame | LiveMetadata,
    store: Store,
    checkpoint_path: str,
    check_type: str = "schema",
    case: str | Mapping[str, str] = "exact",
    source_case: Mapping[str, str] | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    retry_ms: int = RETRY_MS,
    trigger: str = "20 minutes",
) -> StreamingQuery:
    """Start the stream; the store and ``checkpoint_path`` must be on shared
    storage. ``case`` and ``source_case`` hold for live columns that do not
    bring their own. Entries without an id or a name go to the store's
    ``rejected`` table with each batch that brings them."""
    feed = f"{store.path}/captured_feed"
    spark.createDataFrame([], _FEED).write.mode("append").parquet(feed)  # the folder must be there to be watched
    reader = spark.readStream.schema(REGISTRY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    entries = reader.parquet(registry_dir).where(F.col("check_type") == check_type)
    due = due_entries_stream(entries.where("config_id is not null"), spark.readStream.schema(_FEED).parquet(feed), retry_ms)
    # entries without an id have no key to wait under: they pass the state by, to be set aside
    keyless = entries.where("config_id is null").select("config_id", "table_name", "check_type", F.col("updated_at").cast("timestamp").alias("updated_at"))
    query_id = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint_path).hex
    names = [f.name for f in BASELINE.fields]

    def live() -> LiveMetadata:
        found = live_columns() if callable(live_columns) else live_columns
        return found if isinstance(found, LiveMetadata) else LiveMetadata(found, case, source_case)

    def capture_batch(batch: DataFrame, epoch_id: int) -> None:
        run = store.begin(f"stream-{query_id}-{epoch_id}")
        if run.done is None:
            ids = run.read("baseline", BASELINE).select("config_id").where("config_id is not null").distinct()
            rows = batch.withColumn("is_deleted", F.lit(None).cast("boolean")).join(ids, "config_id", "left_anti")
            entries, folder, seen = run.write("due", mark(parse_registry(rows, check_type, lower_all=False), ENTRY_KEYS), by=REJECTED, rejected=F.count_if(REJECTED))
            counts = {"due": seen["rows"] - seen["rejected"], "captured": 0, "rejected": seen["rejected"]}
            if seen["rejected"]:
                run.append("rejected", f"{folder}/{REJECTED}=true")
            if counts["due"]:
                _, folder, seen = run.write("baseline", mark(live().capture(accepted(entries)).select(*names), BASELINE_KEYS), by=REJECTED, rejected=F.count_if(REJECTED))
                counts["captured"] = seen["rows"] - seen["rejected"]
                counts["rejected"] += seen["rejected"]
                if counts["captured"]:
                    run.append("baseline", f"{folder}/{REJECTED}=false")
                if seen["rejected"]:
                    run.append("rejected", f"{folder}/{REJECTED}=true")
            if any(counts.values()):
                run.publish(counts)
        # told to the state only after the commit; a replay tells it again, which changes nothing
        done = store.read("baseline", BASELINE).select("config_id").distinct()
        told = batch.select("config_id").where("config_id is not null").distinct().join(done, "config_id", "left_semi")
        if not told.isEmpty():
            told.write.mode("append").parquet(feed)

    # RocksDB is what the state API needs. Batches without data let timers run
    # out while the query goes on; with availableNow they would never end, and
    # the file that each start adds to the feed brings one batch anyhow. The
    # query keeps these settings, the session does not.
    own = {_PROVIDER: _ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": str(not available_now).lower()}
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        writer = due.unionByName(keyless).writeStream.foreachBatch(capture_batch).option("checkpointLocation", checkpoint_path)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def registry_file_batch(registry: DataFrame) -> DataFrame:
    """Registry rows in the stream's file layout (for writing new entry files)."""
    return registry.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REGISTRY.fields])
