"""The versioned store, the capture job over it, quarantine and retries."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftlens.operators.quarantine import BASELINE_KEYS, accepted, mark, rejected
from driftlens.operators import quarantine
from driftlens.plans.capture import incremental_capture, run_capture
from driftlens.sinks.store import CommitConflict, Run, Store
from driftlens.sources import fixtures as fx
from driftlens.sources.live import LiveMetadata
from driftlens.types import BASELINE, LIVE_COLUMNS, PENDING, REGISTRY, REJECTED, STATE

from conftest import SF_SMALL
from helpers import bag

T0 = dt.datetime(2024, 1, 1)


def registry(spark, rows):
    """(config_id, name, days after T0)"""
    return spark.createDataFrame([(i, n, "schema", "u", True, False, T0 + dt.timedelta(days=d)) for i, n, d in rows], REGISTRY)


def live(spark, tables):
    """{table: columns}"""
    rows = [("c", "s", t, c, "int", "YES", None, str(i)) for t, cols in tables.items() for i, c in enumerate(cols, 1)]
    return LiveMetadata(spark.createDataFrame(rows, LIVE_COLUMNS), "exact")


def seeded(spark, path, hwm=None):
    store = Store(spark, path)
    run = store.begin("seed")
    state = spark.createDataFrame([("schema", hwm or T0)], STATE)
    run.replace("state", run.write("state", state)[1])
    run.publish({})
    return store


def captured(store):
    return sorted(((r.config_id, r.column_name) for r in store.read("baseline", BASELINE).collect()), key=str)


def hwm(store):
    return [r.updated_at for r in store.read("state", STATE).collect()]


REG = [(1, "x:c.s.t1", 1), (2, "x:c.s.t2", 2), (3, "x:c.s.gone", 3)]
TABLES = {"t1": ["a", "b"], "t2": ["a"]}
WANT = [(1, "a"), (1, "b"), (2, "a")]


def test_capture_publishes_baseline_and_state_together(spark, scratch):
    store = seeded(spark, scratch)
    out = run_capture(registry(spark, REG), live(spark, TABLES), store, "day 1/a")
    assert dict(out.counts) == {"due": 3, "captured": 3, "unmatched": 1, "rejected": 0} and not out.replayed
    assert captured(store) == WANT and hwm(store) == [T0 + dt.timedelta(days=3)]
    assert [r.config_id for r in store.read("pending", PENDING).collect()] == [3]
    again = run_capture(registry(spark, REG), live(spark, TABLES), store, "day 1/a")
    assert again.replayed and again.counts == out.counts and captured(store) == WANT


def test_a_run_that_stops_anywhere_is_run_again(spark, scratch, monkeypatch):
    """Stops behind each write and behind the commit, then runs again."""

    class Stop(Exception):
        pass

    steps = {"n": 0, "stop": None}

    def counting(original):
        def call(self, *a, **k):
            out = original(self, *a, **k)
            steps["n"] += 1
            if steps["n"] == steps["stop"]:
                raise Stop
            return out

        return call

    monkeypatch.setattr(Run, "write", counting(Run.write))
    monkeypatch.setattr(Run, "publish", counting(Run.publish))
    reg, source = registry(spark, REG), live(spark, TABLES)
    stop, stopped = 0, 0
    while True:
        stop += 1
        steps.update(n=0, stop=None)
        store = seeded(spark, f"{scratch}/{stop}")
        before = store.latest()
        steps.update(n=0, stop=stop)
        try:
            run_capture(reg, source, store, "a")
        except Stop:
            stopped += 1
            if stop < 6:  # all but a stop behind the commit itself
                assert store.latest() == before and captured(store) == [] and hwm(store) == [T0]
            steps.update(stop=None)
            run_capture(reg, source, store, "a")
        else:
            break
        assert captured(store) == WANT and hwm(store) == [T0 + dt.timedelta(days=3)]
    assert stopped == 6  # five writes and the commit


def test_two_runs_from_one_version_do_not_both_publish(spark, scratch):
    store = seeded(spark, scratch)
    first, second = store.begin("a"), store.begin("b")
    first.append("baseline", first.write("baseline", spark.createDataFrame([(1, "a", "int", "yes", 0, 1)], BASELINE))[1])
    first.publish({"captured": 1})
    with pytest.raises(CommitConflict):
        second.publish({})
    assert store.latest().version == 1 and "b" not in store.latest().runs
    assert not [n for n in store.files.names(f"{scratch}/_commits") if n.endswith(".tmp")]


def test_compact_and_vacuum_keep_the_rows(spark, scratch):
    store = seeded(spark, scratch)
    for i in range(3):
        run = store.begin(f"r{i}")
        run.append("baseline", run.write("baseline", spark.createDataFrame([(i, "a", "int", "yes", 0, 1)], BASELINE))[1])
        run.publish({"captured": 1})
    store.begin("stopped").write("baseline", spark.createDataFrame([(9, "a", "int", "yes", 0, 1)], BASELINE))
    store.compact("baseline", BASELINE, "compact")
    assert len(store.latest().tables["baseline"]) == 1
    assert store.vacuum() == 4
    assert captured(store) == [(0, "a"), (1, "a"), (2, "a")] and hwm(store) == [T0] and store.latest().runs["r1"] == {"captured": 1}


def test_an_empty_run_writes_no_baseline_and_says_so(spark, scratch):
    store = seeded(spark, scratch, hwm=T0 + dt.timedelta(days=9))

    def unread(due):
        raise AssertionError("no entry is due: nothing is to be read")

    out = run_capture(registry(spark, REG), unread, store, "a")
    assert dict(out.counts) == {"due": 0, "captured": 0, "unmatched": 0, "rejected": 0}
    assert "baseline" not in out.commit.tables
    # due, but no table is there: still no baseline file
    out = run_capture(registry(spark, [(5, "x:c.s.gone", 20)]), live(spark, TABLES), store, "b")
    assert dict(out.counts) == {"due": 1, "captured": 0, "unmatched": 1, "rejected": 0}
    assert "baseline" not in out.commit.tables
    runs = [n for n in store.files.names(f"{scratch}/runs") if n.startswith("b-")]
    assert "baseline" not in store.files.names(f"{scratch}/runs/{runs[0]}")


def test_pending_entries_are_captured_once_when_their_table_comes(spark, scratch):
    store = seeded(spark, scratch)
    reg = registry(spark, REG)
    run_capture(reg, live(spark, TABLES), store, "a")
    out = run_capture(reg, live(spark, TABLES), store, "b")
    assert out.counts["due"] == 1 and out.counts["unmatched"] == 1
    later = live(spark, {**TABLES, "gone": ["z"]})
    assert run_capture(reg, later, store, "c").counts["captured"] == 1
    assert run_capture(reg, later, store, "d").counts["due"] == 0
    assert captured(store) == [*WANT, (3, "z")]
    # an entry that left the registry is not waited for
    store2 = seeded(spark, f"{scratch}/2")
    run_capture(reg, live(spark, TABLES), store2, "a")
    assert run_capture(reg.where("config_id < 3"), live(spark, TABLES), store2, "b").counts["due"] == 0
    assert store2.read("pending", PENDING).count() == 0


def test_a_null_id_is_set_aside_and_stops_nothing(spark, scratch):
    store = seeded(spark, scratch)
    run = store.begin("legacy")  # a baseline that holds a NULL id already
    run.append("baseline", run.write("baseline", spark.createDataFrame([(None, "a", "int", "yes", 0, 1), (1, "a", "int", "yes", 0, 1)], BASELINE))[1])
    run.publish({})
    reg = registry(spark, [*REG, (None, "x:c.s.t1", 4), (7, None, 4)])
    source = live(spark, {"t1": ["a"], "t2": ["a", None]})
    out = run_capture(reg, source, store, "a")
    assert dict(out.counts) == {"due": 2, "captured": 1, "unmatched": 1, "rejected": 3}
    assert [r for r in captured(store) if r[0] == 2] == [(2, "a")]
    why = sorted((r.config_id or 0, r.reject_reason) for r in store.read("rejected", REJECTED).collect())
    assert why == [(0, "config_id is null"), (2, "column_name is null"), (7, "table_name is null")]


KEY = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(KEY, st.one_of(st.none(), st.sampled_from("ab"))), max_size=12))
def test_quarantine_splits_without_loss(spark, rows):
    df = spark.createDataFrame([(i, c, "int", "yes", 0, 1) for i, c in rows], BASELINE)
    marked = mark(df, BASELINE_KEYS)
    good, bad = accepted(marked), rejected(marked)
    whole = [r for r in rows if r[0] is not None and r[1] is not None]
    assert sorted((r.config_id, r.column_name) for r in good.collect()) == sorted(whole) and good.columns == df.columns
    assert sorted(r[quarantine.REASON] for r in bad.collect()) == sorted("config_id is null" if i is None else "column_name is null" for i, c in rows if i is None or c is None)


def test_job_equals_the_plan_on_the_fixture(spark, scratch):
    case = {"catalog": "exact", "schema": "fold", "table": "exact"}
    reg, cols = fx.registry(spark, SF_SMALL), fx.live_columns(spark, SF_SMALL)
    base = fx.baseline(spark, SF_SMALL).select(*[f.name for f in BASELINE.fields])
    plan = incremental_capture(reg, cols, base, fx.state(spark), case=case)
    store = Store(spark, scratch)
    run = store.begin("seed")
    run.append("baseline", run.write("baseline", base)[1])
    run.replace("state", run.write("state", fx.state(spark))[1])
    run.publish({})
    out = run_capture(reg, LiveMetadata(cols, case), store, "a")
    assert out.counts["captured"] == plan.captured.count() > 0 and out.counts["unmatched"] == plan.unmatched.count()
    assert bag(store.read("baseline", BASELINE)) == bag(plan.baseline_after)
    assert bag(store.read("state", STATE)) == bag(plan.state_after)
    assert run_capture(reg, LiveMetadata(cols, case), store, "b").counts["captured"] == 0
    assert reg.agg(F.count("*")).first()[0] > 0
