"""Plan shape: no Python in the hot path, no nested-loop or cartesian joins,
pushed-down scans, and a bounded number of exchanges in the detection diff."""

import pytest

from driftlens.plans.fixture_queries import QUERIES

from conftest import SF_SMALL


def _explain(df):
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_nested_loop(spark, name):
    p = _explain(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_detect_all_exchanges_and_pruned_scans(spark):
    p = _explain(QUERIES["detect_all"](spark, SF_SMALL))
    # fixture aggregations feeding one full outer join on the full key, and
    # the dropped tables at table level; no window, no second column-level join
    import re

    shuffles = re.findall(r"[+-] Exchange \(\d+\)", p)
    assert len(shuffles) <= 12, p
    assert "Window" not in p and p.count("Join type: FullOuter") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string,l_linestatus:string>" in p


def test_hwm_filter_reaches_the_registry_scan(spark):
    p = _explain(QUERIES["due_entries"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate,1998-01-01T00:00)]" in p, p
