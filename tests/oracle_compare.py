"""Run a registered Spark query and its DuckDB oracle and compare the results.

Usable from pytest and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_cols, s_bag = _bag(df.columns, s_rows)
    cur = con.execute(sql)
    d_cols_raw = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    d_cols, d_bag = _bag(d_cols_raw, d_rows)
    res = {
        "query": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": s_cols == d_cols,
        "values_match": s_bag == d_bag,
        "spark_s": round(t1 - t0, 2),
        "oracle_s": round(t2 - t1, 2),
    }
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    elif not res["values_match"]:
        res["only_spark"] = list((s_bag - d_bag).items())[:3]
        res["only_oracle"] = list((d_bag - s_bag).items())[:3]
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from driftlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session()
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in o:
            print({"query": n, "oracle": "none"})
            continue
        r = compare(spark, con, n, q[n], o[n], sf_dir)
        ok = r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
