"""Vector codes against a plain k-means over all points."""

import hashlib

import numpy as np
import pytest

from driftlens.llm import codes


def nearest(points, entries):
    d = ((points[:, None, :].astype(object) - entries[None, :, :]) ** 2).sum(-1)
    best = d.argmin(axis=1)  # ties to the lower index
    return best, d[np.arange(len(points)), best]


@pytest.mark.parametrize("seed", range(12))
def test_tree_owns_as_plain_search(seed):
    rng = np.random.default_rng(seed)
    n, size, spread = int(rng.integers(1, 900)), int(rng.choice([1, 2, 5, 16])), int(rng.choice([2, 40, 2000, 1 << 23]))
    points = rng.integers(-spread, spread, (n, size))
    if seed % 3 == 0:
        points[rng.random(n) < 0.5] = points[0]
    entries = points[rng.integers(0, n, int(rng.integers(1, 90)))] + rng.integers(-1, 2, (1, size))
    tree = codes.Tree(points)
    entry, error = codes.assign(tree, entries)
    best, least = nearest(points, entries)
    assert (entry == best).all() and (error == least).all()
    count, total = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    codes.sums(tree, entries, count, total)
    assert (count == np.bincount(best, minlength=len(entries))).all()
    assert all((total[j] == points[best == j].sum(axis=0)).all() for j in range(len(entries)))


def test_tree_balls_hold_their_points():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-5, 5, (400, 3)) + 1000 * rng.integers(-2, 3, (400, 1)), np.zeros((100, 3), int)])
    tree = codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for b in range(len(tree.left)):
        inside = tree.points[tree.lo[b] : tree.hi[b]]
        assert (tree.total[b] == inside.sum(axis=0)).all()
        assert np.sqrt(((inside - tree.pivot[b]) ** 2).sum(axis=1)).max() <= tree.radius[b] + 1e-6
    # far clusters are owned whole: few points are looked at
    middles = np.array([[c] * 3 for c in (-2000, -1000, 0, 1000, 2000)])
    assert all(ball >= 0 for *_, ball in codes.owners(tree, middles))


def plain(rows):
    """vec_id, label, list rows to the contract's result."""
    rows = sorted(((v, lab, np.floor(np.array(x, np.float64) * 1024).astype(np.int64)) for v, lab, x in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    parts = np.stack(np.split(np.array([r[2] for r in rows]), 4, axis=1))
    book = parts[:, :256].copy()
    for _ in range(4):
        for k in range(4):
            best, _ = nearest(parts[k], book[k])
            for j in set(best.tolist()):
                book[k, j] = parts[k][best == j].sum(axis=0) // (best == j).sum()
    found = [nearest(parts[k], book[k]) for k in range(4)]
    error = sum(e for _, e in found)
    of_label = {}
    for (_, lab, _), e in zip(rows, error):
        of_label[lab] = of_label.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for x in book.ravel()).encode()).hexdigest()
    return sorted((r[0] if r[0] is not None else -1, "".join(f"{found[k][0][i]:02x}" for k in range(4)), int(error[i]), int(of_label[r[1]]), sha) for i, r in enumerate(rows))


def result(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_compress_is_plain_kmeans(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 64)
    rng = np.random.default_rng(3)
    rows = [(i * 3, int(rng.integers(0, 4)), rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, None, rows[0][2]) for i in range(5000, 5350)]  # a third of all rows are one vector under one label
    rows += [(9, 1, rows[1][2]), (9, 1, rows[1][2]), (None, 2, rows[2][2])]
    df = spark.createDataFrame([(v, x, lab) for v, lab, x in rows], SCHEMA).repartition(5).selectExpr("*", "'x' as code", "1 as error", "2 as v", "'y' as label_hash")
    assert result(codes.compress(df)) == plain(rows)


def test_compress_leaves_out_what_cannot_be_coded(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25, 0.0, 1.0], 0), (2, [0.5, -0.25, 0.0, 1.5], None), (4, [-7.0, 2.0, 0.001, -0.001], None)]
    bad = [(0, None, 1), (3, [], 1), (5, [0.1, None, 0.2, 0.3], 1), (6, [nan, 0.0, 0.0, 0.0], 1), (7, [inf, 0.0, 0.0, 0.0], 1), (8, [0.0] * 3, 1), (9, [0.0] * 8, 1), (10, [1e9, 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(good + bad, SCHEMA)
    assert result(codes.compress(df)) == plain([(v, lab, x) for v, x, lab in good])
    assert all(r[2] == 0 for r in result(codes.compress(df)))  # each vector is an entry
    empty = codes.compress(df.where("vec_id is null"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
