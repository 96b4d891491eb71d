"""Operator 11: vectors as short codes, learnt over trees of balls.

A vector is cut into four parts, and each part is replaced by the number of the
nearest of 256 entries; the entries are moved to the middle of their parts a
few times (k-means in integers). The parts of a block of vectors are put into a
metric tree once, built from the middle out by the anchors hierarchy: a ball's
points are dealt to about sqrt(n) anchors, each new anchor taking from the
others what is nearer to it (the triangle inequality tells which points need no
look); anchors are merged in pairs that make the smallest ball, up to one root,
and are themselves split in the same way, down to leaves.

A ball holds the sum and the count of its points. A pass over a tree hands each
ball the list of entries that could be nearest to any point of its parent and
strikes those that are farther than the nearest by more than the ball's width.
A ball with one entry left is owned by it as a whole: its sum and count are
taken without a look at its points. Only leaves that are still shared compare
points with what is left of their list.

Trees are written once and read by every pass. A task hands on at most one
row an entry; the codebooks (1,024 entries, whatever the input) are all that
reaches the driver.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors a block: one tree a part.
BLOCK = 8192
#: Points a ball may hold without being split.
LEAF = 32
#: Largest scaled component; with it every squared distance fits a long.
LARGEST = 1 << 24

# ------------------------------------------------------------- the tree


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def anchors(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Deals points to about sqrt(n) anchors: the anchor of each, and how many
    there are (one only if all points are equal)."""
    most = math.ceil(math.sqrt(len(points)))
    owner = np.zeros(len(points), np.int64)
    pivots = points[:1]
    away = _norms(points - pivots[0])
    while len(pivots) < most:
        far = int(away.argmax())  # the farthest point of the widest anchor
        if away[far] == 0:
            break
        new = points[far]
        # a point nearer to its pivot than half the way from there to the new one stays
        look = np.flatnonzero(away > _norms(pivots - new)[owner] / 2)
        d = _norms(points[look] - new)
        won = d < away[look]
        owner[look[won]], away[look[won]] = len(pivots), d[won]
        pivots = np.vstack([pivots, new])
    used, owner = np.unique(owner, return_inverse=True)
    return owner, len(used)


class Tree:
    """Arrays of a binary tree of balls; ``order`` lists the points so that
    each ball's are the range [lo, hi)."""

    FIELDS = ("points", "order", "left", "right", "lo", "hi", "pivot", "radius", "total", "same")

    def __init__(self, points: np.ndarray):
        x = points.astype(np.float64)
        self.n, self.sums, self.kids, self.leaves, self.middle, self.wide = [], [], [], {}, [], []
        root = self._ball(x, np.arange(len(x)))
        order, spans = [], [[0, 0] for _ in self.n]
        stack = [(root, False)]
        while stack:  # depth first, without recursion: a chain of merges may be deep
            ball, closed = stack.pop()
            if closed:
                spans[ball][1] = len(order)
                continue
            spans[ball][0] = len(order)
            stack.append((ball, True))
            if ball in self.leaves:
                order.extend(self.leaves[ball].tolist())
            else:
                stack.extend((k, False) for k in reversed(self.kids[ball]))
        self.order = np.array(order, np.int64)
        self.points = points[self.order]
        self.left = np.array([k[0] for k in self.kids], np.int64)
        self.right = np.array([k[1] for k in self.kids], np.int64)
        self.lo, self.hi = np.array(spans, np.int64).T.copy()
        self.pivot = np.array(self.middle)
        self.total = np.array(self.sums).astype(np.int64)
        x = x[self.order]
        self.radius = np.array([_norms(x[lo:hi] - m).max() for lo, hi, m in zip(self.lo, self.hi, self.pivot)])
        self.same = np.array([bool((self.points[lo:hi] == self.points[lo]).all()) if left < 0 else False for lo, hi, left in zip(self.lo, self.hi, self.left)])

    def _add(self, n: int, total: np.ndarray, kids: tuple[int, int], wide: float) -> int:
        self.n.append(n)
        self.sums.append(total)
        self.kids.append(kids)
        self.middle.append(total / n)
        self.wide.append(wide)
        return len(self.n) - 1

    def _ball(self, x: np.ndarray, members: np.ndarray) -> int:
        own = x[members]
        if len(members) > LEAF:
            owner, k = anchors(own)
            if k > 1:
                by = np.argsort(owner, kind="stable")
                return self._merge([self._ball(x, m) for m in np.split(members[by], np.flatnonzero(np.diff(owner[by])) + 1)])
        total = own.sum(axis=0)
        ball = self._add(len(members), total, (-1, -1), float(_norms(own - total / len(members)).max()))
        self.leaves[ball] = members
        return ball

    def _merge(self, balls: list[int]) -> int:
        """Pairs of balls that make the smallest ball, up to one."""
        n = np.array([self.n[b] for b in balls], np.float64)
        middle = np.array([self.middle[b] for b in balls])
        wide = np.array([self.wide[b] for b in balls])
        ball = np.array(balls)
        apart = np.sqrt(((middle[:, None, :] - middle[None, :, :]) ** 2).sum(-1))

        def joined(i: int) -> np.ndarray:
            share = n / (n + n[i])
            return np.maximum(apart[i] * share + wide[i], apart[i] * (1 - share) + wide)

        cost = np.array([joined(i) for i in range(len(balls))])
        np.fill_diagonal(cost, np.inf)
        for left in range(len(balls) - 1, 0, -1):
            i, j = divmod(int(cost.argmin()), len(balls))
            new = self._add(self.n[ball[i]] + self.n[ball[j]], self.sums[ball[i]] + self.sums[ball[j]], (int(ball[i]), int(ball[j])), float(cost[i, j]))
            if left == 1:
                return new
            ball[i], n[i], middle[i], wide[i] = new, self.n[new], self.middle[new], self.wide[new]
            cost[j, :] = cost[:, j] = np.inf
            gone = np.isinf(cost[i])
            apart[i] = apart[:, i] = _norms(middle - middle[i])
            cost[i] = np.where(gone, np.inf, joined(i))
            cost[:, i] = cost[i]
        return balls[0]


def dump(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{k}_{f}": getattr(t, f) for k, t in enumerate(trees) for f in Tree.FIELDS})
    return out.getvalue()


class Stored:
    """One part's tree as it was written."""

    def __init__(self, arrays, part: int):
        for f in Tree.FIELDS:
            setattr(self, f, arrays[f"{part}_{f}"])


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact: as doubles while they fit, else as longs."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    exact = np.float64 if 4 * largest * largest * max(1, points.shape[1]) < 1 << 53 else np.int64
    p, e = points.astype(exact), entries.astype(exact)
    d = (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]
    return d.astype(np.int64)


def owners(tree, entries: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | int, int]]:
    """Walks a tree: (lo, hi, entry or entries, ball), the owner of every point.
    ``ball`` is -1 where points were looked at one by one."""
    e = entries.astype(np.float64)
    scale = max(float(np.abs(tree.pivot).max(initial=0)), float(np.abs(e).max(initial=0)))
    slack = 1e-6 * (1 + scale * math.sqrt(e.shape[1]))  # far above the rounding of doubles
    # an entry that equals an earlier one never wins
    _, first = np.unique(entries, axis=0, return_index=True)
    could = np.zeros((1, len(e)), bool)
    could[0, first] = True
    balls = np.array([len(tree.left) - 1])
    e2 = (e * e).sum(1)
    while len(balls):
        p = tree.pivot[balls]
        d = np.sqrt(np.maximum((p * p).sum(1)[:, None] - 2 * (p @ e.T) + e2, 0))
        d[~could] = np.inf
        could &= d <= d.min(axis=1, keepdims=True) + 2 * tree.radius[balls][:, None] + slack
        whole = could.sum(axis=1) == 1
        for i in np.flatnonzero(whole):
            yield int(tree.lo[balls[i]]), int(tree.hi[balls[i]]), int(could[i].argmax()), int(balls[i])
        leaf = tree.left[balls] < 0
        for i in np.flatnonzero(leaf & ~whole):
            lo, hi, left = int(tree.lo[balls[i]]), int(tree.hi[balls[i]]), np.flatnonzero(could[i])
            if tree.same[balls[i]]:
                yield lo, hi, int(left[distances(tree.points[lo : lo + 1], entries[left])[0].argmin()]), int(balls[i])
            else:
                yield lo, hi, left[distances(tree.points[lo:hi], entries[left]).argmin(axis=1)], -1
        split = ~whole & ~leaf
        balls, could = np.concatenate([tree.left[balls[split]], tree.right[balls[split]]]), np.concatenate([could[split], could[split]])


def sums(tree, entries: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
    """Adds the points of each entry to ``count`` and ``total``."""
    for lo, hi, entry, ball in owners(tree, entries):
        if ball >= 0:
            count[entry] += hi - lo
            total[entry] += tree.total[ball]
        else:
            count += np.bincount(entry, minlength=len(count))
            np.add.at(total, entry, tree.points[lo:hi])


def assign(tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point, in the order given to the tree: entry and squared distance."""
    entry = np.empty(len(tree.order), np.int64)
    for lo, hi, own, _ in owners(tree, entries):
        entry[lo:hi] = own
    error = ((tree.points - entries[entry]).astype(np.int64) ** 2).sum(axis=1)
    out = np.empty_like(entry), np.empty_like(error)
    out[0][tree.order], out[1][tree.order] = entry, error
    return out


# --------------------------------------------------------------- Spark


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, v: the scaled vectors that can be coded."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / SCALE))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.where(v.isNotNull() & fine & (F.size(v) > 0) & (F.size(v) % PARTS == 0))
    return rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), scaled.alias("v"))


def blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of vectors: their ids, labels and trees."""

    def block(ids: list, labels: list, v: np.ndarray) -> dict:
        return {"ids": ids, "labels": labels, "trees": dump([Tree(p) for p in np.split(v, PARTS, axis=1)])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("trees", pa.binary())])
        ids, labels, held = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids += part.column(0).to_pylist()
                labels += part.column(1).to_pylist()
                held.append(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
                if len(ids) >= BLOCK:
                    v = np.concatenate(held)
                    yield pa.RecordBatch.from_pylist([block(ids[:BLOCK], labels[:BLOCK], v[:BLOCK])], schema)
                    ids, labels, held = ids[BLOCK:], labels[BLOCK:], [v[BLOCK:]]
        if ids:
            yield pa.RecordBatch.from_pylist([block(ids, labels, np.concatenate(held))], schema)

    return written(vectors.mapInArrow(run, "ids array<long>, labels array<long>, trees binary"))


def _trees(batch: pa.RecordBatch, row: int) -> list[Stored]:
    arrays = np.load(io.BytesIO(batch.column("trees")[row].as_py()))
    return [Stored(arrays, k) for k in range(PARTS)]


def moved(trees: DataFrame, book: np.ndarray) -> np.ndarray:
    """One round: the codebooks after every part was given to its nearest entry."""
    size = book.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(book.shape[:2], np.int64)
        total = np.zeros(book.shape, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for k, tree in enumerate(_trees(batch, row)):
                    sums(tree, book[k], count[k], total[k])
        used = [{"part": int(k), "entry": int(j), "n": int(count[k, j]), "total": total[k, j].tolist()} for k, j in zip(*count.nonzero())]
        if used:
            yield pa.RecordBatch.from_pylist(used)

    rows = trees.select("trees").mapInArrow(run, "part long, entry long, n long, total array<long>")
    each = F.array(*[F.sum(F.col("total")[i]) for i in range(size)])
    out = book.copy()
    for r in rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), each.alias("total")).collect():
        out[r["part"], r["entry"]] = np.array(r["total"], np.int64) // r["n"]
    return out


def coded(trees: DataFrame, book: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [assign(tree, book[k]) for k, tree in enumerate(_trees(batch, row))]
                codes = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8)
                ids, labels = (pa.array(batch.column(c)[row].as_py(), pa.int64()) for c in ("ids", "labels"))
                hexes = [bytes(c).hex() for c in codes]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(hexes), pa.array(sum(error for _, error in found))], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, "vec_id long, label long, code string, error long")


def learn(vectors: DataFrame) -> tuple[DataFrame, np.ndarray] | None:
    """Codebooks after all rounds, and the blocks; None without vectors."""
    by = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    if not (first := vectors.orderBy(*by).limit(1).collect()):
        return None
    same = vectors.where(F.size("v") == len(first[0]["v"]))
    start = np.array([r["v"] for r in same.orderBy(*by).limit(ENTRIES).select("v").collect()], np.int64)
    book = np.stack(np.split(start, PARTS, axis=1))
    trees = blocks(same)
    for _ in range(ROUNDS):
        book = moved(trees, book)
    return trees, book


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable row
    of (vec_id, embedding, label).

    Rows whose vector is null or empty, holds null or non-finite components or
    components of 16,384 and more (their squared distances would overflow), has
    a length that four does not divide, or another length than the vector of
    the smallest id, are left out. Rows without an id are coded; they start no
    entry while there are 256 rows with one. Repeated ids each keep their row;
    of those the smaller vector counts as first. Fewer than 256 rows make as
    many entries. Null labels are one label. An empty table gives no row.
    Other columns are ignored.
    """
    learnt = learn(usable(vectors))
    if learnt is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    trees, book = learnt
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    rows = checkpoint(coded(trees, book))
    # labels meet on their hash too: it changes no match, and makes both sides
    # plain shuffles, of which AQE splits a label that holds many of the rows
    of_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumn("label_hash", F.xxhash64("label"))
    left = rows.withColumn("label_hash", F.xxhash64("label"))
    met = left.join(of_label, left["label"].eqNullSafe(of_label["label"]) & (left["label_hash"] == of_label["label_hash"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    def assigned(r: int) -> str:
        square = "list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v)"
        return f"a{r} AS (SELECT p.id, p.part, any_value(p.v) AS v, min(CAST({square} AS BIGINT) * {ENTRIES} + c.entry) AS best FROM p JOIN c{r} c ON p.part = c.part GROUP BY p.id, p.part)"

    def moved_sql(r: int) -> str:
        return f"""m{r} AS (SELECT part, entry, list(mid ORDER BY i) AS v FROM (
          SELECT part, best % {ENTRIES} AS entry, i, floor(sum(v[i]) / count(*)) AS mid FROM a{r}, (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM p))) AS i) GROUP BY 1, 2, 3) GROUP BY 1, 2),
        c{r + 1} AS (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.entry = c.entry)"""

    rounds = ",\n".join(f"{assigned(r)},\n{moved_sql(r)}" for r in range(ROUNDS))
    return f"""
    WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS u
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT id, part, u[CAST(part * len(u) / {PARTS} AS INT) + 1 : CAST((part + 1) * len(u) / {PARTS} AS INT)] AS v FROM k, (SELECT unnest(range({PARTS})) AS part)),
    c0 AS (SELECT part, id - 1 AS entry, v FROM p WHERE id <= {ENTRIES}),
    {rounds},
    {assigned(ROUNDS)},
    book AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, i)) AS sha FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM c{ROUNDS})),
    r AS (SELECT k.vec_id, k.label, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
      FROM a{ROUNDS} a JOIN k ON k.id = a.id GROUP BY k.id, k.vec_id, k.label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM r, book"""


ORACLE = _oracle()
