"""Operator 5: exact substring dedup by bucket-pointer refinement.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
A full suffix array is not needed for that, only the classes of equal
``length``-byte strings and the first member of each, so suffixes are refined
just that far:

1. Initial buckets. Of the q-grams inside each window of ``length`` bytes the
   one with the smallest hash is its pointer (the leftmost of equal ones).
   Windows in a row that share a pointer are one entry, in the bucket of their
   q-gram: about one entry in 30 bytes, and equal windows are in equal buckets
   at equal offsets.
2. Refinement by later offsets. Entries of a bucket are sorted on the hash of
   all the bytes that their windows reach. In a class of equal entries all but
   the first are repeats in full. Only where a bucket has several classes do
   their first entries go on: a class found equal is never compared again.
3. Those are split into single windows, which get the bucket identifier of
   their whole ``length`` bytes (128 bits) and are refined the same way.

Every step is a shuffle on hashes followed by a pass over sorted rows, which
keeps the last class and no group. Before each shuffle a task settles what its
own batch can settle, so a passage that most documents share sends one row a
batch; a q-gram that meets very many contexts goes straight to step 3, where
its windows spread again. Nothing is dropped or capped.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import table, values, written

LENGTH = 100
GRAM = 40
#: Windows whose pointers are found at once (places in it fit into 16 bits).
CHUNK = 60_000
#: Entries settled together in a task.
BATCH = 400_000
#: A q-gram with so many contexts in one batch is spread at once.
MANY = 16

ENTRY, MARK, SPLIT = 0, 1, 2
_U = np.uint64
#: Odd multipliers of the two rolling hashes modulo 2**64, and a mixing one.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = _U(0xD6E8FEB86659FD93)
ROW = "kind byte, h long, c long, k long, start long, n long"


@functools.cache
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    base = _BASES[which]
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(CHUNK + 2 * LENGTH + 2, b, dtype=_U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _MIX
    return x ^ (x >> _U(32))


class Rolling:
    """Hashes of any substrings of a piece of text, from prefix sums."""

    def __init__(self, data: np.ndarray):
        wide = data.astype(_U) + _U(1)
        self.sums = []
        for which in (0, 1):
            s = np.zeros(len(data) + 1, dtype=_U)
            np.cumsum(wide * _powers(which)[0][: len(data)], out=s[1:])
            self.sums.append(s)

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s = self.sums[which]
        return (s[end] - s[start]) * _powers(which)[1][start]


def entries(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(bucket, class, first window, number of windows) of each entry of a
    text, in chunks."""
    run = length - gram + 1
    for at in range(0, len(data) - length + 1, CHUNK):
        part = data[at : at + CHUNK + length - 1]
        windows, grams = len(part) - length + 1, len(part) - gram + 1
        rolling = Rolling(part)
        place = np.arange(grams)
        hashed = _mix(rolling.of(0, place, place + gram))
        order = (hashed & ~_U(0xFFFF)) | place.astype(_U)
        padded = np.full(-(-grams // run) * run, ~_U(0))
        padded[:grams] = order
        blocks = padded.reshape(-1, run)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        pointer = (np.minimum(behind[:windows], ahead[run - 1 : run - 1 + windows]) & _U(0xFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], pointer[1:] != pointer[:-1])))
        n = np.diff(np.append(first, windows))
        to = pointer[first]
        reach = rolling.of(1, first, first + n - 1 + length)
        kind = ((to - first) * length + n).astype(_U) * _U(_BASES[0])
        yield hashed[to], _mix(reach ^ kind), first + at, n


def merged(k: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching [start, end) of each k."""
    if not len(k):
        return k, start, end
    order = np.lexsort((start, k))
    k, start, end = k[order], start[order], end[order]
    group = np.cumsum(np.concatenate(([True], k[1:] != k[:-1])))
    # one running maximum for all groups: each group is lifted above the ones before it
    lift = group * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (start[1:] > reach[:-1])))
    heads = np.flatnonzero(new)
    return k[heads], start[heads], reach[np.append(heads[1:], len(k)) - 1]


def _rows(kind: int, h, c, k, start, n) -> pa.RecordBatch:
    size = len(k)

    def longs(x) -> pa.Array:
        return pa.array(np.broadcast_to(x, size).astype(np.int64) if np.isscalar(x) else x.view(np.int64) if x.dtype == _U else x.astype(np.int64, copy=False))

    return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int8)), longs(h), longs(c), longs(k), longs(start), longs(n)], names=["kind", "h", "c", "k", "start", "n"])


def _spread(k: np.ndarray) -> np.ndarray:
    return _mix(k.view(_U) * _U(_BASES[1]))


def _marks(k, start, n, length) -> pa.RecordBatch:
    """Byte ranges that windows start..start+n-1 cover; n is the range's size."""
    k, start, end = merged(k, start, start + n - 1 + length)
    return _rows(MARK, _spread(k), 0, k, start, end - start)


def settle(h, c, k, start, n, length: int, splits: bool) -> Iterator[pa.RecordBatch]:
    """What one batch of entries tells by itself: all but the first of each
    class are marked, the first ones go on."""
    order = np.lexsort((start, k, c, h))
    h, c, k, start, n = h[order], c[order], k[order], start[order], n[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
    head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    later = ~new & ((k != k[head]) | (start != start[head]))
    if later.any():
        yield _marks(k[later], start[later], n[later], length)
    h, c, k, start, n = h[new], c[new], k[new], start[new], n[new]
    if splits:
        bucket = np.cumsum(np.concatenate(([True], h[1:] != h[:-1]))) - 1
        size = np.bincount(bucket)
        nth = np.arange(len(h)) - np.concatenate(([0], np.cumsum(size)[:-1]))[bucket]
        many = size[bucket] >= MANY
        if many.any():
            yield _rows(SPLIT, _spread(k[many]), 0, k[many], start[many], n[many])
        # two of them stay, to tell other batches that the bucket has several classes
        stay = ~many | (nth < 2)
        h, c, k, start, n = h[stay], c[stay], k[stay], start[stay], n[stay]
    yield _rows(ENTRY, h, c, k, start, n)


def refine(batches: Iterator[pa.RecordBatch], length: int, splits: bool) -> Iterator[pa.RecordBatch]:
    """One pass over rows sorted by (h, c, k, start): marks all but the first
    of each class; if splits, the first entries of buckets with several
    classes come out to be split. Keeps two rows: the bucket's first entry and
    the first of its last class."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("h", "c", "k", "start", "n")]
        for other in (MARK, SPLIT):
            has = kind == other
            if has.any():
                yield _rows(other, 0, 0, *[x[has] for x in cols[2:]])
        cols = [x[kind == ENTRY] for x in cols]
        if not len(cols[0]):
            continue
        known = len(held[0]) if held else 0
        h, c, k, start, n = [np.concatenate((a, b)) for a, b in zip(held, cols)] if held else cols
        new_h = np.concatenate(([True], h[1:] != h[:-1]))
        new = new_h | np.concatenate(([True], c[1:] != c[:-1]))
        at = np.arange(len(h))
        head = np.maximum.accumulate(np.where(new, at, 0))
        later = ~new & ((k != k[head]) | (start != start[head]))
        later[:known] = False
        if later.any():
            yield _marks(k[later], start[later], n[later], length)
        if splits:
            more = new & ~new_h
            bucket = np.cumsum(new_h) - 1
            several = np.bincount(bucket[more], minlength=bucket[-1] + 1) > 0
            out = more | (new_h & several[bucket])
            if known == 2:
                out[:2] = False
            if out.any():
                yield _rows(SPLIT, 0, 0, k[out], start[out], n[out])
        first, last = int(np.flatnonzero(new_h)[-1]), int(head[-1])
        keep = [first] if first == last else [first, last]
        held = [x[keep] for x in (h, c, k, start, n)]


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[np.ndarray]:
    column = batch.column(at)
    for i in range(batch.num_rows):
        v = column[i]
        yield np.frombuffer(v.as_buffer(), dtype=np.uint8) if v.is_valid else np.empty(0, np.uint8)


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("h").sortWithinPartitions("h", "c", "k", "start")


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``__llm_k``, a long that orders documents by doc_id: doc_id itself
    if ids are unique, else the place of (doc_id, text hash), nulls first.
    Rows alike in id and text are one document and get one key."""
    total, ids = docs.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if total == ids:
        return docs.withColumn("__llm_k", F.col("doc_id").cast("long"))
    named = docs.withColumn("__llm_t", F.xxhash64("text"))
    ordered = named.select("doc_id", "__llm_t").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "__llm_t")
    places = written(ordered.rdd.zipWithIndex().map(lambda r: (r[0][0], r[0][1], r[1])).toDF("__llm_d long, __llm_h long, __llm_k long"))
    same = named["doc_id"].cast("long").eqNullSafe(places["__llm_d"]) & (named["__llm_t"] == places["__llm_h"])
    return named.join(places, same).select(*docs.columns, "__llm_k")


def find(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Byte ranges to remove: (__llm_k, __llm_spans array<struct<start, n>>),
    for the rows of ``texts``, which has __llm_k and text among its columns."""
    k_at, t_at, at = texts.columns.index("__llm_k"), texts.columns.index("text"), len(texts.columns)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for key, data in zip(batch.column(1).to_pylist(), _texts(batch, 0)):
                for h, c, start, n in entries(data, length, gram):
                    held.append((h, c, np.full(len(h), key, np.int64), start, n))
                    size += len(h)
                if size > BATCH:
                    yield from settle(*map(np.concatenate, zip(*held)), length, True)
                    held, size = [], 0
            if held:
                yield from settle(*map(np.concatenate, zip(*held)), length, True)

    pointed = texts.select("text", "__llm_k").mapInArrow(collect, ROW)
    settled = written(_sorted(pointed).mapInArrow(lambda b: refine(b, length, True), ROW).select("kind", "k", "start", "n"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for key, data, todo in zip(batch.column(k_at).to_pylist(), _texts(batch, t_at), batch.column(at).to_pylist()):
                for s, n in sorted({(e["start"], e["n"]) for e in todo or ()}):
                    rolling = Rolling(data[s : s + n - 1 + length])
                    place = np.arange(n)
                    held.append((_mix(rolling.of(0, place, place + length)), rolling.of(1, place, place + length), np.full(n, key, np.int64), s + place, np.ones(n, np.int64)))
                    size += n
                if size > BATCH:
                    yield from settle(*map(np.concatenate, zip(*held)), length, False)
                    held, size = [], 0
            if held:
                yield from settle(*map(np.concatenate, zip(*held)), length, False)

    todo = settled.where(F.col("kind") == SPLIT).groupBy(F.col("k").alias("__llm_k")).agg(F.collect_list(F.struct("start", "n")).alias("__llm_todo"))
    single = texts.join(todo, "__llm_k", "left").select(*texts.columns, "__llm_todo").mapInArrow(split, ROW)
    single = _sorted(single).mapInArrow(lambda b: refine(b, length, False), ROW)
    marks = settled.where(F.col("kind") == MARK).select("k", "start", "n").union(single.select("k", "start", "n"))
    return marks.groupBy(F.col("k").alias("__llm_k")).agg(F.collect_list(F.struct("start", "n")).alias("__llm_spans"))


EXTRA = [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary")]


def _removed(docs: DataFrame, length: int, gram: int, in_place: bool) -> DataFrame:
    """Columns of ``docs`` and either EXTRA (as __llm_*), or text cut in place."""
    texts = keyed(docs)
    t_at, at = texts.columns.index("text"), len(texts.columns)
    # the same columns as in find(), so that both joins can read one shuffle of the texts
    both = texts.join(find(texts, length, gram), "__llm_k", "left").select(*texts.columns, "__llm_spans")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, spans, kept = [], [], [], []
            for i, (data, found) in enumerate(zip(_texts(batch, t_at), values(batch, at))):
                start = np.array([e["start"] for e in found or ()], dtype=np.int64)
                end = start + np.array([e["n"] for e in found or ()], dtype=np.int64)
                _, start, end = merged(np.zeros(len(start), np.int64), start, end)
                edges = zip(np.concatenate(([0], end)), np.append(start, len(data)))
                left = b"".join([data[a:b].tobytes() for a, b in edges])
                if in_place:
                    kept.append(left.decode("utf-8", "ignore") if batch.column(t_at)[i].is_valid else None)
                else:
                    size.append(len(data))
                    gone.append(int((end - start).sum()))
                    spans.append(len(start))
                    kept.append(left)
            columns, names = list(batch.columns[:at]), list(batch.schema.names[:at])
            if in_place:
                columns[t_at] = pa.array(kept, pa.string())
            else:
                columns += [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
                names += [f"__llm_{n}" for n, _ in EXTRA]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, schema if in_place else schema + "".join(f", __llm_{n} {t}" for n, t in EXTRA))


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All columns of ``docs`` and n_bytes, n_removed, n_spans, kept (binary:
    the bytes left). Further columns may bear any names but these and __llm_*.

    Null text is empty: nothing to remove. Texts shorter than ``length`` bytes
    stay whole. Rows alike in id and text are one document: neither is an
    earlier copy of the other, and both get the same result. Rows that share
    an id but not the text are ordered by a hash of it; null ids come first.
    """
    done = _removed(docs, length, gram, False)
    return done.select(*docs.columns, *[F.col(f"__llm_{n}").alias(n) for n, _ in EXTRA])


def summary(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    done = remove(docs.select("doc_id", "text"), length)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cut_text(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeats cut from ``text`` (bytes of a character that
    a cut divides go too; null stays null) and ``n_chars``, if there, set anew."""
    out = _removed(docs, length, gram, True).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
