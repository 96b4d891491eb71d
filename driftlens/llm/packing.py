"""Operator 2: best-fit packing by patterns and non-negative least squares.

A pattern is a few piece lengths that fill a sequence. How often each pattern
is used is fitted to the histogram of lengths by non-negative least squares,
rounded down so that no pattern takes more pieces than there are, and what the
patterns leave is packed by best fit on the same histogram; should best fit
alone need fewer sequences, its plan is taken. All of this works
on one count per length, at most ``capacity`` of them however many documents
there are: that is the only thing that reaches the driver, and the list of
(length, rank range) -> sequence that comes back is bounded by the patterns.

Documents meet their places by rank within their length. The rank is counted
in two steps, so that a length shared by most documents is no single task:
pieces are dealt to cells by (length, hash), numbered within their cell, and
the cells' first ranks are running sums over the small table of cells.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlens.llm.bpe import Vocabulary, library
from driftlens.llm.common import checkpoint, values

CAPACITY = 2048
#: Entries of a worker's tables of units and of words; when one is full, a new
#: one is begun, to which words that come again are carried over. Longer ones
#: stay out.
TABLE_WORDS, TABLE_CHARS = 250_000, 64
#: Lengths are fitted in steps of capacity / BINS for patterns of three and more.
BINS = 64
#: Pieces in a cell of one length, on average, at most.
CELL_ROWS = 1_000


class _Words(dict):
    """Ids of words as little-endian unsigned 32-bit bytes, each worked out once
    by the library's model."""

    def __init__(self, vocab: Vocabulary, most: int):
        super().__init__()
        self.model, self.most = library(vocab.path).model, most
        self.older: dict[str, bytes] = {}
        self.spelt = str.maketrans(dict(enumerate(vocab.chars)))

    def work_out(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self.spelt)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.work_out(word)
        if len(word) <= TABLE_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class _Units(_Words):
    """The same of runs without white space, from the ids of their words."""

    def __init__(self, vocab: Vocabulary, most: int):
        super().__init__(vocab, most)
        self.words, self.split = _Words(vocab, most), vocab.split

    def work_out(self, unit: str) -> bytes:
        if unit.isalpha():  # one word
            return super().work_out(unit)
        return b"".join(map(self.words.__getitem__, self.split.findall(unit)))


class _Sure(dict):
    """Whether a character's lower case and kind are the same in every Unicode
    version and wherever it stands; kept by character."""

    def __missing__(self, c: str) -> bool:
        self[c] = sure = c != "\u03a3" and not "\x1c" <= c <= "\x1f" and unicodedata.category(c) != "Cn"
        return sure


class Encoder:
    """Whole texts to ids as bytes; texts with a special token or an unsure
    character go to the library whole."""

    def __init__(self, path: str, table_words: int = TABLE_WORDS):
        self.vocab = Vocabulary(path, merges=False)
        self.units, self.sure = _Units(self.vocab, table_words), _Sure()

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.vocab.special) or not all(map(self.sure.__getitem__, set(text))):
            return array("I", library(self.vocab.path).encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.units.__getitem__, unicodedata.normalize("NFC", text).lower().split()))


@functools.cache
def encoder(path: str) -> Encoder:
    """One a Python worker, so that its tables outlive a task."""
    return Encoder(path)


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids: each text's ids, then id 0. Null
    text is empty and gives one piece of length 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            keys = batch.column(0).to_pylist()
            for key, text in zip(keys, values(batch, 1)):
                packed = encode(text or "") + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    ids.append(key)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, piece, start, length, crc), types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def enumerate_patterns(bins: int, most: int = 4) -> list[tuple[int, ...]]:
    """Non-increasing lengths (in bins) of 1 to ``most`` pieces that add up to bins."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int) -> None:
        if not left:
            out.append(head)
        elif len(head) < most:
            for x in range(min(left, head[-1] if head else left), 0, -1):
                if x * (most - len(head)) >= left:
                    grow((*head, x), left - x)

    grow((), bins)
    return out


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """Non-negative x that minimises |A x - target|, by cyclic coordinate
    descent; column p of A counts the lengths of pattern p."""
    sparse = []
    for p in columns:
        at, n = np.unique(p, return_counts=True)
        sparse.append((at, n.astype(float), float((n * n).sum())))
    x, left = np.zeros(len(columns)), target.astype(float)
    for _ in range(sweeps):
        moved = 0.0
        for i, (at, n, norm) in enumerate(sparse):
            step = max((left[at] * n).sum() / norm, -x[i])
            if step:
                x[i] += step
                left[at] -= step * n
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs a histogram: the longest length left opens a sequence, which is
    filled with the longest that fits; equal sequences are made at once."""
    counts, out = counts.copy(), []
    lengths = [int(n) for n in np.flatnonzero(counts)]
    while lengths:
        left, used = capacity, {}
        for n in reversed(lengths):
            fits = min(left // n, int(counts[n]) - used.get(n, 0))
            if fits > 0:
                used[n] = fits
                left -= n * fits
            if not left:
                break
        times = max(1, min(int(counts[n]) // k for n, k in used.items()))
        out.append((tuple(n for n, k in used.items() for _ in range(k)), times))
        for n, k in used.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n]]
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that use up the
    histogram: the fitted patterns and best fit for what they leave, or best fit
    alone if that needs fewer sequences."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in histogram.items():
        counts[n] = k
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], times: int) -> None:
        at, n = np.unique(pattern, return_counts=True)
        times = min(times, int((counts[at] // n).min()))
        if times > 0:
            out.append((tuple(sorted(pattern, reverse=True)), times))
            counts[at] -= times * n

    take((capacity,), int(counts[capacity]))
    alone = out + best_fit(counts.copy(), capacity)
    step = capacity // bins
    if step > 0:
        # a pattern in bins stands for exact lengths: each bin's fitted pieces
        # are dealt from its lengths, and the last piece takes what is left
        coarse = np.zeros(bins + 1)
        np.add.at(coarse, np.clip((np.arange(capacity + 1) + step // 2) // step, 1, bins), counts)
        patterns = [p for p in enumerate_patterns(bins) if all(coarse[x] for x in p)]
        fitted = np.floor(nnls(patterns, coarse)).astype(np.int64)
        for i in np.argsort(-fitted, kind="stable"):
            if fitted[i]:
                _deal(patterns[i], int(fitted[i]), counts, step, capacity, take)
    out += best_fit(counts, capacity)
    return min(out, alone, key=lambda sequences: sum(times for _, times in sequences))


def _deal(pattern: tuple[int, ...], times: int, counts: np.ndarray, step: int, capacity: int, take) -> None:
    """Turns ``times`` uses of a pattern in bins into exact lengths that fill
    the sequence: all but the last piece come from the bins, most frequent
    lengths first, and the last has exactly the length that is left."""
    *heads, tail = pattern
    while times > 0:
        chosen: list[int] = []
        for x in heads:
            low, high = max(1, x * step - step // 2), min(capacity, x * step + (step + 1) // 2 - 1)
            span = counts[low : high + 1].copy()
            for c in chosen:
                if low <= c <= high:
                    span[c - low] -= 1
            if span.max(initial=0) <= 0:
                return
            chosen.append(low + int(span.argmax()))
        left = capacity - sum(chosen)
        if left < 0 or not left and tail:
            return
        near = np.arange(max(1, left - 2 * step), left + 1)
        has = np.array([counts[n] - chosen.count(n) for n in near])
        if not (has > 0).any():
            return
        last = int(near[np.flatnonzero(has > 0)[-1]])
        if left - last > 0 and left - last > step // 8:
            return
        at, n = np.unique([*chosen, last], return_counts=True)
        now = min(times, max(1, int((counts[at] // n).min()) // 2))
        take((*chosen, last), now)
        times -= now


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, number of ranks, first sequence, pieces of this
    length in a sequence, offset of the first of them) for each length of each
    pattern. Equal lengths stand together in a sequence."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            k = pattern.count(n)
            out.append((n, used.get(n, 0), k * times, sequence, k, offset))
            used[n] = used.get(n, 0) + k * times
            offset += n * k
        sequence += times
    return out


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Packs all documents; one row per piece.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Null or empty text is one piece of length 1; null and repeated ids are
    packed like any other row (each row of ``docs`` is a document of its own);
    further columns are no matter; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = checkpoint(cut(docs, path, capacity))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = places(plan(histogram, capacity))
    # one row per length, so at most ``capacity`` rows: safe to broadcast
    cells = spark.createDataFrame([(n, -(-k // CELL_ROWS)) for n, k in histogram.items()], "length long, cells long")
    in_cell = pieces.join(F.broadcast(cells), "length").withColumn("cell", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), cells)"))
    first = (
        in_cell.groupBy("length", "cell").agg(F.count("*").alias("n"))
        .withColumn("first", F.sum("n").over(Window.partitionBy("length").orderBy("cell")) - F.col("n"))
        .select("length", "cell", "first")
    )
    ranked = in_cell.withColumn("in_cell", F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(first, ["length", "cell"]).withColumn("rank", F.col("first") + F.col("in_cell"))
    # per length, its places in order of first rank: bounded by the patterns
    by_length: dict[int, list[tuple]] = {}
    for n, rank, ranks, sequence, k, offset in rows:
        by_length.setdefault(n, []).append((rank, ranks, sequence, k, offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: np.array(v, dtype=np.int64) for n, v in by_length.items()}
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at, t = np.flatnonzero(length == n), tables[int(n)]
                row = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + nth // row[:, 3]
                offset[at] = row[:, 4] + nth % row[:, 3] * n
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")] + [pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
