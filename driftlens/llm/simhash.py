"""Operator 6: SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints within two bits of each other agree on four of six blocks of
bits, so each is put into fifteen groups, one for each choice of four blocks;
a group's members differ in at most 22 bits, which bounds its size whatever the
corpus (equal fingerprints are one member). Inside a group the members are
sorted by Gray rank, so that neighbours differ in few bits, and built into a
tree: a node holds the bits that all below it share, less those that its
parent holds already. A search adds up the differences from the root down and
leaves a whole subtree as soon as they exceed the limit.

Links of a group are returned as a spanning set: enough to connect what the
group connects, never all pairs. Components come from joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint, let, table, words
from driftlens.llm.graph import components

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 6
FANOUT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hashes whose bits are counted at once.
SLICE = 1 << 16


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """XXH64 (seed 42, what xxhash64 uses) of each shingle, repeats included;
    of the whole sequence if it has fewer words; none without words."""

    def of(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, size), " ")))
        short = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= size, each).when(F.size(w) > 0, short).otherwise(F.array().cast("array<long>"))

    return let(words(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)), of)


def majority(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per list of hashes, the 64 bits that are set in over half of them."""
    counts = np.zeros((len(offsets) - 1, 64), dtype=np.int64)
    for at in range(0, len(values), SLICE):
        part = values[at : at + SLICE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, at + len(part), side="left"))
        rows = np.arange(first, last)
        rows = rows[offsets[rows + 1] > np.maximum(offsets[rows], at)]
        counts[rows] += np.add.reduceat(bits, np.maximum(offsets[rows] - at, 0), axis=0, dtype=np.int64)
    bits = (2 * counts > (offsets[1:] - offsets[:-1])[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(majority(values, offsets - offsets[0]).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes(F.col("text"), size).alias("h")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over distinct codes in Gray order. levels[0] are the codes, each
    later level groups FANOUT nodes of the one before; a node's mask and bits
    are what all its codes share, less what its parent's mask has."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        full = np.full(len(codes), ~np.uint64(0))
        masks, bits = [full], [self.codes]
        ands, ors = self.codes, self.codes
        while len(ands) > FANOUT:
            starts = np.arange(0, len(ands), FANOUT)
            ands, ors = np.bitwise_and.reduceat(ands, starts), np.bitwise_or.reduceat(ors, starts)
            masks.append(~(ands ^ ors))
            bits.append(ands)
        self.levels = []
        for i, (mask, own) in enumerate(zip(masks, bits)):
            above = np.repeat(masks[i + 1], FANOUT)[: len(mask)] if i + 1 < len(masks) else np.zeros(len(mask), np.uint64)
            self.levels.append((mask & ~above, own))

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, place in Gray order) of every code within ``most`` bits."""
        top = len(self.levels[-1][0])
        query = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        sums = np.zeros(len(query), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, bits = self.levels[level]
            sums = sums + np.bitwise_count((queries[query] ^ bits[node]) & mask[node])
            keep = sums <= most
            query, node, sums = query[keep], node[keep], sums[keep]
            if level:
                below = len(self.levels[level - 1][0])
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, sums = np.repeat(query, FANOUT), np.repeat(sums, FANOUT)
                inside = node < below
                query, node, sums = query[inside], node[inside], sums[inside]
        return query, node

    def links(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (in the codes as given) of a spanning set of the links
        between codes within ``most`` bits."""
        n = len(self.codes)
        root = np.arange(n)
        step = max(1, (1 << 18) // FANOUT // FANOUT)
        for at in range(0, n, step):
            query, node = self.search(self.codes[at : at + step], most)
            a, b = query + at, node
            a, b = a[a < b], b[a < b]
            while True:
                x, y = root[a], root[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
        leaf = np.flatnonzero(root != np.arange(n))
        return self.order[root[leaf]], self.order[leaf]


def block_masks(blocks: int, most: int) -> list[int]:
    """Masks of all choices of blocks - most blocks of the 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(each, blocks - most)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def link(codes: DataFrame, most: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Distinct (fp, node) rows to links (a, b) of nodes, a spanning set of the
    pairs of fingerprints within ``most`` bits."""
    masks = block_masks(blocks, most)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("shared")) for i, m in enumerate(masks)])
    groups = codes.select("fp", "node", F.inline(keys)).groupBy("choice", "shared").agg(F.collect_list(F.struct("fp", "node")).alias("all")).where(F.size("all") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy()
            fp = lists.values.field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            node = lists.values.field("node").to_numpy(zero_copy_only=False)
            left, right = [], []
            for lo, hi in zip(offsets, offsets[1:]):
                if hi - lo == 2:
                    if int(fp[lo] ^ fp[lo + 1]).bit_count() <= most:
                        left.append(node[lo : lo + 1])
                        right.append(node[lo + 1 : hi])
                    continue
                a, b = GrayIndex(fp[lo:hi]).links(most)
                left.append(node[lo:hi][a])
                right.append(node[lo:hi][b])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())], names=["a", "b"])

    return groups.select("all").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    Null and empty texts have fingerprint zero and are linked like any other.
    A null id cannot name a component: such a row gets that of the documents
    with its fingerprint, or null, and links nothing. Rows that repeat an id
    are each linked by their own text and share the id as a node.
    """
    prints = checkpoint(fingerprints(docs, size))
    codes = checkpoint(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    shared = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    twice = prints.join(shared.select("doc_id"), "doc_id").join(codes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(link(codes, most).union(twice)).withColumnRenamed("component", "found")
    named = checkpoint(codes.join(found, "node", "left").select("fp", F.coalesce("found", "node").alias("component_id")))
    return prints.join(named, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest id, with all its
    columns. Rows without an id stay, and so do rows of the smallest id that
    differ in text; of rows alike in id and text one stays. An empty table
    stays empty."""
    found = near_duplicates(docs.select("doc_id", "text"))
    later = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("c")).where("c < doc_id").select("doc_id")
    kept = docs.join(later, "doc_id", "left_anti").withColumn("__llm_text_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    return kept.dropDuplicates(["doc_id", "__llm_text_hash"]).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
