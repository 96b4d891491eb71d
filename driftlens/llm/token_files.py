"""Operator 13: token ids in files of fixed-width bits.

A vocabulary of V tokens needs (V - 1).bit_length() bits an id. Ids are packed
lowest bit first, one behind the other, in blocks of ``BLOCK`` ids, each of
which starts at a byte: eight ids take exactly as many bytes as an id has bits,
so numpy packs and unpacks eight ids a row, with no loop over ids (8, 16 and 32
bits are plain casts). A file is

    header   magic, bits an id, ids a block
    blocks   packed ids
    blocks' offsets   (number of blocks + 1) x u64
    documents   per document: first id in the file (u64), doc_id (i64), has a doc_id (u8)
    footer   ids, blocks, documents, place of the offsets (u64 each), magic

little endian throughout. The index stands at the end, so a writer streams its
blocks; a reader takes the footer and then only the blocks that it needs.

Documents are dealt to tasks by ranges of doc_id and sorted there; equal ids
are further ordered by text and place, so that an id which many rows share is
split between tasks like any other range. Files go to the shared folder of
``spark.checkpoint.dir``; a task names them after its attempt and the
checkpointed list of paths is what is read, so a lost or repeated attempt
leaves nothing behind that a reader would see.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint, filesystem, values
from driftlens.session import ensure_checkpoint_dir

END = 0
BLOCK = 4096
#: A file is closed after the document that brings it to so many ids.
FILE_IDS = 32 << 20
#: Blocks packed, and ids checked, at a time.
SLICE = 256 * BLOCK
#: Entries of a task's word table; when full, a new one is begun. Longer words stay out.
TABLE_WORDS, TABLE_CHARS = 600_000, 64
#: Long texts are cut into words in pieces of about so many characters.
PIECE_CHARS = 1 << 20

MAGIC = b"TOKBITS1"
HEADER = struct.Struct("<8sII")
FOOTER = struct.Struct("<QQQQ8s")

# ---------------------------------------------------------------- bits


#: Widths at which the stream is an array of numpy's own.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def width(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a little-endian stream of ``bits`` bits each, filled up with
    zeros to a whole number of bytes."""
    if bits in _WHOLE:
        return ids.astype(_WHOLE[bits]).tobytes()
    rows = -(-len(ids) // 8)
    lanes = np.zeros((rows, 8), np.uint64)
    lanes.ravel()[: len(ids)] = ids
    out = np.zeros((rows, bits), np.uint8)
    for j in range(8):
        first, shift = divmod(j * bits, 8)
        moved = lanes[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, first + k] |= (moved >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed stream."""
    if bits in _WHOLE:
        return np.frombuffer(data, _WHOLE[bits], n).astype(np.uint32)
    rows = -(-n // 8)
    flat = np.zeros(rows * bits, np.uint8)
    have = np.frombuffer(data, np.uint8)[: rows * bits]
    flat[: len(have)] = have
    flat = flat.reshape(rows, bits)
    out = np.empty((rows, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        first, shift = divmod(j * bits, 8)
        lane = np.zeros(rows, np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            lane |= flat[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (lane >> np.uint64(shift)) & mask
    return out.ravel()[:n]


# --------------------------------------------------------------- files


class Writer:
    """Appends documents to files of about ``file_ids`` ids each."""

    def __init__(self, folder: str, stem: str, bits: int, file_ids: int = FILE_IDS, block: int = BLOCK):
        if block % 8:
            raise ValueError("a block holds a multiple of eight ids")
        self.fs, self.folder = filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.folder_uri, self.stem, self.bits, self.file_ids, self.block = folder, stem, bits, file_ids, block
        self.raw, self.done = None, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.raw is None:
            self.name = f"{self.stem}-{len(self.done):05d}.tokbits"
            self.raw = self.fs.open_output_stream(f"{self.folder}/{self.name}")
            self.raw.write(HEADER.pack(MAGIC, self.bits, self.block))
            self.at, self.ids, self.offsets, self.held, self.n_held = HEADER.size, 0, [], [], 0
            self.starts, self.doc_ids = [], []
        self.starts.append(self.ids)
        self.doc_ids.append(doc_id)
        self.held.append(ids)
        self.n_held += len(ids)
        self.ids += len(ids)
        if self.n_held >= SLICE:
            self._blocks(self.n_held // self.block * self.block)
        if self.ids >= self.file_ids:
            self.close()

    def _blocks(self, n: int) -> None:
        """Writes the first ``n`` held ids; all but a file's last block are full."""
        held = np.concatenate(self.held) if len(self.held) > 1 else self.held[0]
        whole = self.block // 8 * self.bits
        for at in range(0, n, SLICE // self.block * self.block):
            data = pack(held[at : min(n, at + SLICE // self.block * self.block)], self.bits)
            self.offsets.extend(range(self.at, self.at + len(data), whole))
            self.raw.write(data)
            self.at += len(data)
        self.held, self.n_held = [held[n:]], len(held) - n

    def close(self) -> None:
        if self.raw is None:
            return
        if self.n_held:
            self._blocks(self.n_held)
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        self.raw.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.raw.write(np.array(self.starts, "<u8").tobytes())
        self.raw.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.raw.write(known.tobytes())
        self.raw.write(FOOTER.pack(self.ids, len(self.offsets), len(self.doc_ids), self.at, MAGIC))
        self.raw.close()
        self.raw = None
        self.done.append((f"{self.folder_uri}/{self.name}", self.ids, len(self.doc_ids)))


class Reader:
    """Random access to one file: its index is read at once, ids by block."""

    def __init__(self, path: str):
        fs, place = filesystem(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        if size < HEADER.size + FOOTER.size:
            raise ValueError(f"{path} is no token file")
        self.n_ids, blocks, docs, at, magic = FOOTER.unpack(self._bytes(size - FOOTER.size, FOOTER.size))
        head, self.bits, self.block = HEADER.unpack(self._bytes(0, HEADER.size))
        if magic != MAGIC or head != MAGIC:
            raise ValueError(f"{path} is no token file")
        index = self._bytes(at, size - FOOTER.size - at)
        self.offsets = np.frombuffer(index, "<u8", blocks + 1)
        self.starts = np.append(np.frombuffer(index, "<u8", docs, 8 * (blocks + 1)), self.n_ids).astype(np.int64)
        self.doc_ids = np.frombuffer(index, "<i8", docs, 8 * (blocks + 1 + docs))
        self.known = np.frombuffer(index, np.uint8, docs, 8 * (blocks + 1 + 2 * docs)).astype(bool)

    def _bytes(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop), from the blocks that hold them."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        data = self._bytes(int(self.offsets[first]), int(self.offsets[last] - self.offsets[first]))
        held = min(self.n_ids, last * self.block) - first * self.block
        return unpack(data, self.bits, held)[start - first * self.block : stop - first * self.block]

    def document(self, at: int) -> np.ndarray:
        return self.ids(int(self.starts[at]), int(self.starts[at + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, start in the file, number of ids, crc32, read front to back
        ``SLICE`` ids at a time."""
        held, begins = np.empty(0, np.uint32), 0
        for i in range(len(self.doc_ids)):
            start, stop = int(self.starts[i]), int(self.starts[i + 1])
            at, crc = start, 0
            while at < stop:
                if not begins <= at < begins + len(held):
                    begins = at // self.block * self.block
                    held = self.ids(begins, begins + SLICE).astype("<u4")
                part = held[at - begins : stop - begins]
                crc = zlib.crc32(part.tobytes(), crc)
                at += len(part)
            yield (int(self.doc_ids[i]) if self.known[i] else None), start, stop - start, crc

    def close(self) -> None:
        self.file.close()


# -------------------------------------------------------------- tokens

# The pre-tokeniser's pattern in Python's own engine; characters that
# engine puts in other classes are found by _Same.
_WORD = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class _Same(dict):
    """Whether Python's word, digit and space classes put a character where
    Unicode's letter, number and white space do; kept by character. Characters
    that a Unicode version may not know are not the same."""

    def __missing__(self, c: str) -> bool:
        kind = unicodedata.category(c)
        letter, number = c.isalnum() and not c.isdecimal(), c.isdecimal()
        same = letter == (kind[0] == "L") and number == (kind[0] == "N") and kind != "Cn" and c not in _SEPARATORS
        self[c] = same
        return same


#: White space to Python only.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


class _Table(dict):
    """Ids of words by word, as little-endian unsigned 32-bit bytes."""

    def __init__(self, model, alphabet: str, most: int):
        super().__init__()
        self.model, self.alphabet, self.most = model, alphabet, most

    def __missing__(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(self.alphabet)
        ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(word) <= TABLE_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


def _alphabet() -> str:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    at = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(at[b] for b in range(256))


class Encoder:
    """A byte-level tokenizer file of the tokenizers library.

    Words are cut here and each distinct word is encoded once by the library's
    model. Texts with a special token or an odd character, and tokenizers that
    are not plain byte-level ones, go to the library whole.
    """

    def __init__(self, path: str, table_words: int = TABLE_WORDS):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (
            spec["model"]["type"] == "BPE" and not spec.get("normalizer")
            and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.known = _Same()
        self.table = _Table(self.library.model, _alphabet(), table_words)

    def pieces(self, text: str) -> Iterator[str]:
        """A long text cut before single spaces between words, where the
        pre-tokeniser always begins a new word."""
        at = 0
        while len(text) - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def same(self, text: str) -> bool:
        if text.isascii():
            return not any(c in text for c in _SEPARATORS)
        return all(map(self.known.__getitem__, set(text)))

    def encode(self, text: str) -> np.ndarray:
        if not self.plain or any(s in text for s in self.special) or not self.same(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        get = self.table.__getitem__
        parts = [b"".join(map(get, _WORD.findall(piece))) for piece in self.pieces(text)]
        return np.frombuffer(parts[0] if len(parts) == 1 else b"".join(parts), "<u4")


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --------------------------------------------------------------- Spark


def write(docs: DataFrame, tokenizer: str, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes documents in ascending doc_id order; returns the checkpointed
    list of files: task, file (both in order), path, ids, documents."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        end = np.array([END], np.uint32)
        task = TaskContext.get().partitionId()
        writer = Writer(folder, f"part-{task:06d}-{uuid.uuid4().hex}", width(tokens.size), file_ids)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), values(batch, 1)):
                writer.add(doc_id, np.concatenate([tokens.encode(text), end]))
        writer.close()
        if writer.done:
            yield pa.RecordBatch.from_pylist([{"task": task, "file": i, "path": p, "ids": n, "documents": d} for i, (p, n, d) in enumerate(writer.done)])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_hash"), F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "text_hash", "place"]
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return checkpoint(dealt.mapInArrow(run, "task long, file long, path string, ids long, documents long"))


def with_starts(files: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all files before: the tasks' totals are added
    up in one small window (a row a task), the files' within each task."""
    totals = files.groupBy("task").agg(F.sum("ids").alias("total"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("task", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("of_tasks"))
    inside = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    inner = files.withColumn("of_files", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return inner.join(totals, "task").select("task", "file", "path", "ids", (F.col("of_tasks") + F.col("of_files")).alias("start"))


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of listed files: doc_id, start, n_tokens, ids_crc32, and with
    ``with_ids`` the ids as an array. One task reads a file at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
        types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, rows, held = Reader(path), [], 0
                for at, (doc_id, start, n, crc) in enumerate(reader.documents()):
                    rows.append((doc_id, base + start, n, crc, *[reader.document(at).astype(np.int32)] * with_ids))
                    held += n * with_ids
                    if len(rows) >= 10_000 or held >= SLICE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
                reader.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    n = files.count()
    listed = with_starts(files).repartitionByRange(max(1, n), "task", "file").select("path", "start")
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encodes, writes and reads back all documents: doc_id, start, n_tokens,
    ids_crc32 (each with the end id 0 behind the document's ids).

    A null text is the empty text, whose only id is the end. Null ids come
    first and are read back as null. Repeated ids each keep their rows, ordered
    by text and place. A text of any length is one document, which may run over
    many blocks but not over files. An empty table writes no file and gives no
    row. Other columns are ignored, whatever their names.
    """
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read(write(docs, tokenizer, folder))
