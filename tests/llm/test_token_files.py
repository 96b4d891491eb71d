"""Token files: bits, the words of the tokenizer, files, order and round trip."""

import random
import zlib

import numpy as np
import pytest

from driftlens.llm import token_files as tf


@pytest.fixture(scope="module")
def path():
    return __import__("public_tokenizers").path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", range(1, 33))
def test_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        data = tf.pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        stream = "".join(f"{b:08b}"[::-1] for b in data)  # lowest bit first
        assert [int(stream[i * bits : (i + 1) * bits][::-1], 2) for i in range(min(n, 20))] == ids[:20].tolist()
        assert (tf.unpack(data, bits, n) == ids).all()


def test_width():
    assert [tf.width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_words_are_the_librarys(path, monkeypatch):
    tokens = tf.Encoder(path, table_words=50)
    assert tokens.plain
    pool = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  ''sstrelvmd'  aAbé½²ⅧⅦ٣中一〇日__-!?.$#٠ ̈é‍ ΣςẞİǅʰªºΩ😀𠀀﻿0123"
    rng = random.Random(4)
    for piece in (1 << 20, 5):
        monkeypatch.setattr(tf, "PIECE_CHARS", piece)
        for _ in range(4000):
            text = "".join(rng.choice(pool) if rng.random() < 0.93 else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(1, 40)))
            assert tokens.encode(text).tolist() == tokens.library.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("a <|endoftext|> b", "x" * 5000, "", " " * 3000, "ab " * 9000):
        assert tokens.encode(text).tolist() == tokens.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [5, 16, 17])
def test_files_give_documents_back(tmp_path, bits):
    rng = np.random.default_rng(bits)
    docs = [(i if i % 5 else None, rng.integers(0, 1 << bits, n).astype(np.uint32)) for i, n in enumerate([1, 0, 3, 70, 64, 200, 1, 5, 0, 31])]
    writer = tf.Writer(f"file:{tmp_path}", "t", bits, file_ids=70, block=16)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    assert len(writer.done) == 3 and sum(n for _, n, _ in writer.done) == sum(len(ids) for _, ids in docs)
    left = iter(docs)
    for name, n, count in writer.done:
        r, start = tf.Reader(name), 0
        mine = [next(left) for _ in range(count)]
        every = np.concatenate([ids for _, ids in mine])
        for at, (doc_id, ids) in enumerate(mine):
            assert (r.document(at) == ids).all()
            assert list(r.documents())[at] == (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            start += len(ids)
        assert (r.ids(0, n) == every).all() and (r.ids(7, 40) == every[7:40]).all() and len(r.ids(n, n + 5)) == 0
        # each block starts where its offset says, so any is read alone
        assert [int(b - a) for a, b in zip(r.offsets, r.offsets[1:])][:-1] == [2 * bits] * (len(r.offsets) - 2)
        r.close()
    (tmp_path / "no").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        tf.Reader(f"file:{tmp_path}/no")


def plain(rows, library):
    """Rows in order to the contract's result."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_round_trip_of_documents(spark, path, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = plain(sorted((r.doc_id, r.text) for r in docs.collect()), tf.encoder(path).library)
    assert result(tf.round_trip(docs.repartition(7), path)) == want


def test_round_trip_of_odd_documents(spark, path, odd_docs, no_docs):
    got = result(tf.round_trip(odd_docs.selectExpr("*", "'x' as start", "1 as place", "2 as text_hash"), path))
    library = tf.encoder(path).library
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((d is not None, d or 0, n, c) for d, _, n, c in got) == sorted((d is not None, d or 0, n, c) for d, _, n, c in plain(rows, library))
    assert [d for d, *_ in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))  # nulls first
    assert [s for _, s, *_ in got] == [sum(n for _, _, n, _ in got[:i]) for i in range(len(got))]
    assert tf.round_trip(no_docs, path).collect() == []


def test_one_id_on_many_rows_is_split(spark, path, tmp_path):
    docs = spark.range(400).selectExpr("if(id < 300, 7, id) as doc_id", "if(id % 2 = 0, 'the same text', concat('text ', id)) as text").repartition(6)
    files = tf.write(docs, path, f"file:{tmp_path}", file_ids=100)
    per_task = {r["task"]: r["n"] for r in files.groupBy("task").agg({"documents": "sum"}).withColumnRenamed("sum(documents)", "n").collect()}
    assert sum(per_task.values()) == 400 and max(per_task.values()) < 200
    rows = result(tf.read(files, with_ids=True))
    assert [r[1] for r in rows] == [sum(x[2] for x in rows[:i]) for i in range(len(rows))]
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert all(zlib.crc32(np.array(r[4], "<u4").tobytes()) == r[3] for r in rows)
