"""Operators on documents against plain versions, and their edge cases."""

import collections
import hashlib
import random
import re
import struct
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftlens.llm import bpe, classifier, fingerprints, packing, quality_rules, simhash, suffix_dedup

WORD = r"[^\x20\x09-\x0D]+"


def rows(df):
    return [r.asDict() for r in df.collect()]


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


# --- op4 -----------------------------------------------------------------


def library_digests(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_equals_the_library(spark, small, odd_docs, vocab):
    tok = bpe.library(vocab)
    for docs in (documents(spark, small), odd_docs):
        got = collections.Counter(tuple(r) for r in bpe.encode(docs, vocab).collect())
        assert got == collections.Counter((r[0], *library_digests(tok, r[1])) for r in docs.select("doc_id", "text").collect())


def test_trie_equals_plain_merging_and_table_turns_over(vocab):
    v = bpe.Vocabulary(vocab)
    rnd = random.Random(4)
    words = {"".join(rnd.choice("abcdehinost'éß!") for _ in range(rnd.randint(1, 90))) for _ in range(500)}
    chars = v.chars
    for w, ids in bpe.encode_words(v, words).items():
        assert ids == [v.ids[t] for t in v.merge(v.symbols("".join(chars[b] for b in w.encode()) + v.end))]
    few = bpe.Encoder(vocab, True, 5)
    texts = ["the cat sat", "on the mat", "cat on mat the", "the cat"] * 3
    for group in texts:
        assert next(few.encode_batch([group], True))[0] == next(bpe.Encoder(vocab).encode_batch([group], True))[0]


# --- op2 -----------------------------------------------------------------


def test_long_words_and_odd_texts_equal_the_library(vocab):
    tok, enc, plain, rnd = bpe.library(vocab), bpe.Encoder(vocab), bpe.Encoder(vocab, False), random.Random(5)
    pieces = [*"abcXYZ 'st\t\n\x1c\x1f\x85\u3000\xa0ΣςσİßÉé\u0378\u0301日本語12!?<|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'ll", "ΑΣ"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(30))) for _ in range(1500)]
    texts += ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)), "a" * 100_000, "日本" * 30_000, "a" * 100_000 + "b"]
    start = time.perf_counter()
    got = list(enc.encode_batch(texts, True))
    assert time.perf_counter() - start < 30  # merging such words plainly takes minutes
    for text, (packed, decoded), (other, _) in zip(texts, got, plain.encode_batch(texts, True)):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert packed == other == struct.pack(f"<{len(ids)}I", *ids)
        assert decoded.decode() == tok.decode(ids, skip_special_tokens=False)


def check_packing(df, docs, tok, capacity):
    per_doc, fill = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows(df):
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
        per_doc[r["doc_id"]].append(r)
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    for doc_id, (text, *more) in texts.items():
        if more:
            continue  # rows that repeat an id: counted below
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        want = [(k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in per_doc[doc_id]) == want
    total = sum(length for parts in fill.values() for _, length in parts)
    assert total == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for (t,) in docs.select("text").collect())
    return len(fill), -(-total // capacity)


def test_packing_is_gapless_and_near_the_bound(spark, small, odd_docs, no_docs, vocab):
    tok = bpe.library(vocab)
    used, bound = check_packing(packing.pack(documents(spark, small), vocab), documents(spark, small), tok, 2048)
    assert used <= bound * 1.02 + 1
    check_packing(packing.pack(odd_docs, vocab), odd_docs, tok, 2048)
    assert packing.pack(no_docs, vocab).count() == 0


def test_packing_encodes_as_the_library(vocab):
    encode, tok, rnd = packing.Encoder(vocab, table_words=40), bpe.library(vocab), random.Random(8)
    pool = " \t\n\r\x1c\x85\xa0''sstrelvmd aAbBéÉ½²ⅧΣσςİǅ中日ん__-!?.#😀ẞﬁe\u0301123"
    for _ in range(4000):
        text = "".join(rnd.choice(pool) if rnd.random() < 0.95 else chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)])) for _ in range(rnd.randrange(1, 30)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("", "<|endoftext|> x", "y" * 3000, "word, " * 500):
        assert np.frombuffer(encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_fit_needs_no_more_sequences_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.clip(rng.lognormal(5.5, 1.1, (50, 3000, 20_000)[seed]).astype(int), 1, 2048), minlength=2049)
    histogram = {n: int(k) for n, k in enumerate(counts) if k}
    best = sum(t for _, t in packing.best_fit(counts.copy(), 2048))
    assert sum(t for _, t in packing.plan(histogram)) <= best


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_any_histogram(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randint(1, 2048): rnd.randint(1, 400) for _ in range(rnd.choice([3, 300]))}
    plan = packing.plan(histogram)
    used = collections.Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 2048 and times > 0
        for n in pattern:
            used[n] += times
    assert used == collections.Counter(histogram)
    for n in histogram:
        spans = sorted((rank, ranks) for m, rank, ranks, *_ in packing.places(plan) if m == n)
        assert [s for s, _ in spans] == list(np.cumsum([0] + [c for _, c in spans])[:-1]) and sum(c for _, c in spans) == histogram[n]


# --- op5 -----------------------------------------------------------------


def brute_removal(texts, length=100):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for q in range(len(gone)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_removal_equals_brute_force(spark, small):
    docs = documents(spark, small).orderBy("doc_id").select("doc_id", "text").collect()
    want = dict(zip([r[0] for r in docs], brute_removal([r[1] for r in docs])))
    assert {r[0]: tuple(r[1:]) for r in suffix_dedup.summary(documents(spark, small)).collect()} == want


def test_removal_in_odd_texts(spark):
    rnd = random.Random(3)
    some = "".join(rnd.choice("abcdefg ") for _ in range(400))
    texts = ["a" * 500, "ab" * 300, None, "", some, "é" * 120 + some[50:250], some[:99], some[:100], "zz" + "a" * 100, "x" * 130_000, some * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [tuple(r[1:]) for r in sorted(suffix_dedup.summary(df).collect())] == brute_removal(texts)


def test_removal_with_many_contexts_of_one_passage(spark):
    rnd = random.Random(5)
    line = "a line that very many of the documents share, and nothing else of them "
    texts = ["".join(rnd.choice("klmnop") for _ in range(90)) + line + "".join(rnd.choice("qrstu") for _ in range(90 if i % 3 else 25)) + ("" if i % 3 else "tail" * 9) for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    assert [tuple(r[1:]) for r in sorted(suffix_dedup.summary(df).collect())] == brute_removal(texts)


def test_removal_of_repeated_rows(odd_docs, no_docs):
    got = rows(suffix_dedup.summary(odd_docs))
    assert len(got) == odd_docs.count() and suffix_dedup.summary(no_docs).count() == 0
    twice = [r for r in got if r["doc_id"] == 2]
    assert twice[0] == twice[1] and twice[0]["n_removed"] == twice[0]["n_bytes"]
    cut = suffix_dedup.cut_text(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()


# --- op6 -----------------------------------------------------------------


def plain_simhash(text):
    w = re.findall(WORD, (text or "").translate(str.maketrans(simhash.UPPER, simhash.LOWER)))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, pairs):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_equals_brute_force(spark, small):
    docs = documents(spark, small).orderBy("doc_id").select("doc_id", "text").collect()
    prints = np.array([plain_simhash(r[1]) for r in docs], dtype=np.uint64)
    root = roots(len(docs), zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)))
    want = {r[0]: (f"{int(p):016x}", docs[q][0]) for r, p, q in zip(docs, prints, root)}
    assert {r[0]: tuple(r[1:]) for r in simhash.near_duplicates(documents(spark, small)).collect()} == want


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 15, dtype=np.uint64)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 15).astype(np.uint64)) for _ in range(60)]
    codes = np.unique(np.concatenate([*near, rng.integers(0, 2**63, 400, dtype=np.uint64)]))
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    q, node = simhash.GrayIndex(codes).search(codes, 2)
    assert len(q) == (apart <= 2).sum()
    a, b = simhash.GrayIndex(codes).links(2)
    assert roots(len(codes), zip(a, b)) == roots(len(codes), zip(*np.nonzero(apart <= 2))) and len(a) < len(codes)


def test_simhash_chain_and_odd_rows(spark, odd_docs, no_docs):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    from driftlens.llm.graph import components

    assert {r[1] for r in components(chain).collect()} == {0}
    got = rows(simhash.near_duplicates(odd_docs))
    assert len(got) == odd_docs.count() and simhash.near_duplicates(no_docs).count() == 0
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert {r["fingerprint"] for r in got if r["doc_id"] in (3, 4, 5)} == {"0" * 16}
    kept = rows(simhash.keep_first(odd_docs))
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 3, 6, 7, 8, 9] and set(kept[0]) == set(odd_docs.columns)


# --- op1, op9, op10 -------------------------------------------------------


def test_fingerprint_buckets_are_even_whatever_the_ids(spark):
    ids = [*range(9000), *range(10**6, 10**15, 10**12), -(10**18), 2**62]
    df = spark.createDataFrame([(i, f"text {i}.") for i in ids], "doc_id long, text string").repartition(5)
    parts = fingerprints.edges(df, 100)
    held = df.groupBy(fingerprints.bucket_of(F.col("doc_id"), parts).alias("b")).agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).orderBy("b").collect()
    assert len(held) > 90 and max(r["n"] for r in held) < 300
    for r in held:
        assert r["b"] == sum(e <= r["low"] for e in parts)
    got = {r["doc_id"]: r["next_text"] for r in fingerprints.in_order(df).where("not guest").collect()}
    order = sorted(ids)
    assert got == {i: f"text {n}." for i, n in zip(order, order[1:] + order[:1])}


def test_fingerprints_add_up(spark, odd_docs, no_docs):
    got = rows(fingerprints.fingerprint(odd_docs))
    assert len(got) == odd_docs.count() and fingerprints.fingerprint(no_docs).count() == 0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    df = spark.createDataFrame([("a", "one. two.\nthree"), ("b", "three\ntwo. one."), ("c", "one."), ("d", "two.\nthree")], "g string, text string")
    v = {r["g"]: r["vector"] for r in fingerprints.fingerprint_groups(df, "g").collect()}
    assert v["a"] == v["b"] != v["c"]
    sums = spark.createDataFrame([(v["c"], v["d"], v["a"])], "c array<long>, d array<long>, a array<long>").select(fingerprints.plus(F.col("c"), F.col("d")).alias("p"), fingerprints.minus(F.col("a"), F.col("c")).alias("m")).first()
    assert sums["p"] == v["a"] and sums["m"] == v["d"]


def test_classifier_on_held_out_rows(spark, small, odd_docs, no_docs):
    sf = small.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = classifier.predict(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in out) >= 0.9 * len(out)
    assert all(r["predicted"] == 1 for r in out if r["quality"] == 1)
    assert {r["score"] for r in classifier.predict(odd_docs, labels.where("1 = 0")).collect()} == {0.5}
    assert classifier.predict(no_docs, labels).count() == 0


def test_descent_equals_a_plain_dual_solver():
    rnd = np.random.default_rng(4)
    rows = [np.unique(rnd.integers(0, 40, 12)) + (0 if label else 20) for label in range(2) for _ in range(15)]
    y = np.repeat([0.0, 1.0], 15)
    ratio = classifier.log_count_ratio(rows, y)
    counts = [collections.Counter(f for x, label in zip(rows, y) if label == k for f in x) for k in (0, 1)]
    total = [sum(c.values()) + classifier.SMOOTHING * classifier.DIM for c in counts]
    for f in range(60):
        p, q = ((counts[k][f] + classifier.SMOOTHING) / total[k] for k in (1, 0))
        assert abs(ratio[f] - np.log(p / q)) < 1e-9
    w = classifier.coordinate_descent(rows, ratio, y, epochs=3000, cost=0.7)
    x = np.zeros((30, 61))
    for i, found in enumerate(rows):
        x[i, found] = ratio[found] / np.sqrt(len(found))
    x[:, 60] = 1
    x *= np.where(y > 0, 1.0, -1.0)[:, None]
    gram, alpha = x @ x.T, np.zeros(30)
    step = 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(60_000):
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, 0.7)
    plain = x.T @ alpha
    assert np.abs(np.append(w[:60], w[classifier.DIM]) - plain).max() < 0.02 and not w[60 : classifier.DIM].any()


@pytest.mark.parametrize("few", [1, 2, 4])
def test_classifier_learns_from_few_rows_of_a_class(few):
    good, bad = np.arange(0, 30), np.arange(30, 60)
    rows = [good] * 20 + [bad] * few
    y = np.array([1.0] * 20 + [0.0] * few)
    model = classifier.fit(rows, y, (few, 20))
    scores = classifier.sigmoid(model[-2] * classifier.margins([good, bad], model) + model[-1])
    assert scores[0] > scores[1]
    assert len(set(classifier.fit(rows[:20], y[:20], (0, 20))[: classifier.DIM])) == 1


def test_classifier_learns_from_labelled_rows_of_the_corpus_only(spark):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(("alpha", "beta", "gamma") if i % 2 else ("$$$", "###", "zzz")) for _ in range(30)) for i in range(60)]
    ids = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5][:60]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    absent = [(i, i % 2) for i in range(5000, 8000)]
    labels = spark.createDataFrame([(d, i % 2) for i, d in enumerate(ids)] + absent, "doc_id long, quality int")
    indicators = classifier.Indicators()
    want = classifier.fit([indicators(t) for t in texts], np.arange(60) % 2.0, (30, 30))
    assert want[: classifier.DIM].any() and np.allclose(classifier.train(docs, labels, 30), want)


def test_pipeline_classifier_learns_what_the_rules_removed(spark, small):
    import corpus_pipeline as P

    sf = small.replace("sf0.001", "sf0.01")
    docs, labels = P.table(spark, sf, "documents"), P.table(spark, sf, "labels")
    text, label = dict(docs.select("doc_id", "text").collect()), dict(labels.select("doc_id", "quality").collect())
    ids = sorted(d for d in label if d in text and zlib.crc32(str(d).encode()) % 5)
    indicators = classifier.Indicators()
    y = np.array([label[d] for d in ids], dtype=float)
    model = classifier.fit([indicators(text[d]) for d in ids], y, (int((y == 0).sum()), int((y == 1).sum())))
    assert model[: classifier.DIM].any()
    stage = docs.join(labels.where("quality = 0"), "doc_id", "left_anti")  # as after a first stage
    got = sorted(r["doc_id"] for r in P.quality(spark, stage, sf).select("doc_id").collect())
    given = [r["doc_id"] for r in stage.select("doc_id").collect()]
    p = classifier.sigmoid(model[-2] * classifier.margins([indicators(text[d]) for d in given], model) + model[-1])
    assert got == sorted(d for d, q in zip(given, p) if q >= classifier.CUT) and len(got) < len(given)


def test_quality_rules_on_odd_rows(odd_docs, no_docs):
    got = rows(quality_rules.judge(odd_docs, ["doc_id"]))
    assert len(got) == odd_docs.count() and quality_rules.judge(no_docs, ["doc_id"]).count() == 0
    assert all(r["base_failed"] and not r["kept"] for r in got if r["doc_id"] in (3, 4, 5, 9))
    long = next(r for r in got if r["doc_id"] == 6)
    assert long["n_words"] == 30_000 == long["n_repeat_words"] and long["n_dup_lines"] == 2999
    kept = quality_rules.keep(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 6").count() == 0


def test_source_full_of_junk_does_not_raise_its_own_limits(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    symbols, lines = clean + " " + "#$%&" * 20, "\n".join(f"{clean} {i}\nz" if i == 0 else f"line{i} of its own\nz" for i in range(10))
    given = [("en", "clean", clean)] * 1400 + [("en", "sym", clean)] * 180 + [("en", "sym", symbols)] * 120 + [("en", "dup", clean)] * 180 + [("en", "dup", lines)] * 120 + [("de", "few", symbols)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(given)], "doc_id long, lang string, source string, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(df, ["doc_id"]).collect()}
    assert len(got) == len(given) and not any(r["base_failed"] for r in got.values())
    assert [got[i]["kept"] for i in range(len(given))] == [t == clean for _, _, t in given]


def test_limits_differ_by_group_and_equal_the_sql(spark, tmp_path):
    """Languages with words of other lengths, a source of which 40 % is symbol
    junk, groups too small for a say, nulls, texts that fail the base rules."""
    from oracle_compare import compare, duck

    rnd = random.Random(12)

    def text(sizes, n=60):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.choice(sizes))) for _ in range(n))

    given = [("en", "a", text((3, 4, 5))) for _ in range(400)] + [("de", "b", text((7, 8, 9))) for _ in range(300)]
    given += [("en", "c", text((3, 4, 5)) + " #$%&" * (rnd.randrange(5, 20) if i % 5 < 2 else 0)) for i in range(300)]
    given += [("de", "b", text((3, 4, 5))) for _ in range(3)] + [("en", "a", text((20, 30))), ("fr", None, text((4, 5))), (None, None, text((3, 4))), (None, "a", None), ("en", "a", "few words"), ("fr", "d", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(given)], "doc_id long, lang string, source string, text string")
    df.toPandas().to_parquet(tmp_path / "documents.parquet")
    out = compare(spark, duck(str(tmp_path)), "op10", quality_rules.query, quality_rules.ORACLE, str(tmp_path))
    assert out["columns_match"] and out["values_match"] and out["spark_rows"] == len(given), out
    limits = {(r["lang"], r["source"]): r for r in quality_rules.thresholds(quality_rules.sketch(quality_rules.measure(df))).collect()}
    assert limits["en", "a"]["max_word_length"] < limits["de", "b"]["min_word_length"]
    assert limits["en", "c"]["max_symbols"] == limits["en", "a"]["max_symbols"]  # the junk does not raise its source's
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df, ["doc_id"]).collect()}
    assert all(kept[i] == ("#" not in given[i][2]) for i in range(1000)) and not any(kept[i] for i in range(1000, 1004))


def test_rows_of_one_id_with_other_texts_stay(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma delta"), (1, "one two three four five six"), (1, "alpha beta gamma delta"), (2, "alpha beta gamma delta")], "doc_id long, text string")
    df = df.selectExpr("*", "'mine' as text_hash", "'own' as _text_hash")
    kept = simhash.keep_first(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "alpha beta gamma delta"), (1, "one two three four five six")]
    assert {(r["text_hash"], r["_text_hash"]) for r in kept} == {("mine", "own")}
    rules = df.selectExpr("doc_id", "concat(text, ' ', repeat('several words of text ', 1), array_join(transform(sequence(1, 40), x -> concat('w', x)), ' ')) as text", "'en' as lang", "'s' as source", "text_hash")
    assert {r["text_hash"] for r in quality_rules.keep(rules).collect()} == {"mine"}


def test_pipeline_filters_keep_what_the_operators_say(spark, small):
    """The first and third stage against the operators' own proofs: the rules'
    SQL, and the components of plainly computed links."""
    import corpus_pipeline as P
    from oracle_compare import duck

    docs = P.table(spark, small, "documents")
    by_sql = {r[0] for r in duck(small).execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}
    first = P.written(P.rules(spark, docs, small))
    assert {r["doc_id"] for r in first.collect()} == by_sql
    second = P.written(P.quality(spark, first, small))
    fp = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.near_duplicates(second).collect()}
    group = {d: d for d in fp}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    ids = sorted(fp)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if bin(fp[a] ^ fp[b]).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    assert sorted(r["doc_id"] for r in P.near_duplicates(spark, second, small).collect()) == sorted({find(d) for d in ids})


def test_pipeline(spark, small):
    import corpus_pipeline as P

    docs = P.table(spark, small, "documents")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        before = docs.count()
        docs = P.written(stage(spark, docs, small))
        assert docs.columns == columns and 0 < docs.count() <= before, name
    assert P.pack(spark, docs, small).where("piece = 0").count() == docs.count()
