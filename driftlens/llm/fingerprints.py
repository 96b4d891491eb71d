"""Operator 1: document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (what ends at a line break or, as
many texts are one long line, at the end of a sentence). Each paragraph is
hashed to a wide vector and the text's fingerprint is their sum modulo powers
of two. So the order of paragraphs does not matter, adding or removing one
adds or subtracts its vector, and fingerprints of parts add up.

The vector has 60 words of 60 bits, summed modulo 2**60. Each word holds two
lanes of 30 bits and a paragraph puts one hash bit into each lane. A text has
less than 2**30 paragraphs, so its lanes do not run over, and the lanes of two
fingerprints tell how many paragraphs they share: seen as signs, the lanes'
product estimates the common part, as in a sign sketch. One more word counts
the paragraphs. Paragraphs are rows and the words are sums, so the engine adds
them up as it does any sums, before any shuffle.

Only built-in column functions are used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlens.llm.common import let, table

PARAGRAPH = r"[^\n.!?]+[.!?]*|[.!?]+"
LANE_BITS, LANES = 30, 2
BITS = LANE_BITS * LANES
WORD = (1 << BITS) - 1
ONES = 1 | 1 << LANE_BITS
LANE = (1 << LANE_BITS) - 1
DIGITS = BITS // 4
#: Halves of a paragraph's MD5 that give LANE_BITS words each: first digit.
HALVES = (1, 17)
WORDS = len(HALVES) * LANE_BITS
#: Documents whose next one is looked up in the same task, about.
BUCKET = 4096
#: Buckets, at most: the table of their first documents is small by this bound.
BUCKETS = 200_000


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.trim(p)), lambda p: p != "")


def digests(text: Column) -> Column:
    return F.transform(paragraphs(text), lambda p: F.md5(p))


def vectors(rows: DataFrame, keys: list[str], digest: str = "digest") -> DataFrame:
    """Sums the vectors of paragraph rows (null digest: none) per ``keys``;
    adds ``vector``, an array of 1 + WORDS longs."""
    hashed = rows.select(*keys, F.col(digest).isNotNull().cast("long").alias("one"), *[F.coalesce(F.conv(F.substring(digest, at, DIGITS), 16, 10).cast("long"), F.lit(0)).alias(f"h{at}") for at in HALVES])
    sums = [F.sum("one").alias("w0")] + [F.sum(F.shiftright(f"h{at}", k).bitwiseAND(F.lit(ONES))).alias(f"w{1 + i * LANE_BITS + k}") for i, at in enumerate(HALVES) for k in range(LANE_BITS)]
    return hashed.groupBy(*keys).agg(*sums).select(*keys, F.array(*[F.col(f"w{i}").bitwiseAND(F.lit(WORD)) for i in range(1 + WORDS)]).alias("vector"))


def fingerprint_groups(docs: DataFrame, *keys: str) -> DataFrame:
    """Fingerprint of all paragraphs of each group of documents."""
    return vectors(docs.select(*keys, F.explode_outer(digests(F.coalesce("text", F.lit("")))).alias("digest")), list(keys))


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of two texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(WORD)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of what is left when b's paragraphs are taken from a."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(WORD)))


def to_string(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda w: F.lpad(F.lower(F.hex(w)), DIGITS, "0")), "")


def squared(a: Column, b: Column | None = None) -> Column:
    """|a - b|^2 (or |a|^2) by the lanes' signs, times the number of lanes."""
    n = a[0] - b[0] if b is not None else a[0]

    def of(d: list[Column]) -> Column:
        parts = [F.lit(2) * x - n for x in d]
        return reduce(lambda p, q: p + q, [p * p for p in parts])

    def lanes(w: Column) -> list[Column]:
        return [F.shiftright(w, LANE_BITS * j).bitwiseAND(F.lit(LANE)) for j in range(LANES)]

    rest = F.slice(a, 2, WORDS)
    if b is None:
        return F.aggregate(rest, F.lit(0).cast("long"), lambda s, w: s + of(lanes(w)))
    pairs = F.zip_with(rest, F.slice(b, 2, WORDS), lambda x, y: of([p - q for p, q in zip(lanes(x), lanes(y))]))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda s, p: s + p)


def likeness(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Share of the paragraphs that two fingerprints have in common, 0 to 1: 1
    for equal ones, else 1 - |a - b|^2 / (|a|^2 + |b|^2), an estimate."""
    whole = (squared(a) if norm_a is None else norm_a) + (squared(b) if norm_b is None else norm_b)
    estimate = F.when(whole > 0, F.greatest(F.lit(0.0), 1 - squared(a, b).cast("double") / whole.cast("double"))).otherwise(0.0)
    return F.when(a == b, F.lit(1.0)).otherwise(estimate)


def listed(numbers: list, kind: str) -> Column:
    """A constant array, in one literal however long it is."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def edges(docs: DataFrame, size: int = BUCKET) -> list[int]:
    """Ids that part the documents into even runs of about ``size``: quantiles
    of the ids, so ids that lie far apart or close together do not matter."""
    buckets = min(BUCKETS, -(-docs.agg(F.count("doc_id")).first()[0] // size))
    if buckets < 2:
        return []
    shares = listed([i / buckets for i in range(1, buckets)], "double")
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(4 * buckets)).alias("q")).first()["q"]
    return sorted(set(found))


def bucket_of(doc_id: Column, parts: list[int]) -> Column:
    """How many of the ordered ``parts`` are at most ``doc_id``: looked up among
    every step-th, then among the step that follows."""
    if not parts:
        return F.when(doc_id.isNotNull(), F.lit(0).cast("long"))
    step = math.isqrt(len(parts)) + 1

    def below(ids: Column) -> Column:
        return F.size(F.filter(ids, lambda e: e <= doc_id))

    base = F.greatest(below(listed(parts[::step], "long")) - 1, F.lit(0)) * step
    return F.when(doc_id.isNotNull(), let(base, lambda b: (b + below(F.slice(listed(parts, "long"), b + 1, F.lit(step)))).cast("long")))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (at, pos, guest, doc_id, text, next_text): bucket, place in it, and
    the text of the next row by (doc_id, text), or of the first row after the
    last.

    Documents are dealt to buckets of consecutive ids, even by their quantiles; each bucket also gets,
    as a guest, the first document of the one after it (the buckets' first ids
    are at most BUCKETS + 1 rows), so texts are shuffled once and no task sees
    them all. Null ids have no place in the order: their next text is empty.
    """
    bucket = bucket_of(F.col("doc_id"), edges(docs))
    spread = -1 - F.pmod(F.xxhash64("text"), F.lit(BUCKETS))
    dealt = docs.withColumn("bucket", F.coalesce(bucket, spread))
    firsts = docs.where("doc_id is not null").groupBy(bucket.alias("b")).agg(F.min("doc_id").alias("first"))
    whole = Window.partitionBy(F.lit(0))
    firsts = firsts.withColumn("before", F.coalesce(F.lag("b").over(whole.orderBy("b")), F.max("b").over(whole)))
    met = dealt.join(F.broadcast(firsts), F.col("bucket") == F.col("b"), "left")
    own = F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before").alias("at"), F.lit(True).alias("guest"))
    places = F.explode(F.when(F.col("doc_id") == F.col("first"), F.array(own, guest)).otherwise(F.array(own)))
    rows = met.select("doc_id", "text", places.alias("place")).select("doc_id", "text", "place.at", "place.guest")
    within = Window.partitionBy("at").orderBy("guest", "doc_id", "text")
    after = F.when(F.col("doc_id").isNotNull(), F.lead("text").over(within))
    return rows.select("at", F.row_number().over(within).alias("pos"), "guest", "doc_id", "text", F.coalesce(after, F.lit("")).alias("next_text"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 2) code points
    replaced by the first as many (or all) of the next document. Null text is
    empty; an empty text's fingerprint is all zero and is like another empty
    one (1.0). Rows that repeat an id follow each other by text; rows without
    an id are followed by an empty text. Further columns are left out; an empty
    table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = in_order(base).withColumn("edited", edited)
    sets = F.array(F.struct(F.lit(0).alias("tag"), digests(F.col("text")).alias("all")), F.struct(F.lit(1).alias("tag"), digests(F.col("edited")).alias("all")))
    keys = ["at", "pos", "guest", "doc_id", "n_chars", "edited_sha256", "tag"]
    tagged = rows.select("at", "pos", "guest", "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.inline(sets))
    summed = vectors(tagged.select(*keys, F.explode_outer("all").alias("digest")), keys).withColumn("norm", squared(F.col("vector")))
    # a row's edited fingerprint stands right behind its own, the next row's after that
    order = Window.partitionBy("at").orderBy("pos", "tag")
    both = F.struct("vector", "norm")
    near = summed.withColumn("of_edited", F.lead(both, 1).over(order)).withColumn("of_next", F.when(F.col("doc_id").isNotNull(), F.lead(both, 2).over(order)))
    near = near.where((F.col("tag") == 0) & ~F.col("guest"))
    none = F.struct(F.array_repeat(F.lit(0).cast("long"), 1 + WORDS).alias("vector"), F.lit(0).cast("long").alias("norm"))
    near = near.withColumn("of_next", F.coalesce("of_next", none))
    return near.select(
        "doc_id", "n_chars", "edited_sha256", to_string(F.col("vector")).alias("fingerprint"), to_string(F.col("of_edited.vector")).alias("edited_fingerprint"),
        *[likeness(F.col("vector"), F.col(f"of_{x}.vector"), F.col("norm"), F.col(f"of_{x}.norm")).alias(f"near_{x}") for x in ("edited", "next")],
    )


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def vec(text: str) -> str:
        paras = f"list_transform(list_filter(list_transform(regexp_extract_all({text}, '{PARAGRAPH}'), lambda p: trim(p)), lambda p: p <> ''), lambda p: md5(p))"
        words = [
            f"list_transform(range({LANE_BITS}), lambda k: CAST(coalesce(list_sum(list_transform(ps, lambda d: (CAST('0x' || substr(d, {at}, {DIGITS}) AS BIGINT) >> k) & {ONES})), 0) % {WORD + 1} AS BIGINT))"
            for at in HALVES
        ]
        return f"(SELECT list_concat([CAST(len(ps) AS BIGINT)], {words[0]}, {words[1]}) FROM (SELECT {paras} AS ps))"

    def norm(a: str, b: str) -> str:
        lane = " + ".join(f"pow(2 * ((({a}[i] >> {LANE_BITS * j}) & {LANE}) - (({b}[i] >> {LANE_BITS * j}) & {LANE})) - ({a}[1] - {b}[1]), 2)" for j in range(LANES))
        return f"list_sum(list_transform(range(2, {2 + WORDS}), lambda i: {lane}))"

    def near(a: str, b: str) -> str:
        whole = f"({norm(a, 'z')} + {norm(b, 'z')})"
        return f"CASE WHEN {a} = {b} THEN 1.0 WHEN {whole} > 0 THEN greatest(0.0, 1 - {norm(a, b)} / {whole}) ELSE 0.0 END"

    def hexed(v: str) -> str:
        return f"array_to_string(list_transform({v}, lambda w: lpad(lower(to_hex(w)), {DIGITS}, '0')), '')"

    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    o AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text)) AS nt FROM d),
    e AS (SELECT *, substr(text, 1, n - n // 2) || substr(nt, 1, n // 2) AS edited FROM o),
    v AS (SELECT doc_id, n, edited, {vec("text")} AS a, {vec("edited")} AS b, {vec("nt")} AS c, list_transform(range({1 + WORDS}), lambda i: CAST(0 AS BIGINT)) AS z FROM e)
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, {hexed("a")} AS fingerprint, {hexed("b")} AS edited_fingerprint,
           CAST({near("a", "b")} AS DOUBLE) AS near_edited, CAST({near("a", "c")} AS DOUBLE) AS near_next
    FROM v"""


ORACLE = _oracle()
