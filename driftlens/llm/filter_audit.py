"""Operator 12: how filters interact, over every order they can be applied in.

Each document is reduced to a mask of the filters that it fails, and documents
of a part with one mask are a cell: a part has at most 32 cells whatever its
size. A recursive CTE enumerates the orders: from the empty prefix, each level
extends every prefix by each letter it has not used, joins the part's cells,
carries the bits applied so far and emits the metrics of that step. Prefixes
that orders share are worked out once (325 a part).

Filter E compares texts across the table. Only digests meet: rows alike in
(digest, part, mask, labels) are counted before any shuffle on the digest, so a
text that a third of all rows share costs one row a part and label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint, table, values

FILTERS = "ABCDE"
#: A fails under so many words.
MIN_WORDS = 200
#: B fails under so many per cent of distinct words.
MIN_DISTINCT = 50
#: C fails over so many per cent of capitals.
MAX_CAPITALS = 2
#: D fails on any of these.
SYMBOLS = b"#$%&*|"

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_INSIDE = bytes(range(0x80, 0xC0))  # bytes that continue a code point


def failed(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits."""
    w = text.split()  # bytes split at ASCII white space only
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _INSIDE))
    return (
        (len(w) < MIN_WORDS)
        | (100 * len(set(w)) < MIN_DISTINCT * len(w)) << 1
        | (100 * capitals > MAX_CAPITALS * points) << 2
        | any(s in text for s in SYMBOLS) << 3
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (A to D), digest of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for text in values(batch, 2):
                masks.append(failed(text))
                digests.append(hashlib.sha256(text).digest())
            columns = [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), part, text).mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (A to E), docs, good, toxic: at most 32 rows a part.

    Labels meet documents on the id and its hash. The hash changes no match;
    with it both sides of the join are plain shuffles, which AQE can split
    should one id hold many of the rows.
    """
    label = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    label = label.withColumn("id_hash", F.xxhash64("doc_id"))
    rows = measure(docs).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    rows = rows.withColumn("id_hash", F.xxhash64("doc_id")).join(label, ["doc_id", "id_hash"], "left").na.fill(False, ["good", "toxic"])
    known = F.col("doc_id").isNotNull()
    alike = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(~known, F.col("n"))).alias("n_unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    alike = checkpoint(alike)
    # E spares the rows that hold the smallest id of their text, and rows without an id
    of_text = alike.groupBy("digest").agg(F.min("first.doc_id").alias("smallest")).withColumn("digest_hash", F.xxhash64("digest"))
    met = alike.withColumn("digest_hash", F.xxhash64("digest")).join(of_text, ["digest", "digest_hash"])
    spared = F.coalesce("n_unknown", F.lit(0)) + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    both = F.array(F.struct(F.col("mask"), spared.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - spared).alias("n")))
    each = met.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return each.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )


# A cell is removed at a step if it fails the step's filter and none before;
# redundant if it fails that filter too, but an earlier one has removed it.
_SUM = "aggregate(c.cells, 0L, (s, x) -> s + if({when}, x.{of}, 0L))"
_GONE, _HIT = "(x.mask & w.applied) <> 0", "(x.mask & w.bit) <> 0"
_STEPS = "array<struct<kept:bigint,removed:bigint,redundant:bigint,unique_fails:bigint,good_lost:bigint,toxic_lost:bigint>>"
_METRICS = {
    "kept": _SUM.format(when=f"not {_GONE} and not {_HIT}", of="docs"),
    "removed": _SUM.format(when=f"not {_GONE} and {_HIT}", of="docs"),
    "redundant": _SUM.format(when=f"{_GONE} and {_HIT}", of="docs"),
    "unique_fails": _SUM.format(when="x.mask = w.bit", of="docs"),
    "good_lost": _SUM.format(when=f"not {_GONE} and {_HIT}", of="good"),
    "toxic_lost": _SUM.format(when=f"not {_GONE} and {_HIT}", of="toxic"),
}
_WALK = f"""
WITH RECURSIVE walk AS (
  SELECT part, '' AS filter_order, 0 AS applied, CAST(array() AS {_STEPS}) AS steps FROM {{parts}}
  UNION ALL
  SELECT w.part, concat(w.filter_order, w.letter), w.applied | w.bit,
   array_append(w.steps, named_struct({", ".join(f"'{k}', {v}" for k, v in _METRICS.items())}))
  FROM (
    SELECT part, filter_order, applied, steps, substr('{FILTERS}', at + 1, 1) AS letter, shiftleft(1, at) AS bit
    FROM (SELECT *, explode(sequence(0, {len(FILTERS) - 1})) AS at FROM walk) WHERE (applied & shiftleft(1, at)) = 0
  ) w JOIN {{cells}} c ON w.part = c.part
)
SELECT part, filter_order, place + 1 AS step, metrics.* FROM (
  SELECT part, filter_order, posexplode(steps) AS (place, metrics) FROM (SELECT * FROM walk WHERE length(filter_order) = {len(FILTERS)} LIMIT ALL)
)"""


def orders(cell_rows: DataFrame) -> DataFrame:
    """Cells to one row per part, order and step, with every metric. LIMIT ALL
    lifts the session's row limit of a recursion: its rows grow with the parts."""
    packed = checkpoint(cell_rows.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells")))
    return cell_rows.sparkSession.sql(_WALK, parts=packed.select("part"), cells=packed)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    A null text is the empty text and a null source the part ''. Repeated
    documents each count; of rows that share id and text none makes another
    fail E. A row without an id fails no E and makes none fail. A document is
    good (toxic) if any label of its id says so, unlabelled ones are neither.
    An empty table has no part and gives no row. Other columns are ignored.
    """
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    # each filter has one step in each of the part's 120 orders
    every_order = Window.partitionBy("part", letter)
    return orders(cells(docs, labels)).withColumn("shapley", F.sum("removed").over(every_order))


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _oracle() -> str:
    cases = {
        1: f"len(w) < {MIN_WORDS}",
        2: f"100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w)",
        4: f"100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(x)",
        8: f"regexp_matches(x, '[{SYMBOLS.decode()}]')",
        16: "smallest < u.doc_id",
    }
    mask = " + ".join(f"CASE WHEN {c} THEN {bit} ELSE 0 END" for bit, c in cases.items())
    hit, gone = "(c.mask & o.bit) <> 0", "(c.mask & o.applied) <> 0"

    def total(when: str, of: str) -> str:
        return f"CAST(coalesce(sum(c.{of}) FILTER ({when}), 0) AS BIGINT)"

    return f"""
    WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
    u AS (SELECT *, list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w, min(doc_id) OVER (PARTITION BY x) AS smallest FROM t),
    l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
    m AS (SELECT part, {mask} AS mask, l.good, l.toxic FROM u LEFT JOIN l ON u.doc_id = l.doc_id),
    cells AS (SELECT part, mask, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY 1, 2),
    letters AS (SELECT substr('{FILTERS}', i + 1, 1) AS letter, 1 << i AS bit FROM (SELECT unnest(range({len(FILTERS)}))::INT AS i)),
    walk AS (
      SELECT '' AS filter_order, 0 AS applied, 0 AS step, 0 AS bit, '' AS letter, 0 AS bits
      UNION ALL
      SELECT filter_order || l.letter, w.bits, step + 1, l.bit, l.letter, w.bits | l.bit FROM walk w JOIN letters l ON (w.bits & l.bit) = 0),
    o AS (SELECT * FROM walk WHERE step > 0),
    s AS (SELECT c.part, o.filter_order AS prefix, o.letter, o.step,
       {total(f"NOT {gone} AND NOT {hit}", "docs")} AS kept, {total(f"NOT {gone} AND {hit}", "docs")} AS removed,
       {total(f"{gone} AND {hit}", "docs")} AS redundant, {total("c.mask = o.bit", "docs")} AS unique_fails,
       {total(f"NOT {gone} AND {hit}", "good")} AS good_lost, {total(f"NOT {gone} AND {hit}", "toxic")} AS toxic_lost
      FROM cells c CROSS JOIN o GROUP BY 1, 2, 3, 4),
    e AS (SELECT s.part, f.filter_order, s.step, s.letter, s.kept, s.removed, s.redundant, s.unique_fails, s.good_lost, s.toxic_lost
      FROM s JOIN o f ON f.step = {len(FILTERS)} AND starts_with(f.filter_order, s.prefix))
    SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
     CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM e"""


ORACLE = _oracle()
