"""Operator 10: quality rules with thresholds learnt from the corpus.

Every text gets whole-number features. Those of texts that pass the base rules
are kept per (language, source) as quantile sketches: counts per value of a
scale of at most 1,001, which merge by adding, so the sketch of a language is
the sum of its sources' and any order of merging gives the same numbers. From a
sketch's quantiles come its fences, a largest or smallest value or both. A
group's thresholds are the narrowest of the fences of its own sketch, its
language's and the corpus's, widened by a tolerance, so that a source full of
junk does not raise its own; sketches of few documents have no say, except the
corpus's. Documents then meet their group's thresholds in a join.

All of it is column expressions; sketches are pre-aggregated before they are
shuffled, and the join is salted, as one source may hold most documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from driftlens.llm.common import SPACE, checkpoint, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: feature -> (lower quantile, upper quantile, spread, tolerance, smallest?, largest?).
#: Fences lie ``spread`` times the quantiles' distance outside of them. Symbols
#: and repeated lines are nearly always none in clean text, so that what they
#: may reach is mostly the tolerance, unless a corpus is full of them.
FENCES = {
    "symbols": (25, 75, 3, 20, False, True),
    "dup_lines": (25, 99, 0, 200, False, True),
    "word_length": (25, 75, 6, 20, True, True),
    "variety": (25, 75, 3, 100, True, False),
}
#: Sketches of fewer documents give no fence (the corpus's always does).
MIN_GROUP = 100
SALTS = 32


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more.

    Windows are compared by a 64-bit hash. Texts without a repeated window
    (the usual case) end at the distinct count; in the others, sorting puts
    equal windows side by side and one pass adds up what they cover.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))

    def covered(h: Column) -> Column:
        def places(s: Column) -> Column:
            def twin(e: Column, j: Column) -> Column:
                same = [F.coalesce(F.get(s, j + d)["h"] == e["h"], F.lit(False)) for d in (-1, 1)]
                return same[0] | same[1]

            return F.array_sort(F.transform(F.filter(s, twin), lambda e: e["i"]))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        in_order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.aggregate(
            let(in_order, places), start,
            lambda a, i: F.struct((i + size).alias("end"), (a["n"] + i + size - F.greatest(i, a["end"])).alias("n")), lambda a: a["n"],
        )

    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(w) >= size, count).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words and n_distinct (words) to ``docs``; null text has no words."""
    text = F.coalesce("text", F.lit(""))
    inner = docs.withColumn("_words", words(F.col("text"))).withColumn("_lines", F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    return inner.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
    )


#: feature -> (part, whole, scale): its value is scale * part / whole, at most
#: 1,000 (symbols, repeated lines and distinct words in per mille; hundredths of
#: a character a word).
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000),
    "word_length": ("word_chars", "n_words", 100),
    "variety": ("n_distinct", "n_words", 1000),
}

BASE_FAILED = (f"n_words < {MIN_WORDS}", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def _ratio(feature: str) -> Column:
    part, whole, scale = RATIOS[feature]
    return F.when(F.col(whole) > 0, F.least(F.floor(F.col(part) * scale / F.col(whole)), F.lit(1000))).otherwise(0).cast("long")


def sketch(measured: DataFrame) -> DataFrame:
    """Counts of each value per (lang, source, feature), of texts that pass the base rules."""
    values = F.array(*[F.struct(F.lit(f).alias("feature"), _ratio(f).alias("value")) for f in RATIOS])
    passing = measured.where(~F.expr(" OR ".join(BASE_FAILED)))
    return passing.select("lang", "source", F.inline(values)).groupBy("lang", "source", "feature", "value").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """Merges sketches to the given keys."""
    return sketches.groupBy(*keys, "feature", "value").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *keys: str) -> DataFrame:
    """Per group and feature: total, lowest and highest (null: no such fence)."""
    by = Window.partitionBy(*keys, "feature")
    ranked = sketches.withColumn("upto", F.sum("n").over(by.orderBy("value"))).withColumn("total", F.sum("n").over(by))

    def of(feature: str) -> tuple[Column, Column]:
        low, high, spread, _, smallest, largest = FENCES[feature]
        a, b = (F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("value"))) for q in (low, high))
        here = F.col("feature") == feature
        return F.when(here & F.lit(smallest), a - spread * (b - a)), F.when(here & F.lit(largest), b + spread * (b - a))

    each = [of(f) for f in FENCES]
    return ranked.groupBy(*keys, "feature").agg(F.max("total").alias("total"), F.coalesce(*[lo for lo, _ in each]).alias("lowest"), F.coalesce(*[hi for _, hi in each]).alias("highest"))


def thresholds(sketches: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source): min_ and max_ of each feature, where it has one."""
    merged = checkpoint(sketches)
    own = fences(merged, "lang", "source")
    of_lang = fences(merge(merged, "lang"), "lang").select(F.col("lang").alias("l_lang"), F.col("feature").alias("l_feature"), F.col("total").alias("l_total"), F.col("lowest").alias("l_lowest"), F.col("highest").alias("l_highest"))
    of_all = fences(merge(merged)).select(F.col("feature").alias("a_feature"), F.col("lowest").alias("a_lowest"), F.col("highest").alias("a_highest"))
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("feature") == F.col("l_feature"))).join(F.broadcast(of_all), F.col("feature") == F.col("a_feature"))
    enough, l_enough = F.col("total") >= min_group, F.col("l_total") >= min_group
    # greatest and least pass over nulls
    lowest = F.greatest(F.when(enough, F.col("lowest")), F.when(l_enough, F.col("l_lowest")), F.col("a_lowest"))
    highest = F.least(F.when(enough, F.col("highest")), F.when(l_enough, F.col("l_highest")), F.col("a_highest"))
    limits = []
    for f, (_, _, _, tolerance, smallest, largest) in FENCES.items():
        here = F.col("feature") == f
        limits += [F.max(F.when(here, lowest - tolerance)).alias(f"min_{f}")] * smallest + [F.max(F.when(here, highest + tolerance)).alias(f"max_{f}")] * largest
    return joined.groupBy("lang", "source").agg(*limits)


def judge(docs: DataFrame, key: list[str]) -> DataFrame:
    """``key``, the measures and base_failed, kept for every row of ``docs``.

    Null language or source is a group like any other; null text has no words
    and fails the base rules, as does empty text; repeated rows get a row each;
    further columns are left out. An empty table gives an empty result.
    """
    measured = checkpoint(measure(docs.select(*dict.fromkeys([*key, "lang", "source", "text"]))).drop("text"))
    limit = thresholds(sketch(measured)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    limit = limit.withColumnRenamed("lang", "t_lang").withColumnRenamed("source", "t_source")
    salted = measured.withColumn("salt_", F.pmod(F.xxhash64(*key, "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = salted.join(limit, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("salt_") == F.col("salt")), "left")
    base = F.expr(" OR ".join(BASE_FAILED))
    fits = ~base  # a group of which no text passes the base rules has no thresholds and needs none
    for f, (*_, smallest, largest) in FENCES.items():
        if smallest:
            fits = fits & (_ratio(f) >= F.col(f"min_{f}"))
        if largest:
            fits = fits & (_ratio(f) <= F.col(f"max_{f}"))
    return joined.select(*key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), fits.alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. A row is known
    by id, language, source and a hash of its text, nulls included; rows alike
    in these are judged alike. An empty table stays empty."""
    named = docs.withColumn("__llm_text_hash", F.xxhash64("text"))
    key = ["doc_id", "lang", "source", "__llm_text_hash"]
    bad = judge(named, key).where(~F.col("kept")).select(*[F.col(k).alias(f"b_{k}") for k in key])
    same = [named[k].eqNullSafe(F.col(f"b_{k}")) for k in key]
    return named.join(bad, same, "left_anti").select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    from driftlens.llm.common import table

    return judge(table(spark, sf_dir, "documents"), ["doc_id"])


def _oracle() -> str:
    def value(f: str) -> str:
        part, whole, scale = RATIOS[f]
        return f"CAST(CASE WHEN {whole} > 0 THEN least({part} * {scale} // {whole}, 1000) ELSE 0 END AS BIGINT)"

    def fence(name: str, keys: str) -> str:
        by, group = (f"PARTITION BY {keys}, feature", f"{keys}, feature") if keys else ("PARTITION BY feature", "feature")
        quantile = "min(CASE WHEN upto * 100 >= total * {} THEN value END)"
        lows, highs = [], []
        for f, (low, high, spread, _, smallest, largest) in FENCES.items():
            a, b = quantile.format(low), quantile.format(high)
            lows.append(f"WHEN '{f}' THEN {f'{a} - {spread} * ({b} - {a})' if smallest else 'NULL'}")
            highs.append(f"WHEN '{f}' THEN {f'{b} + {spread} * ({b} - {a})' if largest else 'NULL'}")
        return f"""{name} AS (SELECT {group}, max(total) AS total, CASE feature {" ".join(lows)} END AS lowest, CASE feature {" ".join(highs)} END AS highest
            FROM (SELECT {group}, value, sum(n) OVER ({by} ORDER BY value) AS upto, sum(n) OVER ({by}) AS total FROM (SELECT {group}, value, sum(n) AS n FROM sk GROUP BY {group}, value)) GROUP BY {group})"""

    limit = "(SELECT {} FROM t WHERE t.lang IS NOT DISTINCT FROM v.lang AND t.source IS NOT DISTINCT FROM v.source AND feature = '{}')"
    fits = []
    for f, (_, _, _, tolerance, smallest, largest) in FENCES.items():
        fits += [f"v_{f} >= {limit.format('lowest', f)} - {tolerance}"] * smallest + [f"v_{f} <= {limit.format('highest', f)} + {tolerance}"] * largest
    sketches = " UNION ALL ".join(f"SELECT lang, source, '{f}' AS feature, v_{f} AS value, count(*) AS n FROM v WHERE NOT base_failed GROUP BY ALL" for f in RATIOS)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, list_filter(string_split_regex(text, '{SPACE}'), lambda x: x <> '') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
    win AS (SELECT r, i, array_to_string(ws[i:i+{WINDOW - 1}], ' ') AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW})),
    rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM win) WHERE c > 1), range({WINDOW}) AS t(k) GROUP BY r),
    m AS (SELECT d.doc_id, d.lang, d.source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct,
                 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
          FROM d JOIN w USING (r) LEFT JOIN rep USING (r)),
    v AS (SELECT *, {", ".join(f"{value(f)} AS v_{f}" for f in RATIOS)}, {" OR ".join(BASE_FAILED)} AS base_failed FROM m),
    sk AS ({sketches}),
    {fence("f_own", "lang, source")}, {fence("f_lang", "lang")}, {fence("f_all", "")},
    t AS (SELECT o.lang, o.source, o.feature,
           greatest(CASE WHEN o.total >= {MIN_GROUP} THEN o.lowest END, CASE WHEN l.total >= {MIN_GROUP} THEN l.lowest END, a.lowest) AS lowest,
           least(CASE WHEN o.total >= {MIN_GROUP} THEN o.highest END, CASE WHEN l.total >= {MIN_GROUP} THEN l.highest END, a.highest) AS highest
          FROM f_own o JOIN f_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.feature = l.feature JOIN f_all a ON o.feature = a.feature)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(fits)} AS kept
    FROM v"""


ORACLE = _oracle()
