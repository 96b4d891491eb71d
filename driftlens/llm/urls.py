"""Operator 7: URL filter by a weighted vocabulary and by host and path rules.

One pass of an Aho-Corasick automaton over the whole URL finds every term; a find
counts if no letter or digit stands beside it. One strict term rejects, and so
do ``soft_hits`` distinct soft ones. A rule that fits the host and path decides
before the vocabulary, the longest rule first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import values

#: (pattern, verdict): domain, then the start of the path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: One of these rejects a URL.
STRICT = ("casino", "casinos", "cialis", "escorts", "hentai", "porn", "porno", "roulette", "sexcam", "viagra", "xxx")
#: Harmless alone; two different ones reject.
SOFT = ("ads", "adult", "bet", "bets", "betting", "bonus", "cheap", "click", "farm", "free", "jackpot", "loan", "loans", "pills", "poker", "replica", "sex", "spam", "track", "tracker", "win", "x")
SOFT_HITS = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule(host_: Column, path_: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    fits = []
    for pattern, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, start = pattern.partition("/")
        on = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith(slash + start)
        fits.append(F.when(on, F.lit(pattern)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def count_terms(urls: DataFrame, strict=STRICT, soft=SOFT) -> DataFrame:
    """Adds ``strict_hits`` and ``soft_hits``, the distinct terms of each kind
    in the whole ``url`` (null: none), to the columns of ``urls``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema) + ", strict_hits int, soft_hits int"
    at = urls.columns.index("url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in (*strict, *soft):
            automaton.add_word(term, (term, term in strict))
        automaton.make_automaton()
        for batch in batches:
            hard, mild = [], []
            for url in values(batch, at):
                text, found = (url or "").lower(), set()
                for last, (term, is_strict) in automaton.iter(text):
                    first = last - len(term) + 1
                    if not (first and text[first - 1].isalnum()) and not text[last + 1 : last + 2].isalnum():
                        found.add((term, is_strict))
                hard.append(sum(s for _, s in found))
                mild.append(len(found) - hard[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hard, pa.int32()), pa.array(mild, pa.int32())], names=[*batch.schema.names, "strict_hits", "soft_hits"])

    return urls.mapInArrow(run, schema)


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict_hits, soft_hits.

    A null URL or one without ``://`` has an empty host and path and no rule;
    the terms of one without ``://`` count, a null or empty one has none and is
    allowed. Repeated rows and null ids are judged like others, URLs of any
    length are read whole, further columns are not looked at, and an empty
    table gives no rows.
    """
    parsed = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    ruled = count_terms(parsed, strict, soft).withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for pattern, says in rules:
        verdict = F.when(F.col("rule") == pattern, F.lit(says)).otherwise(verdict)
    by_terms = F.when((F.col("strict_hits") > 0) | (F.col("soft_hits") >= soft_hits), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "rule", F.coalesce(verdict, by_terms).alias("verdict"), "strict_hits", "soft_hits")


def oracle_sql(rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> str:
    def hit(term: str) -> str:
        return f"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^\\pL\\pN]){term}([^\\pL\\pN]|$)') AS INT)"

    def fits(pattern: str) -> str:
        domain, slash, start = pattern.partition("/")
        return f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + start}'))"

    longest = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    return f"""
    WITH r AS (SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    c AS (SELECT *, CAST({" + ".join(map(hit, strict))} AS INT) AS strict_hits, CAST({" + ".join(map(hit, soft))} AS INT) AS soft_hits FROM p)
    SELECT page_id, host, path, CASE {" ".join(f"WHEN {fits(p)} THEN '{p}'" for p, _ in longest)} END AS rule,
           CASE {" ".join(f"WHEN {fits(p)} THEN '{v}'" for p, v in longest)}
                WHEN strict_hits > 0 OR soft_hits >= {soft_hits} THEN 'block' ELSE 'allow' END AS verdict,
           strict_hits, soft_hits
    FROM c"""
