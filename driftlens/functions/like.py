"""Index keys for joining names against SQL LIKE patterns.

A LIKE join is a theta join; evaluated directly it compares every pattern
with every name. Any name a pattern matches must agree with it on at least
one *key*:

* ``P``: the literal text before the first wildcard (an anchored prefix),
* ``S``: the literal text after the last wildcard (an anchored suffix),
* ``G``: a 3-character run inside a literal segment (used only by patterns
  that have neither a prefix nor a suffix),
* ``L``: for a pattern without ``%``, the exact length alone,
* ``A``: nothing at all (a pattern such as ``%``), which every name has.

Prefix and suffix keys hold the whole literal, however long, and also carry the
exact length when the pattern has no ``%`` (``-1`` otherwise); names get them
only at the literal lengths that occur among the patterns, and those with an
exact length only if a pattern of the name's own length asks. A key is one
``xxhash64`` of (kind, length, text), so a collision only adds a candidate:
every candidate pair is still checked with ``LIKE``.

Which kinds and literal lengths occur is a property of the patterns, read off
them once; a pattern of one shape adds its own keys to the names and changes
those of no other pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
ANY_LEN = -1


def _key(kind: str, klen, text: Column) -> Column:
    klen = F.lit(klen) if isinstance(klen, int) else klen.cast("int")
    return F.xxhash64(F.lit(kind), klen, text)


def pattern_anchors(pattern: Column) -> dict[str, Column]:
    """Length (or -1), literal prefix and literal suffix of a LIKE pattern."""
    has_escape = F.instr(pattern, "\\") > 0
    has_pct = F.instr(pattern, "%") > 0
    klen = F.when(~has_pct & ~has_escape, F.char_length(pattern)).otherwise(F.lit(ANY_LEN))
    # before the first unescaped wildcard, escapes removed
    prefix = F.regexp_replace(F.regexp_extract(pattern, r"^((?:[^\\_%]|\\.)*)", 1), r"\\(.)", "$1")
    # after the last wildcard; skipped when escapes make the right end ambiguous
    suffix = F.when(~has_escape, F.regexp_extract(pattern, r"([^_%]*)$", 1)).otherwise(F.lit(""))
    return {"klen": klen, "prefix": prefix, "suffix": suffix, "has_escape": has_escape}


def _kinds(pattern: Column) -> Column:
    """(kind, literal length) of every key that a pattern can be found by."""
    a = pattern_anchors(pattern)
    inner = F.regexp_extract(pattern, r"[^_%\\]{3}", 0) != ""
    anchored = (a["prefix"] != "") | (a["suffix"] != "")
    exact = a["klen"] >= 0

    def kind(k: str, n, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(k).alias("kind"), (F.lit(n) if isinstance(n, int) else n).cast("int").alias("n")))

    return F.filter(
        F.array(
            kind("P", F.char_length(a["prefix"]), a["prefix"] != ""),
            kind("S", F.char_length(a["suffix"]), a["suffix"] != ""),
            kind("G", GRAM, ~anchored & ~a["has_escape"] & inner),
            kind("L", 0, ~anchored & ~inner & exact),
            kind("A", 0, ~anchored & ~(~a["has_escape"] & inner) & ~(~inner & exact)),
        ),
        lambda x: x.isNotNull(),
    )


def kinds(patterns: DataFrame, pattern_col: str = "_pattern") -> list[tuple[str, int]]:
    """The distinct (kind, literal length) of the patterns' keys: at most two a
    character of a name and three more, whatever the number of patterns."""
    each = patterns.select(F.explode(_kinds(F.col(pattern_col))).alias("k")).select("k.kind", "k.n").distinct()
    return sorted((r["kind"], r["n"]) for r in each.collect())


def lengths(patterns: DataFrame, pattern_col: str = "_pattern") -> dict[tuple[str, int], list[int]]:
    """The patterns' lengths (-1: any) by (kind, literal length) of their keys:
    :func:`kinds`, each with the lengths of name that can have such a key. At
    most two for each pair of lengths, whatever the number of patterns."""
    p = F.col(pattern_col)
    each = patterns.select(pattern_anchors(p)["klen"].alias("klen"), F.explode(_kinds(p)).alias("k")).select("k.kind", "k.n", "klen").distinct()
    out: dict[tuple[str, int], list[int]] = {}
    for r in sorted(each.collect()):
        out.setdefault((r["kind"], r["n"]), []).append(r["klen"])
    return out


def pattern_keys(patterns: DataFrame, pattern_col: str = "_pattern") -> DataFrame:
    """(pattern, key) rows: the keys a pattern requires of any name it matches.
    Each pattern's own shape chooses the kind: its literal ends, else the runs
    inside its literals, else its length, else nothing (the catch-all key)."""
    patterns, p = patterns.select(F.col(pattern_col).alias("_pattern")), F.col("_pattern")
    a = pattern_anchors(p)
    grams = F.flatten(
        F.transform(
            F.filter(F.split(p, "[_%]"), lambda seg: F.char_length(seg) >= GRAM),
            lambda seg: F.transform(F.sequence(F.lit(1), F.char_length(seg) - (GRAM - 1)), lambda i: _key("G", ANY_LEN, F.substring(seg, i, F.lit(GRAM)))),
        )
    )
    has = F.transform(_kinds(p), lambda k: k["kind"])
    ends = F.array(
        F.when(a["prefix"] != "", _key("P", a["klen"], a["prefix"])),
        F.when(a["suffix"] != "", _key("S", a["klen"], a["suffix"])),
    )
    keys = (
        F.when(F.array_contains(has, "G"), grams)
        .when(F.array_contains(has, "L"), F.array(_key("L", a["klen"], F.lit(""))))
        .when(F.array_contains(has, "A"), F.array(_key("A", ANY_LEN, F.lit(""))))
        .otherwise(ends)
    )
    return patterns.select("_pattern", F.explode(keys).alias("_k")).where(F.col("_k").isNotNull())


def escapes_normal(pattern: Column) -> Column:
    """A backslash before a character that needs none is dropped: such a
    pattern means the character itself, but Spark's LIKE refuses it."""
    return F.regexp_replace(pattern, r"(\\[_%\\])|\\(.)", "$1$2")


def name_keys(
    names: DataFrame, occurring: list[tuple[str, int]], name_col: str = "_name", klens: dict[tuple[str, int], list[int]] | None = None
) -> DataFrame:
    """(name, key) rows, each once: the keys by which any pattern could ask for
    a name, of the kinds and lengths that occur among the patterns
    (:func:`kinds`). With ``klens`` (:func:`lengths`) also only at the lengths
    of name that they ask for."""
    names, name = names.select(F.col(name_col).alias("_name")), F.col("_name")
    n = F.char_length(name)
    keys = []
    for kind, m in occurring:
        asked = None if klens is None else klens[kind, m]
        exact = F.lit(True) if asked is None else n.isin([k for k in asked if k != ANY_LEN])
        if kind in "PS":
            text = F.substring(name, 1, m) if kind == "P" else F.substring(name, -m, m)
            keys.append(F.when((n >= m) & exact, _key(kind, n, text)))
            if asked is None or ANY_LEN in asked:
                keys.append(F.when(n >= m, _key(kind, ANY_LEN, text)))
        elif kind == "L":
            keys.append(F.when(exact, _key("L", n, F.lit(""))))
        elif kind == "A":
            keys.append(_key("A", ANY_LEN, F.lit("")))
    each = F.array(*keys) if keys else F.array().cast("array<bigint>")
    if any(kind == "G" for kind, _ in occurring):
        runs = F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: _key("G", ANY_LEN, F.substring(name, i, F.lit(GRAM))))
        each = F.concat(each, F.when(n >= GRAM, runs).otherwise(F.array().cast("array<bigint>")))
    # a repeated 3-gram repeats a key: once each, so that a pattern meets a name
    # only once by the one key it keeps
    return names.select("_name", F.explode(F.array_distinct(each)).alias("_k")).where(F.col("_k").isNotNull())
