"""Stored baseline of each registry entry (the schema_configuration view).

``match="eq"`` (default) joins entries to baseline rows on ``lower(name)``, a
hash join. ``match="like"`` keeps the original ``table_name LIKE <entry name>``
semantics, where ``_`` and ``%`` in a name are wildcards. A LIKE join is a
theta join; :func:`like_join` evaluates it as an equi-join on index keys
(:mod:`driftlens.functions.like`) followed by an exact ``LIKE`` check, so
each pattern is compared only with names that share its rarest key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.functions.like import escapes_normal, lengths, name_keys, pattern_keys


def _stored_columns(b: DataFrame, config_id) -> list:
    cols = [config_id.alias("config_id"), F.lower(F.col("table_name")).alias("table_name"), F.col("column_name")]
    for c in ("data_type", "ordinal_position", "is_nullable"):
        if c in b.columns:
            cols.append(F.col(c))
    if "character_maximum_length" in b.columns:
        cols.append(F.coalesce(F.col("character_maximum_length"), F.lit(0)).alias("character_maximum_length"))
    return cols


#: Names or patterns with one key above which it is looked up in a broadcast
#: table: so many fit a task, and of all keys few have as many.
COMMON = 100_000


def key_counts(pk: DataFrame, nk: DataFrame) -> DataFrame:
    """(_k, _freq, _asked): names that have and patterns that require each key
    of a pattern."""
    each = nk.select("_k", F.lit(1).alias("_n"), F.lit(0).alias("_p")).unionByName(pk.select("_k", F.lit(0).alias("_n"), F.lit(1).alias("_p")))
    return each.groupBy("_k").agg(F.sum("_n").alias("_freq"), F.sum("_p").alias("_asked")).where(F.col("_asked") > 0)


def least_frequent(pk: DataFrame, counts: DataFrame, common: int = COMMON) -> DataFrame:
    """(_pattern, _k, _freq): each pattern's key that the fewest names have.

    A key that most patterns require (a common prefix) would bring them all
    into one task: the counts of such keys are broadcast, at most one key per
    ``common`` key rows, and patterns meet the other counts by a shuffle in
    which rows with such a key are dealt out by their pattern.
    """
    width = int(pk.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_common = F.greatest("_freq", "_asked") > common
    often = F.broadcast(counts.where(is_common).select("_k", F.col("_freq").alias("_often")))
    rare = counts.where(~is_common).select(F.col("_k").alias("_at"), "_freq")
    found = pk.join(often, "_k", "left").withColumn("_at", F.when(F.col("_often").isNull(), F.col("_k")).otherwise(F.xxhash64("_pattern")))
    found = found.join(rare, "_at", "left").select("_pattern", "_k", F.coalesce("_often", "_freq").alias("_freq"))
    each = found.repartition(width, "_pattern").groupBy("_pattern")
    return each.agg(F.min_by("_k", "_freq").alias("_k"), F.min("_freq").alias("_freq"))


def without_idle_keys(nk: DataFrame, counts: DataFrame, best: DataFrame, common: int = COMMON) -> DataFrame:
    """Names' keys without those that many names have and no pattern kept."""
    hot = counts.where(F.col("_freq") > common).select("_k")
    kept = best.where(F.col("_freq") > common).select("_k").distinct()
    return nk.join(F.broadcast(hot.join(kept, "_k", "left_anti")), "_k", "left_anti")


def like_join(left: DataFrame, pattern_col: str, right: DataFrame, name_col: str, common: int = COMMON) -> DataFrame:
    """Pairs (left row, right row) with ``right.name LIKE left.pattern``.

    Works on distinct patterns and distinct names. Each pattern lists the keys
    it requires; names are expanded to the keys that a pattern's shape can ask
    them for, and keys alone are counted; each pattern keeps its least frequent
    key; candidates come from an equi-join on that key and are checked with
    ``LIKE``. A pattern with no literal at all (``%``) has only the catch-all
    key and meets every name, which is what it matches.
    """
    # Patterns are few bytes but costly per row (a regex compiled per candidate
    # for LIKE), and names grow by their keys; AQE would coalesce such a small
    # shuffle into one or two tasks, so both sides keep the cluster's number of
    # shuffle partitions. Names are dealt out after they are made distinct, by a
    # hash of their own, else that shuffle is taken for the one before.
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pats = left.select(F.col(pattern_col).alias("_pattern")).where(F.col("_pattern").isNotNull()).repartition(width, "_pattern").distinct()
    names = right.select(F.col(name_col).alias("_name")).where(F.col("_name").isNotNull()).distinct().repartition(width, F.xxhash64("_name"))
    klens = lengths(left, pattern_col)
    # one shuffle of the keys serves all their uses
    pk = pattern_keys(pats).repartition(width, F.xxhash64("_pattern"))
    nk = name_keys(names, sorted(klens), klens=klens)
    # A key that nearly every name has (the prefix of one connector) is seldom
    # kept by a pattern; if none keeps it, its rows go nowhere. Neither side of
    # the candidate join is hinted: its sides are plain shuffles, so AQE can
    # split a key that is kept and hot (the catch-all key of '%').
    counts = key_counts(pk, nk)
    best = least_frequent(pk, counts, common)
    nk = without_idle_keys(nk, counts, best, common)
    # a pattern has one key and a name each key once: no pair comes twice
    pairs = (
        best.select("_pattern", "_k", escapes_normal(F.col("_pattern")).alias("_like"))
        .join(nk, "_k", "inner")
        .where(F.expr("_name LIKE _like"))
        .select("_pattern", "_name")
    )
    out = left.join(pairs, left[pattern_col] == pairs["_pattern"], "inner")
    out = out.join(right, out["_name"] == right[name_col], "inner")
    return out.drop("_pattern", "_name")


def baseline_view(baseline: DataFrame, registry: DataFrame, check_type: str = "schema") -> DataFrame:
    """Captured rows with the ``table_name`` their entry is registered under:
    what capture writes, as detection reads it. Rows whose entry is gone from
    the registry belong to no table and are left out."""
    names = registry.where(F.col("check_type") == check_type).select("config_id", "table_name")
    return baseline.drop("table_name").join(names, "config_id")


def stored(baseline_view: DataFrame, entries: DataFrame, match: str = "eq", pattern_col: str = "table_name") -> DataFrame:
    """Baseline rows of every entry, tagged with the entry's ``config_id``.

    ``baseline_view`` has ``table_name`` and the captured attributes;
    ``entries`` has ``config_id`` and ``pattern_col``. When two entries name
    one table, each gets both captured sets, as the original view did.
    """
    b = baseline_view.withColumnRenamed("config_id", "_captured_by")
    if match == "eq":
        e = entries.select(F.col("config_id").alias("_entry_id"), F.lower(F.col(pattern_col)).alias("_entry_name"))
        j = e.join(b, F.lower(b["table_name"]) == e["_entry_name"], "inner")
        return j.select(*_stored_columns(b, F.col("_entry_id")))
    if match == "like":
        e = entries.select(F.col("config_id").alias("_entry_id"), F.col(pattern_col).alias("_entry_pattern"))
        j = like_join(e, "_entry_pattern", b, "table_name")
        return j.select(*_stored_columns(b, F.col("_entry_id")))
    raise ValueError(f"match must be 'eq' or 'like', got {match!r}")
