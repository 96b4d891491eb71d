"""The index-keyed LIKE join equals a brute-force LIKE on small inputs."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from driftlens.operators.stored import like_join, stored

ALPHABET = "ab_c%.:1"


def brute(spark, pats, names):
    p = spark.createDataFrame([(i, x) for i, x in enumerate(pats)], "pid int, pattern string")
    n = spark.createDataFrame([(j, x) for j, x in enumerate(names)], "nid int, name string")
    # the reference semantics, evaluated pair by pair (test only)
    return Counter((r["pid"], r["nid"]) for r in p.crossJoin(n).where("name LIKE pattern").collect())


def keyed(spark, pats, names):
    p = spark.createDataFrame([(i, x) for i, x in enumerate(pats)], "pid int, pattern string")
    n = spark.createDataFrame([(j, x) for j, x in enumerate(names)], "nid int, name string")
    return Counter((r["pid"], r["nid"]) for r in like_join(p, "pattern", n, "name").collect())


def test_fixed_cases(spark):
    names = ["redshift_dev:tpch.public.t_123", "redshift_dev:tpch.public.t_223", "redshift_dev:tpch.public.t_23", "abc", "", "a%c", "a_c"]
    pats = ["redshift_dev:tpch.public.t__23", "%", "", "a_c", "a\\_c", "a\\%c", "%23", "red%", "%pch.pub%", "___", "%_%", "t_1%"]
    assert keyed(spark, pats, names) == brute(spark, pats, names)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    pats=st.lists(st.text(alphabet=ALPHABET, max_size=7), min_size=1, max_size=6),
    names=st.lists(st.text(alphabet="abc_.:1%", max_size=9), min_size=1, max_size=10),
)
def test_random_patterns(spark, pats, names):
    assert keyed(spark, pats, names) == brute(spark, pats, names)


def test_stored_like_and_eq(spark):
    from helpers import snap

    b = snap(spark, [(9, "pg:db.s.t_1", "a", "int", "yes", None, 1), (9, "pg:db.s.tx1", "a", "int", "yes", 0, 1)]).drop("config_id")
    b = b.withColumn("config_id", b.ordinal_position.cast("long"))
    e = spark.createDataFrame([(5, "pg:db.s.t_1"), (6, "PG:DB.S.TX1")], "config_id long, table_name string")
    like = sorted((r["config_id"], r["table_name"]) for r in stored(b, e, match="like").collect())
    assert like == [(5, "pg:db.s.t_1"), (5, "pg:db.s.tx1")]  # B3: '_' is a wildcard
    eq = sorted((r["config_id"], r["table_name"], r["character_maximum_length"]) for r in stored(b, e).collect())
    assert eq == [(5, "pg:db.s.t_1", 0), (6, "pg:db.s.tx1", 0)]


def test_candidates_follow_matches_when_names_share_long_prefixes(spark):
    """Wildcard entries of one connector: candidates are the matches, not
    names x patterns."""
    from driftlens.functions.like import kinds, name_keys, pattern_keys

    for schemas in (20, 40):
        names = spark.range(schemas * 50).selectExpr(f"concat('snowflake:cat.s', id % {schemas}, '.t', id) as _name")
        pats = spark.range(schemas).selectExpr("concat('snowflake:cat.s', id, '.%') as _pattern")
        keys = name_keys(names, kinds(pats))
        candidates = pattern_keys(pats).join(keys, "_k").count()
        assert candidates == schemas * 50


def test_escape_of_a_plain_character(spark):
    from driftlens.operators.stored import like_join

    left = spark.createDataFrame([("a\\bcd",), ("a\\_c",), ("x%",), ("a\\\\b",)], "p string")
    right = spark.createDataFrame([("abcd",), ("a_c",), ("abc",), ("xyz",), ("a\\b",)], "n string")
    got = {(r["p"], r["n"]) for r in like_join(left, "p", right, "n").collect()}
    assert got == {("a\\bcd", "abcd"), ("a\\_c", "a_c"), ("x%", "xyz"), ("a\\\\b", "a\\b")}


def test_a_pattern_of_another_shape_changes_no_other_keys(spark):
    from driftlens.functions.like import kinds, name_keys, pattern_keys

    pats = spark.createDataFrame([("a.b_%",), ("%_z",), ("___",), ("x_y",)], "_pattern string")
    more = pats.unionByName(spark.createDataFrame([("%abc%",), ("%",)], "_pattern string"))
    names = spark.createDataFrame([("a.bcd",), ("xaby",), ("abz",), ("x1y",)], "_name string")
    before, after = (Counter((r[0], r[1]) for r in pattern_keys(p).collect()) for p in (pats, more))
    assert before == Counter({k: n for k, n in after.items() if k[0] not in ("%abc%", "%")})
    few, all_ = (Counter((r[0], r[1]) for r in name_keys(names, kinds(p)).collect()) for p in (pats, more))
    assert not few - all_
    assert kinds(more) == sorted([("P", 3), ("S", 1), ("L", 0), ("P", 1), ("G", 3), ("A", 0)])


def test_a_prefix_that_every_name_has_takes_no_name_along(spark):
    """All names and patterns share one key; patterns keep their own suffix, so
    no row of the shared key comes to the join, and no task gets them all."""
    from driftlens.functions.like import lengths, name_keys, pattern_keys
    from driftlens.operators.stored import key_counts, least_frequent, without_idle_keys

    names = spark.range(1000, 3000).selectExpr("concat('src:c.s.t_', id) as _name")
    pats = spark.range(1000, 3000).selectExpr("concat('src_c.s.t_', id) as _pattern")
    klens = lengths(pats)
    pk, nk = pattern_keys(pats), name_keys(names, sorted(klens), klens=klens)
    assert nk.count() == 2 * 2000  # the prefix and the suffix, by the one length that occurs
    counts = key_counts(pk, nk)
    assert sorted((r["_freq"], r["_asked"]) for r in counts.collect()) == [(1, 1)] * 2000 + [(2000, 2000)]
    best = least_frequent(pk, counts, common=100)
    assert Counter(r["_freq"] for r in best.collect()) == {1: 2000}
    rows = without_idle_keys(nk, counts, best, common=100)
    assert rows.count() == 2000 and rows.distinct().count() == 2000


def test_common_keys_change_no_pair(spark):
    names = ["redshift_dev:tpch.public.t_123", "redshift_dev:tpch.public.t_223", "redshift_dev:x", "abcabc", "abc", "", "a%c", "aaaa", None, "abc"]
    pats = ["redshift_dev:tpch.public.t__23", "red%", "%abc%", "%", "", "abc", "a_c", "___", "%aa%", "red%3", None, "%", "zz%", "zz%1", "zz%2"]
    p = spark.createDataFrame([(i, x) for i, x in enumerate(pats)], "pid int, pattern string")
    n = spark.createDataFrame([(j, x) for j, x in enumerate(names)], "nid int, name string")
    want = brute(spark, pats, names)
    for common in (0, 1, 2, 100):
        got = Counter((r["pid"], r["nid"]) for r in like_join(p, "pattern", n, "name", common).collect())
        assert got == want
