"""Operators on pages, and every SQL oracle on small data."""

import time

import pytest
from oracle_compare import compare, duck

from driftlens.llm import html, queries, urls, warc


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, small, name):
    out = compare(spark, duck(small), name, queries.QUERIES[name], queries.ORACLE[name], small)
    assert out["columns_match"] and out["values_match"] and out["spark_rows"] == out["oracle_rows"], out


def pages(spark, texts):
    return spark.createDataFrame([(i, f"http://a/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")


def test_main_text():
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>A long first paragraph with <b>bold</b> words, and many of them.
    <p>Short.</p><div class=ad>Buy</div><p>Another long paragraph&nbsp;that ends<br>here.</p><form><p>Your name</p></form></article>
    <div id="comments"><p>A reader's very long comment that says nothing of worth at all.</p></div><footer>&copy; me</footer>"""
    assert html.main_text(page) == "Head & line\nA long first paragraph with bold words, and many of them.\nShort.\nAnother long paragraph that ends here."
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>only</nav>") == ""
    assert html.main_text("<div><p>One paragraph in a page without an article.</p><p>Two.</p></div><div class=sidebar>x</div>").endswith("Two.")
    assert html.main_text("<p>cut off &am") == "cut off &am"


def test_main_text_keeps_headline_lead_and_every_article():
    body = [f"Paragraph {i} " + "with many words of the text " * 14 for i in range(3)]
    paragraphs = "".join(f"<p>{p}</p>" for p in body)
    kept = [" ".join(p.split()) for p in body]
    page = f"<body><div class=top><span>Site</span></div><div id=content><h1>Title</h1><p>Lead.</p><div class=body>{paragraphs}</div><p>End.</p></div><div>Other</div></body>"
    assert html.main_text(page).split("\n") == ["Title", "Lead.", *kept, "End."]
    for first, later in ((2, 3), (3, 2)):
        one, two = paragraphs * first, paragraphs * later
        page = f"<body><div>Site</div><main><article><h2>One</h2>{one}</article><article><h2>Two</h2>{two}</article></main><div>Other</div></body>"
        assert html.main_text(page).split("\n") == ["One", *kept * first, "Two", *kept * later]
    page = f"<body><div>Site</div><article><h2>Own</h2>{paragraphs}<article><h2>Inner</h2>{paragraphs * 2}</article></article><div>Other</div></body>"
    assert html.main_text(page).split("\n") == ["Own", *kept, "Inner", *kept * 2]


def test_extract_rows(spark):
    df = pages(spark, [None, "", "<p>a</p>", "<p>" + "x " * 200_000]).selectExpr("*", "1 as text", "2 as n_chars")
    got = {r[0]: r for r in html.extract(df).collect()}
    assert got[0]["text"] == got[1]["text"] == "" and got[2]["n_chars"] == 1 and got[3]["n_chars"] == 399_999
    assert html.extract(df.where("1 = 0")).count() == 0


def test_urls(spark):
    given = [None, "no scheme", "http://X.Example.NET/en/a", "https://b.net/x", "https://net", "http://example.com/de/?q", "http://a.org/fr/", "http://casino-win.org/", "http://casinos1.org", "http://free.org/bets?x", "http://a.com/free?bets", "www.casino-porn.com/x", "http://a.com/?q=viagra", "http://a.com/#porno", "http://a.com/" + "y/" * 50_000 + "xxx", ""]
    df = spark.createDataFrame([*enumerate(given), (None, "http://casino.org/"), (None, None), (7, given[7])], "page_id long, url string").selectExpr("*", "'z' as host", "'z' as rule")
    assert urls.judge(df).count() == len(given) + 3 and urls.judge(df.where("1 = 0")).count() == 0
    assert [r["verdict"] for r in urls.judge(df.where("page_id is null")).orderBy("host").collect()] == ["allow", "block"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(df).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("x.example.net", "/en/a", "example.net/en/", "allow") and got[3][2:] == ("net/", "block") and got[4] == ("net", "", None, "allow")
    assert got[5][2:] == ("example.com/de/", "block") and got[6][2:] == ("org/fr/", "allow")
    assert [got[i][3] for i in (7, 8, 9, 10)] == ["block", "allow", "block", "block"]
    assert got[11] == ("", "", None, "block") and [got[i][3] for i in (12, 13, 14, 15)] == ["block", "block", "block", "allow"]


def test_warc_round_trip(spark, tmp_path):
    big = "é\r\n\r\nWARC/1.1\r\n" * 40_000
    given = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, big, big, "\x00\x01" * 80]
    df = pages(spark, given).selectExpr("*", "'q' as refers_to", "1 as sha").repartition(3)
    got = {r["page_id"]: r for r in warc.round_trip(df).collect()}
    assert [got[i]["payload_bytes"] for i in range(9)] == [len((g or "").encode()) for g in given]
    assert [got[i]["refers_to"] for i in range(9)] == [None, None, None, None, None, 4, None, 6, None]
    assert warc.round_trip(df.where("1 = 0")).count() == 0
    listed = warc.write(warc.revisits(df.drop("refers_to")), str(tmp_path / "w"), archive_bytes=1000)
    chunks = warc.read(listed, chunk=4096).where("record_id = 'urn:page:6'").orderBy("chunk").collect()
    assert len(chunks) > 10 and max(len(c["data"]) for c in chunks) <= 4096 and b"".join(c["data"] for c in chunks).decode() == big


BODY = [f"Paragraph {i} " + "with many words of the text " * 14 + "end." for i in range(3)]
TEXT = "<h1>Head</h1>" + "".join(f"<p>{b}</p>" for b in BODY)
STORIES = "".join(f"<li><a href=x>Other story number {i}</a></li>" for i in range(6))
#: Ways to hold the text; {} is the text, [] furniture inside it.
HOLDERS = [
    "<article>{}[]</article>", "<main>{}[]</main>", '<article class="post share-story">{}[]</article>', '<article class="post no-sidebar"><div class=body>{}[]</div></article>',
    '<form action="/"><article>{}[]</article></form>', '<div class="widget"><main>{}[]</main></div>', '<div id="related-work"><article>{}[]</article></div>', "<main><article>{}[]</article></main>",
]
INSIDE = ["", "<div class=ad>Buy now</div>", f"<ul>{STORIES}</ul>", '<div class="comment-list"><p>' + "A reader says a lot. " * 40 + "</p></div>", "<form><p>Your name</p><input></form>", '<section id="newsletter_signup"><p>Join us</p></section>']
#: Holders of a page without article and main.
PLAIN_HOLDERS = ["<div>{}</div>", "<div class='post no-sidebar'>{}</div>", "<div class='share-story'>{}</div>", "<form><div>{}</div></form>", "<table><tr><td>{}</td></tr></table>", "<section><div><div>{}</div></div></section>"]


@pytest.mark.parametrize("page", [h.replace("{}", TEXT).replace("[]", i) for h in HOLDERS for i in INSIDE] + [h.replace("{}", TEXT) for h in PLAIN_HOLDERS])
def test_page_shapes(page):
    page = f"<html><head><title>t</title></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class=ad>Buy</div>{page}<div class=sidebar>Side</div><footer>Foot</footer></body></html>"
    assert html.main_text(page).split("\n") == ["Head", *BODY]


def test_ratios_decide(monkeypatch):
    page = f"<body><article>{TEXT}<ul>{STORIES}</ul><div class=ad>Buy now</div></article></body>"
    assert html.main_text(page).split("\n") == ["Head", *BODY]
    monkeypatch.setattr(html, "threshold", lambda values: float("-inf"))
    assert "Other story" in html.main_text(page) and "Buy now" in html.main_text(page)


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<div>x" * 50_000 + "</section>" * 50_000, "<div><p>x" * 50_000])
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    assert html.main_text(page)
    assert time.perf_counter() - start < 20
