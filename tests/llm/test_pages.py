"""Html extraction, url filter, WARC: fixtures, brute force, exact round trips and odd inputs."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from opinio.llm.html_text import extract_pages, main_text
from opinio.llm.urlfilter import RULES, filter_urls, propagate
from opinio.llm.warc import candidate_exits, page_records, ranges, read_warc, write_warc
from opinio.session import scratch_path

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><p>Site of all the news that is fit to print in the whole wide world of ours</p></header>
<nav><ul><li><a href="/a">Menu one</a></li><li>Menu two</li></ul></nav>
<div class="cookie-notice">We use cookies for the best of all the experiences that you can have here.</div>
<article><h1>Title &amp; more</h1><p>The first paragraph of the
 article has enough of the stop words to be decided in the first pass.</p><p>Short one.</p>
<p><b>unclosed of the bold text in the article that is long enough here<br>next line<p>Last of the paragraphs, and it is the end of the story for now.</article>
<div id="comments"><p>I think that this is the best of all the articles that I have read in a year!</p></div>
<aside><p>Related to the story of the day, in the paper of the town for all of you.</p></aside>
<form><label>Name of the person that is asked for in the form of the site</label></form>
<!-- <p>a comment of the author in the page that is not to be seen</p> -->
<footer>&copy; the owners of the site, all of the rights are reserved by them</footer></body></html>"""
TEXT = """Title & more
The first paragraph of the article has enough of the stop words to be decided in the first pass.
Short one.
unclosed of the bold text in the article that is long enough here next line
Last of the paragraphs, and it is the end of the story for now."""


def test_main_text_of_an_article():
    assert main_text(PAGE) == TEXT


def test_density_decides_without_an_article():
    links = " ".join(f'<a href="/{i}">the link of the day {i}</a>' for i in range(9))
    body = "The text of the page is long enough to be seen as the content of it by the rules."
    page = f"<div>{links}</div><div>{body}</div><p>tiny</p><div>{body}</div><div>{links}</div><p>more</p>"
    assert main_text(page) == f"{body}\ntiny\n{body}"  # the last short block is nearest to links


@pytest.mark.parametrize("html", [None, "", "   ", "<nav>only of the menu</nav>", "<script>x", "<!-- open"])
def test_pages_without_text(html):
    assert main_text(html) == ""


def test_broken_markup_is_no_error():
    assert main_text("a < b and <p>1 &lt; 2 &unknown; &#x41;<p class='x") == "a < b and\n1 < 2 &unknown; A"
    deep = "<div>" * 3000 + "<p>The end of the page is the text of it and of the rest." + "</div>" * 3000
    assert main_text(deep).startswith("The end")
    assert len(main_text("<p>" + "of the word " * 200_000)) > 1_000_000


def test_extract_pages_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 7), (1, "u", PAGE, 7), (None, None, None, 0)], "page_id long, url string, html string, text int")
    out = extract_pages(pages).orderBy(F.col("page_id").desc_nulls_last()).collect()
    assert [r["text"] for r in out] == [TEXT, TEXT, ""] and out[0]["n_chars"] == len(TEXT) and out[2]["n_chars"] == 0
    assert extract_pages(pages.limit(0)).count() == 0


# -- url filter ------------------------------------------------------------------------------


def judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = ["http://a.net/x", "HTTP://WWW.Example.NET/en/1?q=/de/", "https://m.example.com/de/2#t", "https://m.example.com/en/2", "http://b.org/fr/",
        "http://b.org", "http://x.net?y", "http://net/", "http://foonet/", "no scheme.net/", "", None, "http:///p", "ftp://É.org/fr/x",
        "x://y://z.net/", "http://example.net/en"]


def test_rules_and_hosts_brute_force(spark):
    pages = spark.createDataFrame([(i, u, None, "h") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    out = {r["page_id"]: r for r in filter_urls(pages).collect()}
    assert len(out) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, action = judge(u)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule), u
        assert out[i]["verdict"] == (action or out[i]["verdict"])
    assert filter_urls(pages.limit(0)).count() == 0


def test_distrust_flows_against_links_and_trust_along(spark):
    rows = [(1, "http://bad.net/", ""), (2, "http://farm.io/1", '<a href="http://bad.net/x">'), (3, "http://farm.io/2", "<a href=//BAD.net>"),
            (4, "http://feeder.io/", "<a class=x href='https://farm.io/'>"), (5, "http://good.org/fr/", '<a href="http://friend.io/">'),
            (6, "http://friend.io/", '<a href="/own">'), (7, "http://lonely.io/", None)]
    out = {r["page_id"]: r for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i]["verdict"] for i in range(1, 8)] == ["block", "block", "block", "block", "allow", "allow", "allow"]
    assert out[2]["distrust"] > out[4]["distrust"] > 0 == out[6]["distrust"] and out[6]["trust"] > 0


def test_propagate_equals_power_iteration(spark):
    links = [("a", "b", 0.5), ("a", "c", 0.5), ("b", "a", 1.0), ("c", "d", 1.0)]
    edges = spark.createDataFrame([("t", *x) for x in links], "kind string, src string, dst string, share double")
    got = {r["host"]: r["rank"] for r in propagate(edges, spark.createDataFrame([("t", "a", 3.0), ("t", "b", 1.0)], "kind string, host string, weight double"),
                                                   tolerance=1e-12, rounds=200).collect()}
    seed = {"a": 0.75, "b": 0.25, "c": 0.0, "d": 0.0}
    x = dict(seed)
    for _ in range(300):
        y = {h: 0.15 * seed[h] for h in x}
        for s, d, w in links:
            y[d] += 0.85 * w * x[s]
        for h in x:
            y[h] += 0.85 * x["d"] * seed[h]
        x = y
    assert all(abs(got[h] - x[h]) < 1e-6 for h in x)


def test_seed_shares_are_dealt_without_one_group_per_kind(spark, monkeypatch):
    from opinio.llm import urlfilter

    plans, write = [], urlfilter.materialise
    monkeypatch.setattr(urlfilter, "materialise", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or write(df, name))
    seeds = spark.createDataFrame([("t", "a", 3.0), ("t", "b", 1.0), ("d", "a", 2.0)], "kind string, host string, weight double")
    got = propagate(spark.createDataFrame([], "kind string, src string, dst string, share double"), seeds).collect()
    assert sorted(tuple(r) for r in got) == [("d", "a", 1.0), ("t", "a", 0.75), ("t", "b", 0.25)]
    assert plans and not any("Window" in p for p in plans)


# -- WARC ------------------------------------------------------------------------------------

TRAP = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [(5, "http://a/", "<p>same</p>"), (3, "http://b/\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c/", None), (2, "http://d/", ""),
        (7, "http://e/", TRAP * 3), (8, "http://f/", "Ünï\r\n\r\n" + TRAP), (10, "http://g/", "x" * 70_000), (None, "http://h/", "null id")]


@pytest.mark.parametrize("range_bytes", [1 << 20, 700, 97])
def test_round_trip_and_boundaries(spark, range_bytes):
    pages = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, value string")
    path = scratch_path(spark, "warc-test")
    write_warc(pages.coalesce(2), path)
    got = read_warc(spark, path, range_bytes).collect()
    assert sorted(r["record_id"] for r in got) == sorted(f"urn:x-page:{'' if i is None else i}" for i, *_ in ROWS)
    assert all(r["intact"] for r in got)
    body = {r["record_id"].rpartition(":")[2]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    for i, _, html in ROWS:
        if i not in (5, 9, 2):
            assert body["" if i is None else str(i)] == (html or "")
    if range_bytes == 1 << 20:
        assert candidate_exits(ranges(spark, path, range_bytes)).count() > len(ROWS) - 4  # chains that reach a range's end


def test_page_records_contract(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in page_records(pages, scratch_path(spark, "warc-test")).collect()}
    first = {}
    for i, _, html in sorted((r for r in ROWS if r[0] is not None)):
        first.setdefault(html or "", i)
    for i, _, html in ROWS:
        raw = (html or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        revisit = i is not None and first[html or ""] != i
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[html or ""]) if revisit else ("response", None))
    big = {r["page_id"]: r["record_type"] for r in page_records(pages, scratch_path(spark, "warc-test"), 12).collect()}
    assert set(big.values()) == {"response"}
    assert page_records(pages.limit(0), scratch_path(spark, "warc-test")).count() == 0


def test_damage_ends_a_file_and_spares_the_others(spark, tmp_path):
    rec = lambda i, body: (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{i}>\r\nContent-Length: {len(body)}\r\n\r\n"  # noqa: E731
                           f"{body}\r\n\r\n").encode()
    whole = rec(1, "a\r\n\r\nb") + rec(2, "") + rec(3, "c")
    (tmp_path / "a.warc").write_bytes(whole)
    (tmp_path / "b.warc").write_bytes(rec(4, "d") + b"garbage" + rec(5, "lost"))
    (tmp_path / "c.warc").write_bytes(rec(6, "e") + rec(7, "cut off")[:-6])
    (tmp_path / "d.warc").write_bytes(b"")
    got = sorted(r["record_id"][-1] for r in read_warc(spark, str(tmp_path), 64).collect())
    assert got == ["1", "2", "3", "4", "6"]


@pytest.mark.parametrize("range_bytes", [1 << 20, 5000])
def test_record_heads_of_any_length(spark, range_bytes):
    """A url far beyond any first read, and one that ends around the steps in which a head is read."""
    urls = ["http://a/", "data:" + "x" * 200_000, *(f"http://b/{'y' * n}" for n in range(1800, 1860, 3)), "http://c/"]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    write_warc(pages.coalesce(1), path)
    got = {r["record_id"]: r for r in read_warc(spark, path, range_bytes).collect()}
    assert len(got) == len(urls)
    assert all(got[f"urn:x-page:{i}"]["target_uri"] == u and got[f"urn:x-page:{i}"]["intact"] for i, u in enumerate(urls))


BODY = "The first paragraph of the article has enough of the stop words to be seen as the content of the page."
MENU = '<ul><li><a href="/a">The first of the links</a></li><li><a href="/b">The second of the links</a></li></ul>'


@pytest.mark.parametrize("page", [
    f"<body><form id=aspnetForm>{MENU}<div>{BODY}</div><p>{BODY}</p>{MENU}</form></body>",
    f"<form><nav>{BODY}</nav><main><p>{BODY}</p><p>{BODY}</p></main><footer>{BODY}</footer></form>",
    *(f'<body><div class="{c}"><p>{BODY}</p><p>{BODY}</p></div></body>' for c in ("col-8 with-sidebar", "no-sidebar", "header-fixed", "page has_comments")),
    f'<div class="sidebar"><article><p>{BODY}</p><p>{BODY}</p></article></div>',
])
def test_wrappers_round_a_page_are_no_boilerplate(page):
    assert main_text(page) == f"{BODY}\n{BODY}"


@pytest.mark.parametrize("page", [
    f"<nav><article>{BODY}</article></nav>", f"<footer><main>{BODY}</main></footer>", f'<div id="comments"><article>{BODY}</article></div>',
    f'<div class="x sidebar">{BODY}</div>', f'<div class="sidebar-left">{BODY}</div>', f'<div class="cookie_banner">{BODY}</div>',
])
def test_boilerplate_stays_boilerplate(page):
    assert main_text(page + f"<article><p>{BODY[:60]}</p></article>") == BODY[:60]


BODY = "The long story of the house by the sea is told here by the man who lived in it for many years and knew it well. " * 3
READER = "Nice words of the reader who says that it is the best of all the stories and that he wants more of it."


@pytest.mark.parametrize("name", ["user-comments-section", "post-comments-list", "top-banner-wrap", "site-navigation-main",
                                  "my-related-posts", "page_sidebar_box"])
def test_boilerplate_words_inside_a_name(name):
    page = f"<body><main><p>{BODY}</p><div class='{name}'><p>{READER}</p></div><p>{BODY}</p></main></body>"
    assert main_text(page) == f"{BODY.strip()}\n{BODY.strip()}"
    # A wrapper round the page with such a name keeps its text.
    assert main_text(f"<body><div class='{name}'><p>{BODY}</p></div></body>") == BODY.strip()


def test_deep_and_unclosed_tags_are_linear():
    import time

    began = time.time()
    for page in ("<div>" * 100_000 + "<a></a>" * 100_000 + "text", "<p>" * 200_000 + "text", "<li><div></li>" * 60_000):
        assert main_text(page) in ("text", "")
    assert time.time() - began < 30
