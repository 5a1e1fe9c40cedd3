from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.functions import resolve as R
from claimloom.operators import videos

BASE = "http://a/b/c/d;p?q"
# RFC 3986, 5.4: references and what they are seen from BASE
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x",
}
SEGMENTS = ["a", "b", "..", ".", "", "g;x", "x=1;y", "..;p", "é", "c%20d", "a b", ";", "d;", "...", "a:b"]
PATHS = st.builds("/".join, st.lists(st.sampled_from(SEGMENTS), max_size=6))
URLS = st.builds(
    lambda *parts: "".join(parts),
    st.sampled_from(["", "http:", "https:", "HTTP:", "ftp:", "mailto:", "javascript:", "x+1:", "1x:"]), st.sampled_from(["", "//h.de", "//h.de:80", "//u@H.de"]), st.sampled_from(["", "/"]), PATHS,
    st.sampled_from(["", "?", "?q=1", "?a/../b", "?x?y"]), st.sampled_from(["", "#", "#f", "#a/../b"]),
)
PAIRS = st.lists(st.builds("".join, st.tuples(st.sampled_from(["a", "b", "rd", "V", "v", "x%20y", "a+b", "%zz", "é", "~*", ""]), st.sampled_from(["=", "", "=="]), st.sampled_from(["", "1", "a%26b", "ü", "%E9", "%C3%A9", "+", "%", "*", "~"]))), max_size=6)


def wanted(base, url):
    url = url.strip()
    if not url or url.lower().startswith("data:"):
        return None
    return f"https:{url}" if url.startswith("//") else urljoin(base, url)


def edited(url, more, scheme):
    u = urlsplit(url)
    return urlunsplit((u.scheme or scheme, u.netloc, u.path, urlencode(dict(parse_qsl(u.query)) | more), u.fragment))


def sane(url):
    u = urlsplit(url)
    slash = "/" if ("instagram.com/p/" in url or "instagram.com/reel/" in url) and not u.path.endswith("/") else ""
    kept = {k: v for k, v in dict(parse_qsl(u.query)).items() if k.lower() not in R.TRACKING}
    return urlunsplit((u.scheme, u.netloc, u.path + slash, urlencode(kept), ""))


def test_examples_of_the_standard(spark):
    df = spark.createDataFrame([(u,) for u in EXAMPLES], "u string")
    assert {r.u: r.o for r in df.select("u", R.absolute_url(F.lit(BASE), F.col("u")).alias("o")).collect()} == EXAMPLES


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(URLS, URLS), min_size=60, max_size=120))
def test_joins_as_the_standard_library(spark, pairs):
    df = spark.createDataFrame(pairs, "b string, u string")
    # bases that are no web addresses leave a relative url as it is; the library knows some more schemes
    for r in df.select("*", R.absolute_url(F.col("b"), F.col("u")).alias("o")).collect():
        assert r.o == wanted(r.b, r.u), (r.b, r.u)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["https://h.de/x", "//h.de/p/", "/p", "", "https://www.instagram.com/p/AB", "https://www.instagram.com/reel/AB/", "HTTPS://X.com"]), PAIRS, st.sampled_from(["", "#f"])), min_size=60, max_size=120))
def test_queries_as_the_standard_library(spark, parts):
    df = spark.createDataFrame([(f"{u}?{'&'.join(q)}{f}",) for u, q, f in parts], "u string")
    for r in df.select("u", R.add_query(F.col("u"), {"autoplay": "1", "a": "z y"}, "https").alias("o"), R.sanitize_provider_url(F.col("u")).alias("s")).collect():
        assert r.o == edited(r.u, {"autoplay": "1", "a": "z y"}, "https") and r.s == sane(r.u), r.u


@pytest.mark.parametrize("base, url, want", [(None, "a", "a"), (None, None, None), ("http://a/", "  ", None), ("http://a/", " DATA:x", None), ("http://a/b", "//c/d", "https://c/d"), ("http://a/", "http://[x/y", None), ("http://a/", "x\ny", "http://a/xy"), ("http://a", "s" * 50_000, "http://a/" + "s" * 50_000)])
def test_defined_cases(spark, base, url, want):
    df = spark.createDataFrame([(base, url)], "b string, u string")
    row = df.select(R.absolute_url(F.col("b"), F.col("u")).alias("o"), R.add_query(F.col("u"), {"k": "v"}).alias("q"), R.sanitize_provider_url(F.col("u")).alias("s")).first()
    assert row.o == want and row.q is not None and row.s is not None


def test_no_python_in_the_plan(spark):
    df = spark.range(2).select(R.absolute_url(F.lit("http://a/b"), F.col("id").cast("string")).alias("o"), R.add_query(F.lit("http://a"), {"k": "v"}).alias("q"), R.sanitize_provider_url(F.lit("http://a")).alias("s"))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_posts_of_one_item_are_one_video(spark):
    post = "https://www.instagram.com/p/ABCDEF/"
    assert spark.range(1).select(F.transform(F.array(F.lit(post + "?rd=1&V=2#f"), F.lit(post[:-1])), R.sanitize_provider_url).alias("u")).first().u == [post, post]
    html = f'<div class="EmbedInstagram__Wrapper"><a href="{post}?rd=1"></a><a href="{post[:-1]}"></a></div>'
    for publisher in ("20minutes", "tf1info"):
        found = videos.of_pages(spark.createDataFrame([("u", html)], "url string, html string"), publisher=publisher).first().videos
        assert found == [post]
