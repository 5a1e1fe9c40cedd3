import re
import unicodedata
from urllib.parse import urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.functions import data as D
from claimloom.functions import python as P
from claimloom.functions import text as T
from claimloom.functions import url as U

TEXTS = ["", None, "one", " a  b \t c \r\n\n x y \x1c z", "Text before. PASSEND DAZU and after", "line\nKontakt uns\nmore", "a b", "x" * 300, "Mehr von CORRECTIV\nteaser\nkept\nWeiterlesen\nend", "Été çà"]
URLS = ["https://www.A.de/x/y.JPG?w=3#f", "http://b.de:8080/p/", "c.de", "", "//d.de/a.webp", "https://e.de/.hidden", "https://e.de/a/b.tar.gz", "https://www.br.de/fit-in/640x480/pic-300x200.png", "x" * 90]


@pytest.fixture(scope="module")
def run(spark):
    def of(values, column, kind="string"):
        df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
        return [r[1] for r in df.select("k", column(F.col("v"))).orderBy("k").collect()]

    return of


def lines_of(text):
    return "\n".join(x for x in (re.sub(r"\s+", " ", x).strip() for x in (text or "").splitlines()) if x)


def test_text(run):
    assert run(TEXTS, T.clean_lines) == [lines_of(t) for t in TEXTS]
    assert run(TEXTS, T.clean) == [re.sub(r"\s+", " ", t or "").strip() for t in TEXTS]
    cut = run(TEXTS, lambda c: T.cut_at(c, ["Passend dazu", "kontakt"]))
    assert cut[4] == "Text before." and cut[5] == "line" and cut[3] == TEXTS[3] and cut[1] == ""
    assert run(TEXTS, lambda c: T.cut_at_line(c, ["Kontakt"]))[5] == "line"
    assert run(TEXTS, lambda c: T.drop_widgets(c, ["Mehr von CORRECTIV"], ["weiterlesen"]))[8] == "kept\nend"
    assert run(["a|b", "a", None], lambda c: T.split_title(F.coalesce(c, F.lit("")))["caption"]) == ["a", "a", ""]
    assert run(["Claim Type: Photo\nclaim type: x", " claim type: y", "CLAIM TYPE:", None], T.claim_modality) == ["photo", "unknown", "unknown", "unknown"]
    assert run(["<h>" + "please wait, captcha", "fine", "", None], T.is_block_page) == [True, False, True, True]
    assert run(["x<footer class=\"wp-block-group a margin-block-start-xl\">y", "a Get in touch b", "plain"], lambda c: T.cut_html(c, T.FOOTER_TAG, T.FOOTER_PHRASES)) == ["x", "a", "plain"]
    assert run(["a<div id=1 class='x mentions-copyright y'>b"], lambda c: T.cut_html(c, T.COPYRIGHT_TAG)) == ["a"]
    assert run(["b has Lead in it", "body", ""], lambda c: T.merge_lead(F.lit("lead"), c, 10)) == ["b has Lead in it", "lead\nbody", "lead"]
    assert run(["""<a href='x'><img SRC="y">"""], T.attribute_urls) == [["x", "y"]]


def test_widgets_of_a_long_text(run):
    """A long text of short lines takes one pass; markers behind markers, odd breaks, blanks and capitals are as by a walk of its lines."""

    def slow(text):
        out, skip = [], False
        for x in re.split("\r\n|[\n\r\x0b\x0c\x85\u2028\u2029\x1c-\x1e]", text):
            low = x.strip().lower()
            if not skip and low not in ("mehr", "i\u0307 x", "οδος", "weiter"):
                out.append(x)
            skip = not skip and low in ("mehr", "i\u0307 x", "οδος")
        return "\n".join(out).strip()

    long = "a\nmehr\nmehr\nmehr\nb\n" * 60_000
    texts = ["mehr", "mehr\n", "İ X\r\nMEHR\u2028b", "ΟΔΟΣ\na\n\xa0 Weiter\x1f\x0bc\nweiter d", "Mehr\x1cWeiter\x1dWeiter\x1ed\n\n", "x" + " " * 300_000 + "y", long]
    assert run(texts, lambda c: T.drop_widgets(c, ["Mehr", "i\u0307 x", "οδος"], ["weiter"])) == [slow(t) for t in texts]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=8))
def test_cleaning_is_idempotent_and_cuts_are_prefixes(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, v string")
    once = T.clean_lines(F.col("v"))
    for r in df.select("v", once.alias("a"), T.clean_lines(once).alias("b"), T.cut_at(F.col("v"), ["e"]).alias("c"), U.slug(F.col("v")).alias("s")).collect():
        assert r.a == r.b and r.c in r.v and 1 <= len(r.s) <= 64


def test_urls(run):
    assert run(URLS, U.norm_site) == ["a.de", "b.de:8080", "c.de", "", "", "e.de", "e.de", "br.de", "x" * 90]
    assert run(["https://www.20minutes.fr/x", "dpa-factchecking.com"], U.publisher_key) == ["20minutes", "dpa_factchecking"]
    assert run(URLS, U.extension) == [".jpg", "", ".de", "", ".webp", "", ".gz", ".png", ""]
    assert run(URLS[:5], U.strip_query) == [u.split("?")[0].split("#")[0] for u in URLS[:5]]
    assert run(["https://x.y/a b/é.jpg", None, "x" * 90], U.slug) == ["x.y_a_b_é.jpg", "article", "x" * 64]
    assert run(URLS, U.domain) == [urlsplit(u).netloc.lower() if "://" in u else "" for u in URLS]
    assert run(["/fit-in/640x4/", "/320x200/a.jpg", "a-500w.jpg", "a"], U.width) == [640, 320, 500, 0]
    assert run(["https://a/x?w=77", "https://a/x?b=1&width=9"], lambda c: U.width(c, "query")) == [77, 9]
    assert run(["a.jpeg", "b.png?x", "c.webp", "d.avif", "e"], U.extension_priority) == [4, 3, 2, 1, 0]
    same = ["https://a/fit-in/100x200/p-30x40.jpg?x", "https://a/900x1/p-scaled.jpg"]
    assert len(set(run(same, U.asset_key))) == 1
    assert len(set(run(["https://h/t/a/v2/w300/r1.5/P.jpg", "https://h/w900/P.jpg"], lambda c: U.asset_key(c, "stern")))) == 1
    assert run(["https://x/sites/styles/big/public/2020/A-10x20.jpg"], lambda c: U.asset_key(c, "afp")) == ["/2020/a.jpg"]
    assert run(["https://i/image/0a1b2c3d-0000-1111-2222-333344445555/AAA/x.jpg?width=9"], lambda c: U.asset_key(c, "tagesschau")) == ["0a1b2c3d-0000-1111-2222-333344445555:x.jpg"]
    assert run(["a.jpg 100w, b.jpg 300w,c.jpg 300w", "d.jpg 1x, e.jpg 2x", "", None], lambda c: U.srcset_best(c, density=1000)) == ["b.jpg", "e.jpg", None, None]
    assert run(["a 1w, b 1w"], lambda c: U.srcset_best(c, last_of_equals=True)) == ["b"]
    assert run(["image/png", None, "x/webp"], U.extension_of_type) == [".png", ".jpg", ".webp"]
    assert run(["a%2Bb+c", "%zz"], U.unquoted) == ["a+b+c", None]
    assert run(["eyJhIjogMX0", "!!"], lambda c: F.try_variant_get(U.b64_json(c), "$.a", "int")) == [1, None]


def test_python_functions(run):
    assert P.join_url("https://a.de/x/y", "../z") == "https://a.de/z" and P.join_url("https://a.de", "data:x") is None and P.join_url(None, "//b/c") == "https://b/c"
    assert P.cut_folded("Voilà le texte. VOUS SOUHAITÉZ nous", ["vous souhaitez"]) == "Voilà le texte."
    assert run(["&eacute;&amp;", None], P.unescape) == ["é&", None]
    assert P.jsonld_article(['{"@graph": [{"@type": "Thing"}, {"@type": ["NewsArticle"], "headline": "H", "articleBody": "long body"}]}', "broken"]) == ("H", "long body")
    assert P.jsonld_article(["{&quot;@type&quot;: &quot;Article&quot;, &quot;articleBody&quot;: &quot;b&quot;}"]) == ("", "b")
    assert run(['{"a": [{"b": "x"}, "@first"], "c": "@second"}', "no"], P.first_handle) == ["@first", None]


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_folding_keeps_places(text):
    folded, at = P.fold(text)
    assert len(folded) == len(at) and all(0 <= a < len(text) for a in at) and at == sorted(at)
    assert not any(unicodedata.combining(c) for c in folded)


def test_json(run):
    assert run(['{"progressive": {"url": "u"}}', '[{"progressive": {"url": "v"}}]', "x"], D.progressive_url) == ["u", "v", None]
    assert run(['{"caption": "c", "copyrightHolder": {"name": "n"}}', "no"], lambda c: F.to_json(D.image_rights(c))) == ['{"caption":"c","rights":"n"}', '{"caption":"","rights":""}']
    assert run(["x"], D.player_streams) == [[]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab/", max_size=5), max_size=8))
def test_shortest_prefixes_form_an_antichain(spark, values):
    df = spark.createDataFrame([(values,)], "v array<string>")
    kept = df.select(T.shortest_prefixes(F.col("v"))).first()[0]
    assert kept == sorted(kept, key=lambda x: (len(x), x))
    assert all(a == b or not a.startswith(b) for a in kept for b in kept)
    assert all(any(v.startswith(k) for k in kept) for v in values if v)
