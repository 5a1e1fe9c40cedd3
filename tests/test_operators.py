import json
import struct

import pytest
from pyspark.sql import functions as F

from claimloom.html.dom import parse
from claimloom.operators import articles, claims, images, videos
from claimloom.plans import records
from claimloom.sources import captured
from claimloom.streaming import reviews

P = "This paragraph has a sentence, with commas, and is long enough to count as content of the article. "


def page(body, head=""):
    return f"<html><head><title>A title of some words | Site</title>{head}</head><body><nav><a href=x>menu</a></nav>{body}<footer>foot</footer></body></html>"


def test_tree_and_selectors():
    root = parse("<div id=a class='x y'><p>one<p>two <b>bold<br>er</b><ul><li>1<li>2<ul><li>3</ul></ul><img src=i.png><section><span data-k=v>s</span></section></div>")
    assert [e.text() for e in root.all("p")] == ["one", "two bold er"]
    assert [e.text() for e in root.select("ul > li")] == ["1", "2 3", "3"]
    assert len(root.select("div#a.x img[src$='.png'], span[data-k='v'], section > span")) == 2
    assert root.one("div li li").text() == "3" and not root.select("p > img")
    assert parse(None).text() == "" and parse("<script>var a='</p>';</script>x").text() == "x"


@pytest.mark.parametrize("spec", sorted(articles.SPECS))
def test_every_publisher_reads_a_plain_article(spec):
    own = articles.SPECS[spec]
    inner = "".join(f"<p>{P * 3}{k}</p>" for k in range(5))
    html = page(f"<article><h1>Head</h1><div class='entry-content detail__content article-content'>{inner}</div></article>")
    out = articles.extract(html, None, "https://x", own)
    assert out["error"] is None and out["content"].count("This paragraph") == 15 and out["title"]


def test_cascades():
    s = articles.SPECS
    long = "".join(f"<p>{P}{k}</p>" for k in range(8))
    assert articles.cascade(page(f"<article><h1>H</h1>{long}<p>Passend dazu</p><p>gone</p></article>"), s["de/rtl"])[1].endswith("7")
    ld = json.dumps({"@type": "NewsArticle", "headline": "LD", "articleBody": P * 6})
    assert articles.cascade(page(f"<article>{long}</article>", f"<script type='application/ld+json'>{ld}</script>"), s["de/factencheckafp"])[::2] == ("LD", "jsonld")
    lead = articles.cascade(page(f"<p class=teaser>The lead</p><article>{long}</article>"), s["de/dpa"])[1]
    assert lead.startswith("The lead\n")
    title, body, _ = articles.cascade(page(f"<h1>x</h1><h1 class='entry-title'>T</h1><div class='entry-content'><p>a</p><div class='sfsi_x'>s</div><p>gone</p></div>"), s["fr/fasocheck"])
    assert (title, body) == ("T", "a")
    assert articles.cascade(page("<article><p>a</p><div class=component>c</div><p>gone</p></article>"), s["fr/observalgerie"])[1] == "a"
    assert "gone" not in articles.cascade(page(f"<article>{long}<div class='js-newsletter-block'>n</div><p>{P} gone</p></article>"), s["fr/numerama"])[1]
    nested = articles.run_strategy(page("<article><ul><li><p>twice</p></li></ul></article>"), articles.FALLBACK, s["de/rtl"])[1]
    assert nested == "twice\ntwice"
    corr = page(f"<div class=detail__content><p>{P * 5}</p><p>Mehr von CORRECTIV</p><p>teaser</p><p>kept</p><p>Newsletter bestellen</p><p>gone</p></div>")
    assert articles.cascade(corr, s["de/correctiv"])[1].endswith("kept") and "teaser" not in articles.cascade(corr, s["de/correctiv"])[1]
    lib = articles.extract("<p>short</p>", page(f"<article>{long}</article>"), "https://www.liberation.fr/x", s["fr/liberation"])
    assert lib["strategy"] == "rendered content"
    assert articles.extract(None, None, None, s["de/rtl"])["error"] == "no page captured"


@pytest.mark.parametrize("publisher", sorted(images.SPECS))
def test_every_publisher_finds_its_picture(publisher):
    spec = images.SPECS[publisher]
    figure = "<figure class='c-media wp-block-image'><img src='/p-300x200.jpg' srcset='/p.jpg 900w'><figcaption class='legend'>Cap</figcaption></figure>"
    html = page(f"<main><article class='article o-paper__content article__content'><div id=article_body_content><div id=block-factuel-content class='c-body entry-content article-content post-content defacto-fact-check-body absatzbild'><div class='wrapper-image'><h2 id=verification>v</h2>{figure}<h4 id=references>r</h4></div></div></div></article></main>")
    found = images.candidates(html, "https://h/x", spec)
    # publishers whose renditions do not compete read an image's own address first
    assert {c["url"] for c in found} >= {"https://h/p.jpg" if spec.pick in ("all", "larger") else "https://h/p-300x200.jpg"}, publisher


def test_choosing(spark):
    rows = [("a", 0, "https://h/10x10/x.jpg", 10, ""), ("a", 1, "https://h/90x90/x.jpg", 90, "Cap"), ("a", 2, "https://h/90x90/x.jpg?2", 90, ""), ("a", 3, "https://h/y.png", 5, "cap "), ("a", 4, "https://h/z.png", 0, ""), ("a", 5, "https://h/w.png", 0, "")]
    df = spark.createDataFrame(rows, "article_url string, pos int, url string, w int, cap string")
    from claimloom.functions.url import asset_key

    got = lambda mode, key: sorted(r.pos for r in images.choose(df, mode, key).collect())
    assert got("asset", asset_key(F.col("url"))) == [1, 3, 4, 5]
    assert got("asset+caption", asset_key(F.col("url"))) == [1, 4, 5]
    assert got("asset+merged", asset_key(F.col("url"))) == [1, 4]
    assert got("url", F.col("url")) == [0, 1, 2, 3, 4, 5]


def test_videos(spark):
    html = "<iframe src='//www.youtube-nocookie.com/embed/abcdef1?x'></iframe><iframe data-src-cmplz='https://www.facebook.com/plugins/video.php?href=https%3A%2F%2Fwww.facebook.com%2Fp%2Fvideos%2F12%2F'></iframe><iframe srcdoc='&lt;a href=&quot;https://www.dailymotion.com/video/x1&quot;&gt;'></iframe><video src='https://c/v.mp4?a=1'></video><a href='https://c/v.mp4?b=2'></a><iframe src='https://platform.twitter.com/embed/Tweet.html?a=1&amp;id=99'></iframe>"
    df = spark.createDataFrame([("u", html), ("v", ""), ("w", None)], "url string, html string")
    got = {r.url: r.videos for r in videos.of_pages(df).collect()}
    assert got["u"] == ["https://c/v.mp4", "https://www.dailymotion.com/embed/video/x1", "https://www.facebook.com/p/videos/12", "https://www.youtube.com/embed/abcdef1?autoplay=1", "https://x.com/i/web/status/99"]
    assert got["v"] == [] and not got["w"]
    one = spark.createDataFrame([(1,)], "k int")
    first = lambda c: one.select(c).first()[0]
    assert first(videos.youtube(F.lit("https://youtube.com/embed/short"))) is None
    assert first(videos.youtube(F.lit("https://youtube.com/embed/abcdefg"), "watch")) == "https://www.youtube.com/watch?v=abcdefg"
    assert first(videos.tweet(F.lit("https://x.com/a/status/5"))) == "https://x.com/i/web/status/5"
    assert first(videos.first_stream(F.lit("x"), F.lit(""), F.array(F.lit("a.js"), F.lit("http://l/V.MP4?x")))) == "http://l/V.MP4?x"
    assert [e.platform for e in first(videos.embeds(F.lit("<iframe src='https://www.instagram.com/p/AB/embed'><iframe src='https://www.tiktok.com/embed/v2/12'>")))] == ["instagram", "tiktok"]


def test_plan(spark, tmp_path):
    reviews_ = [{"publisher": {"name": "RTL", "site": "www.rtl.de"}, "url": u, "title": "t", "reviewDate": "2024", "textualRating": "Falsch"} for u in ("https://rtl.de/a", "https://rtl.de/a", "", "https://rtl.de/b")]
    feed = {"claims": [{"text": "c1", "claimReview": reviews_}, {"text": "c2", "claimReview": None}, {"text": "c3", "claimReview": [{"publisher": None, "url": "https://z.de/c"}]}], "nextPageToken": "n"}
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.json").write_text(json.dumps(feed))
    raw = captured.read_feed(spark, str(tmp_path / "feed")).withColumn("pos", F.monotonically_increasing_id())
    assert claims.flatten(raw).count() == 5
    assert claims.of_publisher(claims.flatten(raw), "https://RTL.de/").count() == 4
    html = page(f"<main><article><h1>H</h1><p>{P * 4}</p><iframe src='https://www.youtube.com/embed/abcdefg'></iframe><figure><img src=/i.jpg><figcaption>c</figcaption></figure></article></main>")
    pages = spark.createDataFrame([("https://rtl.de/a", html, None)], "url string, html_static string, html_rendered string")
    labels = spark.createDataFrame([("rtl", "falsch", "False")], "publisher_id string, label_raw string, label_normalized string")
    made = records.build(raw, pages, "de/rtl", "rtl.de", labels)
    captured.write_jsonl(made, str(tmp_path / "out"))
    rows = {json.loads(r.value)["claimreview"]["review_url"]: json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()}
    a, b = rows["https://rtl.de/a"], rows["https://rtl.de/b"]
    assert len(rows) == 2 and a["label_normalized"] == "False" and "errors" not in a
    assert a["media"]["videos"] == ["https://www.youtube.com/watch?v=abcdefg"] and a["media"]["images"][0]["caption"] == "c"
    assert a["media"]["assets_dir"].startswith("rtl_") and "assets_dir" not in b["media"] and b["errors"] == {"article": "no page captured"}
    assert records.build(raw, pages, "de/rtl", "rtl.de", max_items=1, skip_images=True, skip_videos=True).count() == 1
    with pytest.raises(ValueError):
        records.build(raw, pages, "de/nobody")


def test_sources(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + struct.pack(">II", 7, 9)
    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "a.png").write_bytes(png)
    r = captured.read_images(spark, str(tmp_path / "i")).first()
    assert (r.format, r.width, r.height) == ("png", 7, 9)
    assert captured.image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x05\x00\x06xxxx")["width"] == 6
    df = spark.createDataFrame([(bytearray("é".encode()), None), (bytearray("é".encode("latin-1")), "ISO-8859-1"), (bytearray("é".encode()), "utf-8")], "body binary, charset string")
    assert [x[0] for x in df.select(captured.decoded(F.col("body"), F.col("charset"))).collect()] == ["é", "é", "é"]
    captured.write_image_info(spark.createDataFrame([("u", "", "p")], "image_url string, caption string, path string"), str(tmp_path / "csv"))
    assert [tuple(x) for x in captured.read_image_info(spark, str(tmp_path / "csv")).collect()] == [("u", "", "p")]
    html = spark.createDataFrame([("ok", "r", 200), ("ok", "r", 403), ("captcha", "r", 200)], "s string, r string, c int")
    assert [x[0] for x in html.select(captured.usable_html(F.col("s"), F.col("r"), F.col("c"))).collect()] == ["ok", "r", "r"]
    wanted = spark.createDataFrame([("http://a/x?1",), ("http://a/x?2",), ("http://b",)], "image_url string")
    seen = spark.createDataFrame([("http://a/x?1", "one"), ("http://a/x", "bare")], "url string, body string")
    assert {x.image_url: x.body for x in images.reuse_captured(wanted, seen).collect()} == {"http://a/x?1": "one", "http://a/x?2": "bare", "http://b": None}


def test_stream(spark, tmp_path):
    rows = [("u1", "2024-01-01 00:00:00"), ("u1", "2024-01-01 01:00:00"), ("", "2024-01-01 01:00:00"), ("u2", "2024-01-02 00:00:00")]
    src = spark.createDataFrame(rows, "review_url string, t string").select("review_url", F.to_timestamp("t").alias("ts"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    reviews.run_once(reviews.first_reviews(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.review_url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u1", "u2"]


def test_deep_and_failing_pages_leave_the_job_alive(spark):
    """A page of 3,000 nested elements and a tag that never ends, read whole; what cannot be read has its reason in the record."""
    deep = "<main>" + "<div>" * 3000 + f"<p>{P * 4}</p><iframe src='https://www.youtube.com/embed/abcdefg'></iframe>" + "</div>" * 3000 + "</main>"
    assert parse(deep).html().count("<div>") == 3000 and parse(deep).copy().html() == parse(deep).html()
    pages = spark.createDataFrame([("https://rtl.de/a", deep, None), ("https://rtl.de/b", "<main><div <p <<", None)], "url string, html_static string, html_rendered string")
    feed = spark.createDataFrame([(1, "c", None, "", [(("P", "rtl.de"), f"https://rtl.de/{k}", "t", "", "")]) for k in "ab"], f"pos int, text string, claimant string, claimDate string, claimReview array<{claims.REVIEW}>")
    rows = {r.record.claimreview.review_url: r.record for r in records.build(feed, pages, "de/rtl").collect()}
    assert rows["https://rtl.de/a"].media.videos == ["https://www.youtube.com/watch?v=abcdefg"] and rows["https://rtl.de/a"].errors is None
    assert len(rows) == 2 and P.strip() in rows["https://rtl.de/a"].debunk_article.text
    assert images.found(3.5, "", images.SPECS["rtl"])["error"].startswith("AttributeError") and videos._scopes(3.5, ("main", ""))[0].startswith("AttributeError")
    failed = spark.createDataFrame([("u", None, "boom", "clip")], "review_url string, article struct<title:string,content:string,error:string>, image_error string, video_error string")
    made = failed.withColumns({"images": F.array().cast("array<struct<image_url:string,caption:string,path:string>>"), "videos": F.array().cast("array<string>"), "final_url": F.lit(None).cast("string"), "label_normalized": F.lit("")} | {c: F.lit("") for c in ("claim_text", "claimant", "claim_date", "review_label_raw", "review_title", "review_date", "publisher_name", "publisher_site")})
    assert json.loads(made.select(F.to_json(claims.record("rtl", "de"))).first()[0])["errors"] == {"images": "boom", "videos": "clip"}


def test_unknown_publisher_is_an_error_of_its_row(spark):
    df = spark.createDataFrame([("<p>x</p>", "de/rtl"), ("<p>x</p>", "de/nobody")], "html string, spec string")
    rows = df.select(articles.article(F.col("html"), F.col("spec"))["error"].alias("e")).collect()
    assert [r.e for r in rows] == [None, "unknown publisher de/nobody"]


def test_shortest_urls_of_a_hot_site(spark):
    """More partitions than urls that stay: a prefix holds across the partitions behind it."""
    rows = [("s", "http://s/")] + [("s", f"http://s/{k:05d}") for k in range(3000)] + [("t", f"http://s/{k}") for k in range(40)] + [("u", "a"), ("u", "a"), ("u", "b"), ("u", "ab"), ("u", None), (None, "x"), (None, "xy")]
    got = {(r.s, r.u) for r in claims.shortest_urls(spark.createDataFrame(rows, "s string, u string").repartition(8), "s", "u").collect()}
    want = {(s, u) for s, u in rows if s and u and not any(s == t and u != v and u.startswith(v) for t, v in rows if v)}
    assert {x for x in got if x[0]} == want


def test_first_in_order_over_batches(spark, tmp_path):
    from claimloom.operators.claims import first_by

    first = [("a", 3), ("a", 1), ("b", 5), ("", 0)]
    second = [("a", 0), ("c", 9), ("c", 8)]
    schema = "review_url string, at int"
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    take = lambda: reviews.first_in_order(stream(), str(tmp_path / "out"), str(tmp_path / "state"), order=("at",))
    take()
    kept = lambda: sorted((r.review_url, r.at) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert kept() == [("a", 1), ("b", 5)] == sorted((r.review_url, r.at) for r in first_by(spark.createDataFrame(first, schema), "review_url", ["at"]).collect())
    spark.createDataFrame(second, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    take()
    assert kept() == [("a", 1), ("b", 5), ("c", 8)]


def test_image_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"https://h/{k}", bytearray(b"data%d" % k), "image/png") for k in range(5)] + [("https://h/0", bytearray(b"data0"), "image/png"), ("https://h/none", None, None)], "image_url string, body binary, content_type string")
    kept = captured.write_images(rows, str(tmp_path / "images"))
    assert kept.count() == 5 and captured.files(kept, str(tmp_path / "files")) == 5
    assert sorted(f.read_bytes() for f in (tmp_path / "files").iterdir()) == [b"data%d" % k for k in range(5)]
    assert all(f.name.startswith("img_") and f.suffix == ".png" for f in (tmp_path / "files").iterdir())


def test_choice_in_place_is_the_same(spark):
    rows = [("a", 0, "https://h/10x10/x.jpg", 10, ""), ("a", 1, "https://h/90x90/x.jpg", 90, "Cap"), ("a", 2, "https://h/90x90/x.jpg?2", 90, ""), ("a", 3, "https://h/y.png", 5, "cap "), ("a", 4, "https://h/z.png", 0, ""), ("a", 5, "https://h/w.png", 0, ""), ("b", 0, "https://h/w.png", 0, "")]
    flat = spark.createDataFrame(rows, "article_url string, pos int, url string, w int, cap string")
    own = flat.groupBy("article_url").agg(F.collect_list(F.struct("pos", "url", "w", "cap")).alias("found"))
    from claimloom.functions.url import asset_key

    for publisher in ("correctiv", "factencheckafp", "volksverpetzer", "lemonde"):
        spec = images.SPECS[publisher]
        want = {(r.article_url, r.url) for r in images.choose(flat, spec.mode, F.col("url") if spec.mode == "url" else asset_key(F.col("url"), spec.asset)).collect()}
        got = {(r.article_url, i.image_url) for r in images.with_choice(own, "found", publisher).collect() for i in r.images}
        assert got == want, publisher


def test_entry_without_the_training_package():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; q = e.queries(); assert 'q_flagship' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[1])
