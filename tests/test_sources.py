import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimloom.functions import charset as C
from claimloom.operators import walk
from claimloom.sources import captured, feed, sink, store
from claimloom.streaming import keyed

SENTENCES = [
    ("windows-1252", "Le député a déclaré que l’élève était à l’hôpital « français »."), ("windows-1252", "Die Behörde prüfte größere Mengen – „völlig falsch“, heißt es."), ("windows-1252", "¿Dónde está el niño? Mañana dirá que sí, según la policía."),
    ("iso-8859-15", "Le cœur de l'œuvre coûte 5 € à l'élève."), ("windows-1250", "Příliš žluťoučký kůň úpěl ďábelské ódy a řeka šuměla."), ("iso-8859-2", "Příliš žluťoučký kůň úpěl ďábelské ódy a řeka šuměla."),
    ("windows-1250", "Zażółć gęślą jaźń, powiedział świadek wczoraj."), ("iso-8859-2", "Zażółć gęślą jaźń, powiedział świadek wczoraj."), ("windows-1250", "Árvíztűrő tükörfúrógép a hűvös őszi délutánon."), ("windows-1251", "Президент заявил, что это сообщение ложное."),
    ("koi8-r", "Президент заявил, что это сообщение ложное."), ("cp932", "この画像は別の事件のものです。"), ("utf-16le", "A plain text, naïve"), ("utf-16be", "Президент"), ("utf-16le", "この画像は"), ("utf-8", "Größe 日本"), ("utf-8", ""), ("utf-8", "a"),
]


def test_charsets_of_sentences(spark):
    rows = [(k, t, t.encode(c)) for k, (c, t) in enumerate(SENTENCES)] + [(90, "é", b"\xef\xbb\xbf" + "é".encode()), (91, "é", b"\xff\xfe" + "é".encode("utf-16le")), (92, None, None), (93, "é", b"\xe9"), (94, "ab�", b"ab\x81")]
    df = spark.createDataFrame(rows, "k long, want string, body binary")
    got = {r.k: (r.text, r.found) for r in df.select("k", C.detected(F.col("body")).alias("found"), captured.decoded(F.col("body"), F.lit(None).cast("string")).alias("text")).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: want for k, want, _ in rows}
    assert got[92] == (None, None) and got[93][1] == "windows-1252"


def test_stated_charsets_and_plans(spark):
    df = spark.createDataFrame([(b"\xe9", "ISO-8859-1"), (b"\xb1", " ISO-8859-2 "), (b"\x82\xa0", "Shift_JIS"), (b"\xc3\xa9", "Latin-1"), (b"\xe9", "x-unknown"), (b"a\x82\xa0\xb1\x81", "sjis")], "body binary, charset string")
    assert [r[0] for r in df.select(captured.decoded(F.col("body"), F.col("charset"))).collect()] == ["é", "ą", "あ", "é", "é", "aあｱ\ufffd"]
    plan = df.select(captured.decoded(F.col("body"), F.col("charset")).alias("t"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_walk_of_any_depth(spark):
    deep = '{"a":' * 40 + '["x",{"z":"@one","b":["@two"],"c":[["@three"]]}]' + "}" * 40
    rows = [(1, deep), (2, "{broken"), (3, None), (4, '"@alone"'), (5, "{&quot;b&quot;:1,&quot;a&quot;:{&quot;videoUrl&quot;:null}}"), (6, '{"b":"{\\"hls\\":1}","a":{"c":["@in"],"d":"@own"}}')]
    docs = spark.createDataFrame(rows, "k long, doc string")
    found = walk.nodes(docs, ["k"], "doc").collect()
    assert max(len(r.path) for r in found) == 44 and {r.k for r in found} == {1, 4, 5, 6}
    assert [r.name for r in sorted((r for r in found if r.k == 5), key=lambda r: r.path)] == [None, "b", "a", "videoUrl"]
    assert {r.k: r.owner for r in walk.owners(docs, ["k"], "doc").collect()} == {1: "one", 6: "own"}
    assert {r.k: r.found for r in walk.with_key_like(docs, ["k"], "doc").collect()} == {1: False, 4: False, 5: True, 6: False}
    blocks = spark.createDataFrame([("p", 1, '[{"@type":"Article","articleBody":"ab","headline":"one"}]'), ("p", 2, '{"@graph":[{"@type":["X","NewsArticle"],"articleBody":"cd"},{"@type":"Article","articleBody":["long list"]}]}')], "url string, block int, doc string")
    assert [tuple(r) for r in walk.articles(blocks, ["url"], "doc").collect()] == [("p", "one", "ab")]


@pytest.fixture
def pages(tmp_path):
    def put(site, lang, name, page):
        at = tmp_path / f"site={site}" / f"lang={lang}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"{name}.json").write_text(page if isinstance(page, str) else json.dumps(page))

    put("a.de", "de", "first", {"claims": [{"text": "1", "claimReview": [{"url": "u", "extra": 1}]}], "nextPageToken": "x"})
    put("a.de", "de", "x", {"claims": [{"text": 2}, None, {"claimReview": None}], "other": 1, "nextPageToken": "y"})
    put("a.de", "de", "y", {})
    put("a.de", "fr", "first", {"claims": [{"text": "3", "claimReview": []}]})
    put("broken", "de", "first", "{")
    put("gap", "de", "first", {"claims": [], "nextPageToken": "gone"})
    put("loop", "de", "first", {"claims": [], "nextPageToken": "x"})
    put("loop", "de", "x", {"claims": [], "nextPageToken": "first"})
    return str(tmp_path)


def test_feed_follows_tokens_and_takes_filters(spark, pages):
    claims = feed.read_claims(spark, pages)
    own = claims.where("site = 'a.de'")  # the broken chains of others are never opened
    assert {r.claimReview[0].url for r in own.where("size(claimReview) > 0").collect()} == {"u"}
    rows = [(r.lang, r.pos, r.text) for r in own.orderBy("lang", "pos").collect()]
    assert rows == [("de", 0, "1"), ("de", 1, "2"), ("de", 2, None), ("fr", 0, "3")]
    assert [r.text for r in claims.where("site in ('a.de', 'b') and lang = 'fr' and text > '0'").collect()] == ["3"]
    assert claims.where("site = 'nobody'").count() == 0
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "claim_feed" in plan
    for site, said in (("broken", "malformed"), ("gap", "page gone is missing"), ("loop", "page first comes twice")):
        with pytest.raises(Exception, match=said):
            claims.where(F.col("site") == site).collect()
    with pytest.raises(Exception, match="malformed|missing|twice"):
        claims.collect()


def test_malformed_pages_are_rows_with_an_error(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"claims": [{"text": "1"}, {"text": "2"}], "other": 1}))
    (tmp_path / "bad.json").write_text('{"claims": [')
    (tmp_path / "none.json").write_text("{}")
    rows = captured.read_feed(spark, str(tmp_path)).collect()
    assert sorted((r.text or "", (r.error or "").rsplit("/", 1)[-1]) for r in rows) == [("", "bad.json"), ("1", ""), ("2", "")]


def records(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").select(F.struct("id", F.struct(F.array().cast("array<string>").alias("images"), F.array(F.lit("v")).alias("videos")).alias("media"), F.lit(None).cast("struct<article:string>").alias("errors")).alias("record"))


def test_sink_adds_a_run_once(spark, tmp_path):
    at = f"file://{tmp_path}/out"
    ids = lambda: sorted((r.run, json.loads(r.value)["id"]) for r in sink.committed(spark, at).collect())
    assert ids() == []
    failing = records(spark, range(40)).repartition(4).withColumn("record", F.when(F.col("record.id") == 17, F.raise_error(F.lit("lost"))).otherwise(F.col("record")))
    with pytest.raises(Exception, match="lost"):
        sink.save(failing, at, "a")
    assert ids() == [] and not Path(tmp_path, "out/staged/a").exists()  # a failed run leaves neither lines nor folders
    assert sink.save(records(spark, range(40)).repartition(4), at, "a") == {"n_records": 40, "n_with_media": 40, "n_with_errors": 0}
    stray = Path(tmp_path, "out/staged/a/of-a-lost-task.jsonl")
    stray.write_text('{"id":99}\n')
    assert ids() == [("a", i) for i in range(40)]  # a file that no manifest names is not read
    sink.save(records(spark, range(40)), at, "a")
    sink.save(records(spark, []), at, "empty")
    sink.save(records(spark, [1]), at, "b")
    assert ids() == [*(("a", i) for i in range(40)), ("b", 1)] and not stray.exists()
    assert len(list(Path(tmp_path, "out/staged").iterdir())) == 2 and not list(Path(tmp_path, "out/manifests").glob(".*"))
    assert "errors" not in sink.committed(spark, at).first().value


def test_a_task_that_outlives_its_run_leaves_nothing(spark, tmp_path):
    import pyarrow as pa

    lines, staged = [pa.record_batch({"value": ['{"id":1}']})], tmp_path / "out/staged/a"
    writer = sink.RecordSink({"path": f"file://{tmp_path}/out", "run": "a"}).writer(None, False)
    writer.write(iter(lines))
    assert len(list(staged.iterdir())) == 1
    writer.abort([])
    with pytest.raises(FileNotFoundError):
        writer.write(iter(lines))
    assert not staged.exists()
    lost = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id")).repartition(2)  # before the tasks that write
    with pytest.raises(Exception, match="lost"):
        sink.save(lost.join(records(spark, range(4)), F.col("id") == F.col("record.id")).select("record"), f"file://{tmp_path}/out", "a")
    assert not staged.exists()


def test_pages_stay_where_they_are(spark, tmp_path):
    captures = [("u1", "old", "2024-01-01"), ("u1", "new", "2024-02-01"), ("u1", "new", "2024-02-01"), ("u2", "b", None), ("u2", "a", None), (None, "x", None)]
    pages = spark.createDataFrame(captures, "url string, html_static string, captured_at string").withColumn("captured_at", F.to_timestamp("captured_at"))
    store.keep(pages, str(tmp_path / "s"), 4)
    kept = store.opened(spark, str(tmp_path / "s"), 4)
    assert {(r.url, r.html_static) for r in kept.collect()} in ({("u1", "new"), ("u2", "a")}, {("u1", "new"), ("u2", "b")}) and kept.count() == 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        claims = spark.range(1000).select(F.concat(F.lit("u"), F.col("id")).alias("review_url"))
        for joined in (claims.join(kept, F.col("review_url") == F.col("url"), "left"), kept.join(claims.select(F.col("review_url").alias("url")), "url", "left_semi")):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
            assert all("html" not in line for line in plan.splitlines() if "Exchange" in line)
        assert claims.join(kept, F.col("review_url") == F.col("url")).count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    store.keep(pages.limit(0), str(tmp_path / "e"), 4)
    assert store.opened(spark, str(tmp_path / "e"), 4).count() == 0


def test_bytes_are_made_once_however_often_they_are_looked_at(spark):
    body = F.expr("encode(reverse(cast(id as string)), 'UTF-8')")
    read = spark.range(20).select(captured.decoded(body, F.lit("latin1")).alias("t"))
    assert read._jdf.queryExecution().optimizedPlan().toString().count("reverse(") == 1
    assert [r.t for r in read.collect()] == [str(k)[::-1] for k in range(20)]


def test_keyed_state_over_batches(spark, tmp_path):
    """Late rows correct the first, repeated rows and batches change nothing, old keys leave the state."""
    schema = "k string, ts timestamp, v string"
    batches = [
        [("a", "2024-01-02 00:00:00", "a2"), ("b", "2024-01-02 00:00:00", "b1"), (None, "2024-01-01 00:00:00", "x"), ("", "2024-01-01 00:00:00", "x")],
        [("a", "2024-01-01 23:00:00", "a1"), ("a", "2024-01-02 00:00:00", "a2"), ("c", None, "x"), ("c", "2024-01-02 01:00:00", "c1")],
        [("a", "2024-01-01 23:30:00", "a3"), ("b", "2024-01-02 00:00:00", "b1")],
        [("d", "2024-01-09 00:00:00", "d1")],
        [("d", "2024-01-10 00:00:00", "d2")],
    ]
    at, source = str(tmp_path), tmp_path / "in"
    rows_in = []
    for k, batch in enumerate(batches):
        rows = [(x[0], x[1], x[2]) for x in batch]
        rows_in += rows
        frame = spark.createDataFrame(rows, "k string, ts string, v string").select("k", F.to_timestamp("ts").alias("ts"), "v")
        frame.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        keyed.take(stream, f"{at}/rows", f"{at}/state", "k", late="1 day", keep_ms=3600_000)
        seen = {r.k: r.v for r in keyed.current(spark, f"{at}/rows", "k").collect()}
        want = {}
        for key, ts, v in sorted((r for r in rows_in if r[0] and r[1]), key=lambda r: r[1]):
            want.setdefault(key, v)
        assert seen == want
    revisions = {(r.k, r.v): r.revision for r in spark.read.parquet(f"{at}/rows").collect()}
    assert revisions == {("a", "a2"): 1, ("a", "a1"): 2, ("b", "b1"): 1, ("c", "c1"): 1, ("d", "d1"): 1}
    state = spark.read.format("statestore").option("path", f"{at}/state").option("stateVarName", "best").load()
    assert {r.key.k for r in state.select("key").collect()} == {"d"}
    shutil.rmtree(source)


def test_records_from_a_store_move_no_page(spark, tmp_path):
    from claimloom import fixtures
    from claimloom.plans import records as plans

    html = fixtures.article(fixtures.BODY).replace("{n}", "1")
    pages = spark.createDataFrame([("https://rtl.de/1", html, "2024-01-02"), ("https://rtl.de/1", "<p>old</p>", "2024-01-01"), ("https://rtl.de/2", html, None)], "url string, html_static string, captured_at string")
    pages = pages.select("url", "html_static", F.lit(None).cast("string").alias("html_rendered"), F.to_timestamp("captured_at").alias("captured_at"))
    review = F.array(F.struct(F.struct(F.lit("P").alias("name"), F.lit("rtl.de").alias("site")).alias("publisher"), F.col("u").alias("url"), *[F.lit("").alias(c) for c in ("title", "reviewDate", "textualRating")]))
    feed_ = spark.createDataFrame([(k, f"https://rtl.de/{k}") for k in (1, 2, 3)], "pos long, u string").select("pos", F.lit("c").alias("text"), *[F.lit("").alias(c) for c in ("claimant", "claimDate")], review.alias("claimReview"))
    store.keep(pages, str(tmp_path / "s"), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = plans.build(feed_, store.opened(spark, str(tmp_path / "s"), 4), "de/rtl", stored=True)
        lines = kept._jdf.queryExecution().executedPlan().toString().splitlines()
        assert any("Bucketed: true" in x for x in lines)
        semi = next(k for k, x in enumerate(lines) if "LeftSemi" in x)
        scan = next(k for k, x in enumerate(lines) if k > semi and "FileScan" in x)
        assert not any("Exchange" in x for x in lines[semi:scan])  # pages meet their claims where they are
        rows = {r.pos: r.record for r in kept.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plain = {r.pos: r.record for r in plans.build(feed_, pages, "de/rtl").collect()}
    assert rows == plain and rows[1].debunk_article.title == "A headline of page 1" and rows[3].errors.article == "no page captured"


def test_walk_parses_a_document_once_and_moves_none(spark):
    rows = [(1, '{"b":{"n":1.50,"a":[1e2,"\\u00e9",true,null]},"a":"{}"}'), (2, '{"a":1,"a":2}'), (3, "[" * 300 + "]" * 300), (4, '"\\ud800"'), (5, "{} x"), (6, "[NaN]")]
    found = walk.nodes(spark.createDataFrame(rows, "k long, doc string"), ["k"], "doc")
    plan = found._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "parquet" not in plan.lower()  # no level is written to be read again
    got = [(".".join(map(str, r.path)), r.name, r.kind, r.value) for r in found.collect() if r.k == 1]
    assert got[0] == ("", None, "object", '{"b":{"n":1.50,"a":[1e2,"é",true,null]},"a":"{}"}')
    assert got[3:] == [("0.1", "a", "list", '[1e2,"é",true,null]'), ("0.1.0", None, "other", "1e2"), ("0.1.1", None, "string", "é"), ("0.1.2", None, "other", "true"), ("0.1.3", None, "null", None), ("1", "a", "string", "{}")]
    assert {r.k for r in found.collect()} == {1, 3, 4}
