import pytest
from pyspark.errors import AnalysisException

from claimloom.html.dom import parse
from claimloom.operators.plugins import table_function


def links(html):
    if "blocked" in html:
        raise ValueError(html)
    for k, a in enumerate(parse(html).select("a")):
        yield {"n": k, "href": a.attrs.get("href")} if "x" in (a.attrs.get("href") or "x") else {"n": k}


PAGE = "<a href='x1'>a</a><p><a href='x2'>b</a><a href='y'>c</a></p>"
ROWS = [("u", 1, "blocked one"), ("u", 2, PAGE), ("u", 3, "<a href='x9'>late</a>"), ("v", 1, "blocked v1"), ("v", 2, "blocked v2"), ("w", 1, "<p>none</p>"), ("w", 2, None), ("z", 2, "<a href='x3'>"), ("z", 1, "<i>")]


@pytest.fixture(scope="module")
def pages(spark):
    spark.udtf.register("links_of", table_function(links, "n int, href string"))
    df = spark.createDataFrame(ROWS, "url string, captured_at int, html string")
    df.createOrReplaceTempView("plugin_pages")
    return df


def test_first_capture_with_rows(spark, pages):
    found = spark.sql("select * from links_of(table(plugin_pages) partition by url order by captured_at)")
    assert found.columns == ["url", "captured_at", "n", "href", "error"]
    assert sorted(map(tuple, found.collect())) == [("u", 2, 0, "x1", None), ("u", 2, 1, "x2", None), ("u", 2, 2, None, None), ("v", 1, None, None, "ValueError: blocked v1"), ("z", 2, 0, "x3", None)]


def test_lateral_gives_rows_of_each_page(spark, pages):
    found = spark.sql("select p.url, p.captured_at, l.* from plugin_pages p, lateral links_of(p.html) l")
    rows = sorted(map(tuple, found.collect()), key=str)
    assert found.columns == ["url", "captured_at", "n", "href", "error"] and len(rows) == 8
    assert [r for r in rows if r[4]] == [("u", 1, None, None, "ValueError: blocked one"), ("v", 1, None, None, "ValueError: blocked v1"), ("v", 2, None, None, "ValueError: blocked v2")]


def test_schema_follows_the_table(spark, pages):
    more = pages.selectExpr("html", "named_struct('a', url) as s", "array(captured_at) as list", "url")
    found = table_function(links, "n int, href string")(more.asTable().partitionBy("url"))
    assert [f.simpleString() for f in found.schema.fields] == ["s:struct<a:string>", "list:array<int>", "url:string", "n:int", "href:string", "error:string"]
    assert {(r.s.a, r.url) for r in found.collect()} == {("u", "u"), ("v", "v"), ("z", "z")}


def test_tables_that_do_not_fit_are_refused(spark, pages):
    of = table_function(links, "n int, href string")
    for table, why in ((pages.withColumnRenamed("url", "href"), "one of the adapter's"), (pages.drop("html"), "no column html")):
        with pytest.raises(AnalysisException, match=why):
            of(table.asTable().withSinglePartition()).collect()


def test_no_rows(spark, pages):
    assert table_function(links, "n int, href string")(pages.where("false").asTable().partitionBy("url")).collect() == []
