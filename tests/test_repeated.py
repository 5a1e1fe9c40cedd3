"""Queries over tables that the small ones lack: pages that share a url, texts with letters beyond a charset, texts in capitals."""

import duckdb
import pyarrow.parquet as pq
import pytest

from claimloom import catalogue

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    own = catalogue.queries()[name](spark, str(folder))
    found = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    return sorted((tuple(r[n] for n in names) for r in own.collect()), key=str) == sorted(found.fetchall(), key=str)


@pytest.mark.parametrize("name", ["q_join_fallback", "q_page_store", "q_record_fixtures"])
def test_pages_that_share_a_url(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"create table p as from '{SF}/pages.parquet'")
    con.execute("insert into p by name select * replace (page_id + 1003 as page_id, html || 'x' as html) from p where page_id % 2 = 0")
    con.execute("insert into p by name select * replace (page_id + 5001 as page_id) from p where page_id % 7 = 0")
    con.execute(f"copy p to '{tmp_path}/pages.parquet'")
    assert same_as_sql(spark, tmp_path, name)


def test_letters_beyond_a_charset_and_capitals(spark, tmp_path):
    docs = pq.read_table(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute("create table d as from docs")
    # Russian and Japanese lack these letters, which are more than 2 % of all text; in capitals Polish has bytes that look like kanji
    con.execute("update d set text = text || repeat(' á ú â î', 20000) where doc_id in (126, 127)")
    con.execute("update d set text = repeat('CIÓN!! EN!! ', 200) where doc_id = 124")
    con.execute(f"copy d to '{tmp_path}/documents.parquet'")
    assert same_as_sql(spark, tmp_path, "q_charset")


def times_in_plan(frame, text):
    return frame._jdf.queryExecution().optimizedPlan().toString().count(text)


def test_urls_of_a_page_are_looked_for_once(spark):
    from pyspark.sql import functions as F

    from claimloom.operators import videos

    pages = spark.createDataFrame([(1, "<p>")], "url int, html string").select("url", F.concat(F.reverse("html"), F.lit("<iframe src='https://youtu.be'>")).alias("html"))
    assert times_in_plan(videos.of_pages(pages), "srcdoc") == 1


def test_pages_come_in_small_batches(spark):
    catalogue.queries()["q_article_by_spec"](spark, SF)
    catalogue.queries()["q_images_extract"](spark, SF)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
