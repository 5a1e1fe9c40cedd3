"""Captured pages kept once, dealt out by url, so that claims find theirs without moving a page.

``keep`` chooses one capture of each url (the last by captured_at, of equal ones the one with the greater digest) on narrow rows, and
writes it into buckets of the url, sorted by it. ``opened`` names the same files as a table again, in any session. A join or semi-join
with claims then moves the claims alone (``plans.records.build`` with ``stored``); as many tasks read pages as there are buckets.

Defined cases: pages without a url are left out; captures without captured_at are older than those with it; rows that repeat wholly are
one page; an empty table keeps nothing and opens as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a capture and their types.
CAPTURE = {"url": "string", "final_url": "string", "html_static": "string", "html_rendered": "string", "log_urls": "array<string>", "captured_at": "timestamp"}


def whole(pages: DataFrame, more: list[str] | None = None) -> DataFrame:
    """``pages`` with all the columns that a capture may have, and those of ``more``."""
    return pages.select(*(more or []), *[F.col(c).cast(kind) if c in pages.columns else F.lit(None).cast(kind).alias(c) for c, kind in CAPTURE.items()])


def last_captures(pages: DataFrame) -> DataFrame:
    """One capture of each url; the choice is made on (url, captured_at, digest), and texts are joined to it once."""
    digest = F.sha2(F.to_json(F.struct("final_url", "html_static", "html_rendered", "log_urls")), 256)
    known = whole(pages).where("url is not null").withColumn("digest", digest)
    chosen = known.groupBy("url").agg(F.max(F.struct("captured_at", "digest")).alias("c")).select("url", F.col("c.captured_at").alias("__at"), F.col("c.digest").alias("__digest"))
    same = (known["url"] == chosen["url"]) & (known["digest"] == chosen["__digest"]) & known["captured_at"].eqNullSafe(chosen["__at"])
    return known.join(chosen, same, "left_semi").dropDuplicates(["url"]).drop("digest")


def keep(pages: DataFrame, path: str, buckets: int = 200) -> None:
    """Write the store; a run that is repeated replaces it whole."""
    name = f"pages_{uuid.uuid4().hex}"
    spark = pages.sparkSession
    last_captures(pages).repartition(buckets, "url").write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, "url").sortBy("url").saveAsTable(name)
    spark.sql(f"drop table {name}")  # the table's name goes, its files stay


def opened(spark: SparkSession, path: str, buckets: int = 200) -> DataFrame:
    """The store at ``path``; ``buckets`` as it was kept."""
    name = f"pages_{uuid.uuid4().hex}"
    columns = ", ".join(f"{c} {kind}" for c, kind in CAPTURE.items())
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (url) sorted by (url) into {buckets} buckets location '{path}'")
    return spark.table(name)
