"""The end-to-end plan: captured feed and pages in, one nested record for each reviewed claim out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.operators import articles, claims
from claimloom.operators import images as image_ops
from claimloom.operators import pages as page_ops
from claimloom.operators import videos as video_ops
from claimloom.sources import store as page_store


def build(
    feed: DataFrame, pages: DataFrame, spec: str, site: str | None = None, labels: DataFrame | None = None, max_items: int | None = None, skip_images: bool = False, skip_videos: bool = False, stored: bool = False, within: str | None = None,
) -> DataFrame:
    """(record) for the claims of one publisher.

    ``feed``: raw claims (D1) with an order column ``pos``; ``pages``: captured pages (url, html_static, html_rendered, and if they
    were kept final_url, log_urls and captured_at). Of a url that was captured more than once the last capture counts (by
    captured_at, else by the greater texts). The limit is applied before any page is parsed, and only pages of the remaining
    claims are, once each; what was read of them is narrow and joined once. ``stored``: ``pages`` is a page store
    (``sources.store``), which has one capture of each url and whose rows stay where they are. ``within``: a column of both that names the
    crawl a claim and a page belong to; then urls are told apart by crawl too (not with ``stored``).
    """
    if spec not in articles.SPECS:
        raise ValueError(f"unknown publisher {spec}; known: {', '.join(sorted(articles.SPECS))}")
    if within and stored:
        raise ValueError("a page store has one capture of each url: no crawls")
    own, crawl = articles.SPECS[spec], [within] if within else []
    items = claims.first_by(claims.of_publisher(claims.flatten(feed), site), "review_url", ["pos"], within=crawl)
    items = claims.limited(items, max_items, ["pos"])
    wanted = items.select(*crawl, F.col("review_url").alias("url")).distinct()
    needed = (pages if stored else page_store.whole(pages, crawl)).join(wanted, [*crawl, "url"], "left_semi")
    if not stored:  # the join has dealt pages out by url, so nothing moves again
        latest = Window.partitionBy(*crawl, "url").orderBy(*[F.desc_nulls_last(c) for c in ("captured_at", "html_static", "html_rendered", "final_url")])
        needed = needed.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n")
    skip_images = skip_images or own.publisher not in image_ops.SPECS
    read = page_ops.read(F.col("html_static"), F.col("html_rendered"), F.col("url"), spec, not skip_images, not skip_videos)
    videos = video_ops.SPECS.get(own.publisher, video_ops.ANY)
    parsed = needed.withColumn("r", read).withColumn("html", F.coalesce("html_rendered", "html_static"))
    none = F.array().cast("array<string>")
    clips = none if skip_videos else video_ops.listed(videos, F.col("html"), F.col("r.scope"), F.col("r.own_scope"), F.col("log_urls"))
    narrow = parsed.select(*crawl, "url", "final_url", "r.article", "r.list", clips.alias("videos"), "r.image_error", "r.video_error")
    if skip_images:
        narrow = narrow.withColumn("images", F.lit(None).cast("array<struct<image_url:string,caption:string,path:string>>"))
    else:
        narrow = image_ops.with_choice(narrow, "list", own.publisher)
    missing = F.struct(F.lit("").alias("title"), F.lit("").alias("content"), F.lit(None).cast("string").alias("strategy"), F.lit("no page captured").alias("error"))
    full = claims.enriched(items, narrow.drop("list"), crawl).withColumn("article", F.coalesce("article", missing))
    full = full.withColumn("publisher_id", F.lit(own.publisher)).withColumn("label_raw", F.col("review_label_raw"))
    full = claims.with_label(full, labels) if labels is not None else full.withColumn("label_normalized", F.col("label_raw"))
    return full.select("pos", claims.record(own.publisher, own.language).alias("record"))
