"""The relational operators of a claim dataset: flatten, filter, deduplicate, look up, assemble."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.text import claim_modality, text_or_empty
from claimloom.functions.url import norm_site, url_hash
from claimloom.session import shared_dir

#: One captured page of the claim feed.
REVIEW = "struct<publisher:struct<name:string,site:string>,url:string,title:string,reviewDate:string,textualRating:string>"
CLAIM = f"struct<text:string,claimant:string,claimDate:string,claimReview:array<{REVIEW}>>"
FEED = f"claims array<{CLAIM}>, nextPageToken string"


def flatten(claims: DataFrame) -> DataFrame:
    """One row for each review of each claim (D1 -> D2); a claim without reviews gives none, nulls become empty."""
    reviews = claims.select("*", F.explode("claimReview").alias("r"))
    own = {
        "claim_text": "text", "claimant": "claimant", "claim_date": "claimDate", "review_url": "r.url", "review_title": "r.title",
        "review_date": "r.reviewDate", "review_label_raw": "r.textualRating", "publisher_name": "r.publisher.name", "publisher_site": "r.publisher.site",
    }
    extra = [c for c in claims.columns if c not in ("text", "claimant", "claimDate", "claimReview")]
    return reviews.select(*extra, *[text_or_empty(F.col(path)).alias(name) for name, path in own.items()])


def of_publisher(items: DataFrame, site: str | None, column: str = "publisher_site") -> DataFrame:
    """Rows of one publisher; no filter keeps all."""
    return items if not site else items.where(norm_site(F.col(column)) == norm_site(F.lit(site)))


def first_by(items: DataFrame, key: str, order: list[str], desc: bool = False, within: list[str] | None = None) -> DataFrame:
    """The first row of each non-empty key, among rows that are equal in ``within``. Keys may be long texts: rows are dealt and sorted
    by their digest."""
    by = [F.desc(c) if desc else F.asc(c) for c in order]
    some = items.where(text_or_empty(F.col(key)) != "").withColumn("__k", F.sha2(F.col(key), 256))
    return some.withColumn("__n", F.row_number().over(Window.partitionBy(*(within or []), "__k").orderBy(*by))).where("__n = 1").drop("__n", "__k")


def shortest_urls(items: DataFrame, group: str, url: str) -> DataFrame:
    """Distinct (group, url) without those that another url of the group is a prefix of, however large a group is.

    In code point order, whatever starts with a url follows it, so a url stays unless the last that stayed is its prefix. Sorted
    partitions are read once in that order; what a partition starts with is then held against the last url that stayed before it,
    of which there is one for each partition.
    """
    kind = items.schema[group].dataType.simpleString()
    spark = items.sparkSession
    ordered = items.select(F.col(group).alias("g"), F.col(url).alias("u")).where("u is not null").distinct().repartitionByRange("g", "u").sortWithinPartitions("g", "u")

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = u = None
        for batch in batches:
            keep = []
            for own, text in zip(batch.column("g").to_pylist(), batch.column("u").to_pylist(), strict=True):
                keep.append(own != g or u is None or not text.startswith(u))
                if keep[-1]:
                    g, u = own, text
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keep, pa.bool_())], ["g", "u", "keep"])

    at = f"{shared_dir(spark)}/shortest-{uuid.uuid4().hex}"
    ordered.mapInArrow(stay, f"g {kind}, u string, keep boolean").where("keep").select("g", "u", F.spark_partition_id().alias("part")).write.parquet(at)
    kept = spark.read.schema(f"g {kind}, u string, part int").parquet(at)
    last = {r.part: (r.l.g, r.l.u) for r in kept.groupBy("part").agg(F.max(F.struct("g", "u")).alias("l")).collect()}  # a row for each partition
    carried, ahead = [], None
    for part in sorted(last):
        if ahead:
            carried.append((part, *ahead))
        # a partition whose last url was only kept for want of what stands before it hands that on
        ahead = ahead if ahead and ahead[0] == last[part][0] and last[part][1].startswith(ahead[1]) else last[part]
    before = spark.createDataFrame(carried, f"part int, before_g {kind}, before_u string")
    joined = kept.join(F.broadcast(before), "part", "left")
    gone = F.coalesce((F.col("g") == F.col("before_g")) & F.col("u").startswith(F.col("before_u")), F.lit(False))
    return joined.where(~gone).select(F.col("g").alias(group), F.col("u").alias(url))


def limited(items: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first n rows after deduplication; a top-k, not a sort of all rows."""
    return items if n is None else items.orderBy(*order).limit(n)


def not_seen(items: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys an earlier extractor has not given."""
    return items.join(seen.select(*keys).distinct(), keys, "left_anti")


def with_label(items: DataFrame, labels: DataFrame, publisher: str = "publisher_id", raw: str = "label_raw") -> DataFrame:
    """The normalised verdict where the map has one, else the raw one. The map has a row for each publisher and label."""
    known = labels.select(F.col("publisher_id").alias("__p"), F.lower(F.trim("label_raw")).alias("__l"), "label_normalized").dropDuplicates(["__p", "__l"])
    joined = items.join(known, (F.col(publisher) == F.col("__p")) & (F.lower(F.trim(raw)) == F.col("__l")), "left")
    return joined.withColumn("label_normalized", F.coalesce("label_normalized", raw)).drop("__p", "__l")


def enriched(items: DataFrame, pages: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Claims with what was extracted from their pages (url, article, images, videos, image_error, video_error,
    final_url); ``pages`` has one row for each url (and value of ``within``), and a claim without a page has no media."""
    media = {"images": "array<struct<image_url:string,caption:string,path:string>>", "videos": "array<string>"}
    same, named = F.col("review_url") == F.col("__url"), {"url": "__url"} | {c: f"__of_{c}" for c in within or []}
    for c in within or []:
        same &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    out = items.join(pages.withColumnsRenamed(named), same, "left").drop(*named.values())
    return out.withColumns({name: F.coalesce(name, F.array().cast(kind)) for name, kind in media.items()})


def has_media() -> Column:
    """R13."""
    return (F.size("images") > 0) | (F.size("videos") > 0)


def record(publisher: str, language: str) -> Column:
    """The nested record of an enriched, labelled claim; absent parts are null and vanish in JSON."""
    kinds = {"article": F.col("article.error"), "images": F.col("image_error"), "videos": F.col("video_error")}
    errors = F.struct(*[error.alias(kind) for kind, error in kinds.items()])
    return F.struct(
        F.lit(publisher).alias("publisher_id"), F.lit(language).alias("language"), F.col("claim_text").alias("claim"), "claimant", "claim_date",
        F.col("review_label_raw").alias("label_raw"), "label_normalized",
        F.struct("review_url", "review_title", "review_date", "publisher_name", "publisher_site").alias("claimreview"),
        F.struct(F.coalesce("final_url", "review_url").alias("url"), text_or_empty(F.col("article.title")).alias("title"), text_or_empty(F.col("article.content")).alias("text")).alias("debunk_article"),
        F.struct("images", "videos", F.when(has_media(), F.concat(F.lit(f"{publisher}_"), url_hash(F.col("review_url")))).alias("assets_dir")).alias("media"),
        F.when(F.coalesce(*kinds.values()).isNotNull(), errors).alias("errors"),
    )


def saved(records: DataFrame, column: str = "record") -> DataFrame:
    """Rows saved for each publisher, and how many of them have media or an error of some kind."""
    r = F.col(column)
    some = F.size(r["media"]["images"]) + F.size(r["media"]["videos"]) > 0
    return records.groupBy(r["publisher_id"].alias("publisher_id")).agg(F.count("*").alias("n_records"), F.count_if(some).alias("n_with_media"), F.count_if(r["errors"].isNotNull()).alias("n_with_errors"))


def with_modality(items: DataFrame, reply: Callable[[Column], Column], column: str = "claim_text") -> DataFrame:
    """``items`` with ``modality`` as a pluggable classifier's reply states it (T20). ``reply`` makes a column of replies from
    one of claims: a model behind a pandas UDF, a lookup of captured replies, or rules."""
    return items.withColumn("modality", claim_modality(reply(F.col(column))))
