"""Captured pages of a claim feed as a Spark data source that follows page tokens.

A feed is a folder ``site=<site>/lang=<language>`` for each publisher and language, with a JSON file for each page: ``first.json`` and then
``<token>.json`` for each page that the last one's ``nextPageToken`` names. One input partition reads one chain of pages, in order and a
page at a time. Filters on ``site`` and ``lang`` are taken over: chains of others are not even listed. A page that is missing, malformed or
named twice ends the read with an error, since all that stands behind it would be lost without a word.

Paths are URIs of any store that Arrow knows (local and shared folders, HDFS, object stores), for the driver and for executors.

Defined cases: a page without claims gives no row; unknown fields are ignored, missing ones null; a chain is read whole whatever its
length; a folder without chains is an empty feed; a filter that leaves no chain gives no row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull

from claimloom.operators.claims import REVIEW

SCHEMA = f"site string, lang string, pos long, text string, claimant string, claimDate string, claimReview array<{REVIEW}>"
_REVIEW = pa.struct([("publisher", pa.struct([("name", pa.string()), ("site", pa.string())])), *((n, pa.string()) for n in ("url", "title", "reviewDate", "textualRating"))])
ARROW = pa.schema([("site", pa.string()), ("lang", pa.string()), ("pos", pa.int64()), ("text", pa.string()), ("claimant", pa.string()), ("claimDate", pa.string()), ("claimReview", pa.list_(_REVIEW))])
FIRST = "first"


class FeedError(ValueError):
    """A chain of pages that cannot be read to its end."""


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path else Path(path).absolute().as_uri())


def _text(value: object) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _review(r: dict) -> dict:
    own = r.get("publisher") or {}
    return {"publisher": {"name": _text(own.get("name")), "site": _text(own.get("site"))} if r.get("publisher") is not None else None, **{n: _text(r.get(n)) for n in ("url", "title", "reviewDate", "textualRating")}}


@dataclass
class Chain(InputPartition):
    """The pages of one publisher and language."""

    site: str
    lang: str
    folder: str

    def __init__(self, site: str, lang: str, folder: str):
        super().__init__(None)
        self.site, self.lang, self.folder = site, lang, folder


class FeedReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | EqualNullSafe | In | IsNotNull) and len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and column in ("site", "lang"):
                continue  # they never are
            values = set(f.value) if isinstance(f, In) else {getattr(f, "value", None)}
            if column in ("site", "lang") and None not in values:
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def _folders(self, at: fs.FileSystem, folder: str, column: str) -> list[tuple[str, str]]:
        found = [i.base_name for i in at.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if i.type == fs.FileType.Directory and i.base_name.startswith(f"{column}=")]
        named = sorted((unquote(n.split("=", 1)[1]), f"{folder}/{n}") for n in found)
        return [(v, p) for v, p in named if v in self.wanted.get(column, {v})]

    def partitions(self) -> Sequence[InputPartition]:
        at, root = store(self.path)
        chains = [Chain(site, lang, inner) for site, folder in self._folders(at, root, "site") for lang, inner in self._folders(at, folder, "lang")]
        return chains or [Chain("", "", "")]

    def read(self, partition: Chain) -> Iterator[pa.RecordBatch]:
        if not partition.folder:
            return
        at, _ = store(self.path)
        token, seen, pos = FIRST, set(), 0
        while token:
            if token in seen:
                raise FeedError(f"{partition.folder}: page {token} comes twice")
            seen.add(token)
            try:
                with at.open_input_stream(f"{partition.folder}/{quote(token, safe='')}.json") as f:
                    page = json.loads(f.read())
            except FileNotFoundError:
                raise FeedError(f"{partition.folder}: page {token} is missing") from None
            except ValueError as error:
                raise FeedError(f"{partition.folder}: page {token} is malformed: {error}") from None
            claims = [c for c in page.get("claims") or [] if c is not None]
            rows = [
                {"site": partition.site, "lang": partition.lang, "pos": pos + k, **{n: _text(c.get(n)) for n in ("text", "claimant", "claimDate")}, "claimReview": None if c.get("claimReview") is None else [_review(r or {}) for r in c["claimReview"]]}
                for k, c in enumerate(claims)
            ]
            pos += len(rows)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, ARROW)
            token = page.get("nextPageToken")


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "claim_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        if "path" not in self.options:
            raise ValueError("a claim feed needs a path")
        return FeedReader(self.options["path"])


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """(site, lang, pos, text, claimant, claimDate, claimReview) of a captured feed; ``pos`` is a claim's place in its chain."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeedSource)
    return spark.read.format(FeedSource.name()).load(path)


def write_pages(claims: DataFrame, path: str, page_size: int = 200) -> None:
    """A captured feed out of claims (site, lang, pos and D1's fields): pages of ``page_size`` in the order of ``pos``, each written by the
    task that has its rows, so a chain's pages may come out in any order."""
    chain = Window.partitionBy("site", "lang")
    fields = ["text", "claimant", "claimDate", "claimReview"]
    page = F.floor((F.row_number().over(chain.orderBy("pos")) - 1) / page_size)
    last = F.max("__page").over(chain)
    numbered = claims.select("site", "lang", "pos", *fields, page.alias("__page")).withColumn("__last", last)
    whole = numbered.groupBy("site", "lang", "__page", "__last").agg(F.array_sort(F.collect_list(F.struct("pos", *fields))).alias("claims"))
    token = F.when(F.col("__page") < F.col("__last"), F.concat(F.lit("t/"), (F.col("__page") + 1).cast("string")))
    body = F.to_json(F.struct(F.transform("claims", lambda c: F.struct(*[c[n].alias(n) for n in fields])).alias("claims"), token.alias("nextPageToken")))
    name = F.when(F.col("__page") == 0, F.lit(FIRST)).otherwise(F.concat(F.lit("t/"), F.col("__page").cast("string")))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, root = store(path)
        for batch in batches:
            for row in batch.to_pylist():
                folder = f"{root}/site={quote(row['site'], safe='')}/lang={quote(row['lang'], safe='')}"
                at.create_dir(folder, recursive=True)
                with at.open_output_stream(f"{folder}/{quote(row['name'], safe='')}.json") as f:  # a task that is run again writes the same page
                    f.write(row["body"].encode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    whole.select("site", "lang", name.alias("name"), body.alias("body")).mapInArrow(put, "n long").agg(F.sum("n")).collect()
