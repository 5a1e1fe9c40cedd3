"""Sources and sinks over captured data: feed pages, web pages, images, published tables, JSON lines.

Nothing here touches the network. Paths go to Spark's readers and writers alone, so any store Spark knows will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from claimloom.functions import charset as charsets
from claimloom.functions.text import bound
from claimloom.functions.url import image_name
from claimloom.operators.claims import CLAIM, FEED
from claimloom.sources.headers import image_size


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Claims of all captured feed pages in a folder, whatever their order; an unknown field is ignored. A malformed page is a row without
    a claim and with its file in ``error``, which is null for all others. ``feed.read_claims`` follows page tokens."""
    pages = spark.read.schema(f"{FEED}, _corrupt_record string").option("mode", "PERMISSIVE").option("multiLine", True).json(path)
    broken = F.col("_corrupt_record").isNotNull()
    error = F.when(broken, F.concat(F.lit("malformed page "), F.col("_metadata.file_path")))
    rows = F.when(broken, F.array(F.lit(None).cast(CLAIM))).otherwise(F.col("claims"))
    return pages.select(F.explode(rows).alias("c"), error.alias("error")).select("c.*", "error")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages (A3): url, final_url, status, html_static, html_rendered, charset, fetch_error."""
    return spark.read.parquet(path)


def usable_html(static: Column, rendered: Column, status: Column) -> Column:
    """The static copy unless its request failed or it is a block page, else the rendered one."""
    from claimloom.functions.text import is_block_page

    failed = F.coalesce(status, F.lit(200)).between(400, 599) | is_block_page(static)
    return F.when(failed, rendered).otherwise(static)


def decoded(body: Column, charset: Column) -> Column:
    """Bytes as text; where the page states no charset or Latin-1, the bytes tell which it is."""
    stated = F.lower(F.trim(F.coalesce(charset, F.lit(""))))

    def of(b: Column) -> Column:
        vague = b["stated"].isin("", "iso-8859-1", "latin-1", "latin1")
        return charsets.text_of(b["body"], F.when(vague, charsets.detected(b["body"])).otherwise(b["stated"]))

    return bound(F.struct(body.alias("body"), stated.alias("stated")), of)


def read_image_info(spark: SparkSession, path: str) -> DataFrame:
    """(image_url, caption, path) of image tables, whatever their headers' case; empty cells are empty strings."""
    raw = spark.read.option("header", True).csv(path)
    by_name = {c.lower(): c for c in raw.columns}
    return raw.select(*[F.coalesce(F.col(f"`{by_name[n]}`"), F.lit("")).alias(n) if n in by_name else F.lit("").alias(n) for n in ("image_url", "caption", "path")])


def write_image_info(images: DataFrame, path: str) -> None:
    """The same table as CSV."""
    images.select("image_url", "caption", "path").write.mode("overwrite").option("header", True).csv(path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A published dataset's CSV with a header and quoted line breaks."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_jsonl(records: DataFrame, path: str, column: str = "record", mode: str = "append") -> None:
    """One JSON object a line, characters as they are; null parts are left out."""
    records.select(F.to_json(column).alias("value")).write.mode(mode).text(path)


HEADER = StructType([StructField("format", StringType()), StructField("width", IntegerType()), StructField("height", IntegerType())])


@F.pandas_udf(HEADER)
def image_header(content: pd.Series) -> pd.DataFrame:
    """Format, width and height by the file's first bytes; see ``headers`` for its defined cases."""
    return pd.DataFrame([image_size(c) for c in content], columns=["format", "width", "height"]).astype({"width": "Int32", "height": "Int32"})


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, format, width, height) of image files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), image_header("content").alias("h")).select("path", "sha256", "h.*")


def write_images(responses: DataFrame, path: str, prefix: str = "img", parts: int = 256) -> DataFrame:
    """Captured images (image_url, body, and optionally content_type) as a table of named bytes under ``path``, in ``parts`` folders
    by name; returns (path, image_url, content) read back. Bodies are written once, by the tasks that hold them; ``files`` makes single files."""
    kind = F.col("content_type") if "content_type" in responses.columns else F.lit(None).cast("string")
    named = responses.where("body is not null").select(image_name(F.lit(prefix), F.col("image_url"), kind).alias("path"), "image_url", F.col("body").cast("binary").alias("content"))
    once = named.dropDuplicates(["path"]).withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts)))
    once.write.mode("append").partitionBy("part").parquet(path)
    return responses.sparkSession.read.parquet(path).select("path", "image_url", "content")


def files(images: DataFrame, folder: str) -> int:
    """Single files of ``write_images``' rows in ``folder``, written by the executors' own tasks through Python's file system: for a
    folder that they all mount. Returns how many."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            Path(folder).mkdir(parents=True, exist_ok=True)
            names = batch.column("path").to_pylist()
            for name, content in zip(names, batch.column("content").to_pylist(), strict=True):
                part = Path(folder, f".{name}.{uuid.uuid4().hex}")
                part.write_bytes(content)
                part.replace(Path(folder, name))  # a task that is run again replaces whole files
            yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], ["n"])

    return images.select("path", "content").mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
