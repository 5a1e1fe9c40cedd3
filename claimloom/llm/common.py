"""What the operators of this subpackage share: tables, written stages, row digests."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.session import shared_dir

#: A word is a run of anything but the six ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
#: The characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Columns of documents, in order.
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows that one Arrow batch may hold; whole texts can be long.
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small, so that a worker holds a bounded share of long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


#: The folder that the tables of the run going on in this thread are written to; see ``scratch``.
_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{_FOLDER.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written`` outside of any scratch folder, and the path, for the caller to remove when the table is used up."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside go when it ends: what is made from them has to be written outside, or used up, before."""
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    before = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(before)
        removed(spark, folder)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Bitmaps of a sieve at most, each of BITS bits: 8 MB, however many values are put in; and bits for each value below that.
BITMAPS, BITS, BITS_PER_VALUE = 2048, 32_768, 256


@dataclass(frozen=True)
class Sieve:
    """(bucket, bits): bitmaps of the hashes of a column's values among ``places`` bits, bounded in size and so fit to be broadcast."""

    bitmaps: DataFrame
    places: int


def sieve(values: DataFrame, column: str) -> Sieve:
    """A sieve of a column's values; more values than its bound has room for let more rows through, and lose none."""
    n = values.count()
    places = BITS * min(BITMAPS, max(1, -(-n * BITS_PER_VALUE // BITS)))
    place = F.pmod(F.xxhash64(column), F.lit(places))
    placed = values.select(F.floor(place / BITS).alias("bucket"), (place % BITS).alias("at"))
    return Sieve(written(placed.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")), "sieve"), places)


def sifted(df: DataFrame, column: str, by: Sieve) -> DataFrame:
    """``df`` with ``maybe``: false only where the column's value was not put into the sieve. No row moves."""
    place = F.pmod(F.xxhash64(column), F.lit(by.places))
    own = by.bitmaps.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor((place % BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0, F.lit(False))
    return df.join(F.broadcast(own), F.floor(place / BITS) == F.col("__bucket"), "left").withColumn("maybe", maybe).drop("__bucket", "__bits")


def ascii_lower(col):
    """Lower-case A-Z alone."""
    return F.translate(col, UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
