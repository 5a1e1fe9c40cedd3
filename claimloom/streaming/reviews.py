"""Incremental deduplication: the streaming form of keeping the first row of each review url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimloom.functions.text import text_or_empty
from claimloom.operators.claims import first_by


def first_reviews(stream: DataFrame, key: str = "review_url", time: str = "ts", horizon: str = "30 days") -> DataFrame:
    """Rows of a stream whose key has not come within ``horizon``; keys older than that leave the state."""
    return stream.where(text_or_empty(F.col(key)) != "").withWatermark(time, horizon).dropDuplicatesWithinWatermark([key])


def first_in_order(stream: DataFrame, path: str, checkpoint: str, key: str = "review_url", order: tuple[str, ...] = ("ts",)) -> None:
    """Take everything that is there and keep the first row of each key: within a micro-batch by ``order``, as ``first_by`` does, and
    across batches the earlier batch. Batches are folders of ``path``; one that is run again replaces its own, so nothing is kept
    twice. The keys kept so far are read as one column, not held as state, so none is forgotten.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = first_by(batch, key, list(order))
        seen = spark.read.schema(StructType([*mine.schema.fields, StructField("batch", LongType())])).parquet(path).where(F.col("batch") < number).select(key)
        mine.join(seen, key, "left_anti").select(*mine.columns).write.mode("overwrite").parquet(f"{path}/batch={number}")

    first = stream.sparkSession
    if not _there(first, path):
        first.createDataFrame([], stream.schema).write.parquet(f"{path}/batch=-1")
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def counted(stream: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours", by: str = "publisher_site") -> DataFrame:
    """R11 by window: rows saved for each publisher."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n_rows"))


def run_once(df: DataFrame, path: str, checkpoint: str) -> None:
    """Take everything that is there, write it as Parquet, stop."""
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
