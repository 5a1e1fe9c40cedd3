"""Session construction with the settings the engine is designed for."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Defaults that a submitted configuration overrides.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use dots written as double underscores."""
    builder = SparkSession.builder.appName("claimloom")
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One captured table; works for a single file and for a folder of part files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it.

    A local folder is taken only where driver and executors are one process (masters ``local`` and ``local[...]``).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints/claimloom"


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than there are cores, dealt out evenly, for work that costs much more than moving its rows.

    A large table has more partitions than cores and stays as it is: nothing is shuffled.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


#: Pages that one Arrow batch may hold.
PAGES = 256


def page_batches() -> None:
    """Keep Arrow batches of the session small, so that a worker holds few whole pages however many its task has."""
    spark, key = SparkSession.active(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= PAGES:
        spark.conf.set(key, str(PAGES))
