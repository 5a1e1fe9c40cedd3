"""X1, R5 as keyed state: the first row of each key by an order of its own, across batches, with late rows corrected and state that ends.

For each key the state holds the order and the number of the best row so far. A row that comes before it in order, in whatever batch,
gives a correction: the row with the next revision. Whoever reads takes each key's last revision (``current``), which is what
``claims.first_by`` gives for all rows together. A key's state goes ``keep`` after the last row that its watermark allows: rows that come
later than ``late`` behind the newest are not taken, as the watermark says, so a key that has been silent for long needs no state.

Nothing of earlier batches is read again: a batch costs what it holds. A batch that is run again gets the state it had before and
replaces its own folder.

Defined cases: rows without a key or an order are left out; of rows of equal order the first by all columns' text wins, whichever comes
first; batches may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType


#: What keyed state needs: stores on disk, checkpointed by change.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class First(StatefulProcessor):
    """Keeps (order, tie, revision) of a key's first row. Order and tie are the last two columns, known by place: names may arrive changed."""

    def __init__(self, columns: list[str], keep_ms: int):
        self.columns, self.keep_ms = columns, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", StructType([StructField("at", LongType()), StructField("tie", StringType()), StructField("revision", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = found = None
        for batch in rows:
            for place, own in enumerate(zip(batch.iloc[:, -2].tolist(), batch.iloc[:, -1].tolist(), strict=True)):
                if best is None or own < best:
                    best, found = own, (batch, place)
        if best is None:
            return
        known = self.best.get()  # None without one
        if known is not None and (known[0], known[1]) <= best:
            return
        revision = 1 if known is None else known[2] + 1
        self.best.update((best[0], best[1], revision))
        timer = best[0] // 1000 + self.keep_ms
        if known is not None and (before := known[0] // 1000 + self.keep_ms) != timer:
            self.handle.deleteTimer(before)
        if known is None or before != timer:
            self.handle.registerTimer(timer)
        batch, place = found
        yield batch.iloc[[place], : len(self.columns)].set_axis(self.columns, axis=1).assign(revision=revision)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, key: str, time: str = "ts", late: str = "2 hours", keep_ms: int = 24 * 3600 * 1000) -> DataFrame:
    """``stream`` with ``revision``: a row whenever a key's first row by ``time`` is known or corrected."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    some = stream.where(F.col(time).isNotNull() & (F.col(key).cast("string") != ""))
    tie = F.sha2(F.to_json(F.struct(*stream.columns)), 256)
    named = some.withWatermark(time, late).withColumns({"__at": F.unix_micros(time), "__tie": tie})
    schema = StructType([*stream.schema.fields, StructField("revision", LongType())])
    return named.groupBy(key).transformWithStateInPandas(First(stream.columns, keep_ms), schema, "Update", "EventTime")


def take(stream: DataFrame, path: str, checkpoint: str, key: str, time: str = "ts", late: str = "2 hours", keep_ms: int = 24 * 3600 * 1000) -> None:
    """Take everything that is there into folders of ``path``, one for each batch."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    rows = first_rows(stream, key, time, late, keep_ms)
    rows.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Each key's last revision."""
    last = Window.partitionBy(key).orderBy(F.desc("batch"), F.desc("revision"))
    return spark.read.parquet(path).withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "batch", "revision")
