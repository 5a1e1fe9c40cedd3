"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from texts of that language. A text is encoded with each
dictionary, and the language whose dictionary makes it smallest is chosen; if the second smallest is within ``margin`` of it,
the text is marked as rejected. A long text would soon be its own dictionary, so texts are cut into blocks of BLOCK bytes that
are each encoded anew; sizes are summed, so the whole text counts.

Learning reads a bounded sample: of each language PER_LANGUAGE documents by the hash of their doc_id, and CHUNK bytes of each at an
offset that the hash picks; all of that is the language's dictionary. Where ``lang`` has more than MOST_LANGUAGES values, as a
dirty column may, those of the most documents (ties: the smaller name) get a dictionary and the others cannot be predicted, so
what is broadcast is bounded. lang, source and doc_id are never inputs of a prediction.

Defined cases: text that is null or has no letter is ``und`` with score 0; when sizes tie, the language with more sampled bytes
stands first, then the smaller name; with nothing to learn from, all are ``und``; a null lang is not learned from; repeated rows
are predicted alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import arrow_batches, table
from claimloom.session import spread

PER_LANGUAGE, SALTS, CHUNK, BLOCK, MOST_LANGUAGES = 160, 16, 1024, 4096, 200
letter = regex.compile(r"\p{L}").search
between = regex.compile(r"[^\p{L}\p{M}]+").sub


def letters(text: str) -> bytes:
    """Lower-case words of a text: digits, marks and punctuation say nothing of its language."""
    return f" {between(' ', text.lower()).strip()} ".encode()


class Encoders:
    """One compressor for each language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries, key=lambda n: (-len(dictionaries[n]), n))
        # the fast strategy with wide tables: matches of five bytes and more, found in the dictionary rather than the text
        settings = zstandard.ZstdCompressionParameters.from_level(6, strategy=zstandard.STRATEGY_FAST, min_match=5, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.encode = []
        for name in self.names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            self.encode.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings).compress)

    def sizes(self, text: str) -> np.ndarray:
        raw = letters(text)
        blocks = [raw[at : at + BLOCK] for at in range(0, len(raw), BLOCK)]
        return np.array([sum(len(encode(b)) for b in blocks) for encode in self.encode], dtype=np.float64)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, its share of exp(-size), margin to the next as a share of the smallest size)."""
        if not self.names or not text or not letter(text):
            return "und", 0.0, 0.0
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        margin = float((others.min() - sizes[best]) / sizes[best]) if len(others) else 1.0
        return self.names[best], float(1 / np.exp(np.maximum(sizes[best] - sizes, -500.0)).sum()), margin


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Language -> dictionary, from ``docs`` (doc_id, text, lang)."""
    arrow_batches(docs.sparkSession)
    known = docs.where("lang is not null and doc_id is not null and text is not null and text <> ''")
    names = [r.lang for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    hashed = known.where(F.col("lang").isin(names)).select("doc_id", "lang").withColumn("h", F.xxhash64("doc_id")).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    # a fixed number for each language and salt: no language goes to one task, and partial limits keep the shuffle small
    first = Window.partitionBy("lang", "salt").orderBy("h", "doc_id")
    chosen = hashed.withColumn("n", F.row_number().over(first)).where(F.col("n") <= PER_LANGUAGE // SALTS).select("doc_id", "lang", "h").distinct()
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "h", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                raw = letters(text)
                at = h % max(1, len(raw) - CHUNK + 1)
                parts.append(raw[at : at + CHUNK])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("h"), pa.array(parts, pa.binary())], ["doc_id", "lang", "h", "part"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang", T.StringType()), T.StructField("h", T.LongType()), T.StructField("part", T.BinaryType())])
    rows = texts.mapInArrow(cut, schema).groupBy("lang", "doc_id").agg(F.min("h").alias("h"), F.min("part").alias("part")).collect()
    parts = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.lang, r.h, r.doc_id)):
        parts[r.lang].append(bytes(r.part))
    return {name: b"\n".join(own) for name, own in parts.items()}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.01) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for each row of ``docs`` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(sent.value)
        for batch in batches:
            found = [encoders.predict(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array([f[2] < margin for f in found], pa.bool_())], ["doc_id", "lang_pred", "score", "margin", "rejected"])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*fields, T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    found = predict(docs, learn(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


QUERIES = {"op2_language": op2_language}
ORACLE: dict[str, str] = {}
