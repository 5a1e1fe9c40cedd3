"""Line deduplication over all documents.

Each text is cut at ``\\n``; a line's key is the line without blanks at both ends and with A-Z lower-cased. Keys of
``min_chars`` code points or more that ``min_docs`` or more documents hold lose all their lines, except in the largest
doc_id that holds them.

Plan: one narrow row (doc_id, 128-bit key hash) for each distinct key of a document; ``distinct`` by (doc_id, hash), so a
hot line is spread over its documents; then counts by hash, partly summed before the shuffle. Only hashes over the threshold
go back to the narrow rows (a join whose hot side adaptive execution can split), and each document gets the array of its
dropped hashes. Texts move once, in the last join by doc_id.

Defined cases: null or empty text is one empty line; rows with a null doc_id count as no document and keep all lines; rows
that repeat a doc_id are one document for the counts, and each loses the same keys; ties and texts of any length are no special
case; extra columns are kept as they are, but one named ``n_lines`` or ``n_dropped`` gives way to the result's; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import DOCUMENT, arrow_batches, table, written
from claimloom.session import spread

BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None for a key that is too short."""
    key = line.strip(BLANKS)
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _text_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    return [line_key(line, min_chars) for line in (text or "").encode("utf-8").lower().split(b"\n")]


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, key): one row for each distinct long key of a document."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, at = batch.column("doc_id"), [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = {key for key in _text_keys(text, min_chars) if key}
                found.extend(own)
                at.extend([row] * len(own))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], ["doc_id", "key"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("key", T.BinaryType())])
    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(keys, schema)


def dropped_keys(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, keys): the keys that a document loses; documents that lose none have no row."""
    held = written(document_keys(docs, min_chars).distinct(), "line-keys")
    common = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    common = written(common, "line-common")  # a table of its own, so that the join below may split a hot key
    return held.join(common, "key").where("doc_id <> keeper").groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the kept text in ``text`` and with n_lines (before) and n_dropped added."""
    arrow_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    lost = dropped_keys(docs, min_chars, min_docs).select(F.col("doc_id").alias("__lost_id"), F.col("keys").alias("__lost_keys"))
    joined = docs.join(lost, docs["doc_id"] == lost["__lost_id"], "left").drop("__lost_id")
    kept = [f for f in docs.schema.fields]
    schema = T.StructType([*kept, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in kept]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, gone = [], [], []
            for text, lost in zip(batch.column("text").to_pylist(), batch.column("__lost_keys").to_pylist(), strict=True):
                if not lost:
                    texts.append(text)
                    before.append((text or "").count("\n") + 1)
                    gone.append(0)
                    continue
                lost, lines = set(lost), (text or "").split("\n")
                stay = [line for line, key in zip(lines, _text_keys(text, min_chars), strict=True) if key not in lost]
                texts.append("\n".join(stay))
                before.append(len(lines))
                gone.append(len(lines) - len(stay))
            columns = {name: batch.column(name) for name in names} | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(before, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(keep, schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the same documents without their common lines; a document left with no word goes."""
    out = dedup_lines(docs.select(*DOCUMENT))
    return out.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {"op9_line_dedup": op9_line_dedup}
#: Line keys: blanks off both ends, then A-Z lower-cased.
_KEY = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op9_line_dedup": f"""
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents),
lines as (select doc_id, unnest(a) as line, generate_subscripts(a, 1) as pos from parts),
keyed as (select doc_id, line, pos, {_KEY} as k from lines),
common as (select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
marked as (select d.doc_id, d.line, d.pos, coalesce(d.doc_id <> c.keeper, false) as lost from keyed d left join common c on d.k = c.k)
select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
from marked group by doc_id"""
}
