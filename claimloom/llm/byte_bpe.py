"""Byte-level BPE by a rank file, with long texts encoded in overlapping chunks.

A vocabulary is a file of (base64 token, rank) lines. A text is cut by the pre-tokenizer's pattern; a piece that is a token is
that token, any other is merged: its adjacent pair of lowest rank, the leftmost on a tie, until no pair has a rank (a long piece keeps its
pairs in a heap, so that n bytes take O(n log n)).

A text of at most ``chunk`` code points is encoded where it stands. A longer one is cut into chunks that overlap by ``overlap`` code
points, and its chunks are dealt to all tasks, which pre-tokenise each from its own start, most likely in the middle of a pre-token.
Since a match depends on nothing before it, two chunks that start a pre-token at the same place go on alike from there: they are
stitched at the first such place in their overlap. Starts near a chunk's end do not count, as text behind it could change them.
Where two neighbours never meet (a pre-token longer than the overlap), they become one chunk and are pre-tokenised anew, as often as
needed. Chunks are then encoded from stitch to stitch, and a text's ids put together in order. Decoding joins the tokens' bytes.

Chunks are known by the SHA-256 of their text and their number: the same long text is encoded once, however many rows hold it, and
a repeated task makes the same rows. A task holds a chunk at a time; only a row's own text, ids and bytes are ever one value.

The pattern may use ``\\s``, ``\\S``, classes, lookahead of up to ``LOOK`` code points and no assertion on what stands before a match (refused).

Defined cases: null text is empty; empty text has no tokens (the digests are those of empty strings); repeated rows are encoded
alike; texts of any length are encoded whole, also without any boundary; special tokens are not known, their strings are
plain text; extra columns are kept by ``encode`` and ``decode``, but those named like the result (``ids``, ``decoded``) give way to it;
null ``ids`` decode to no bytes; an id outside of the vocabulary is an error; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.bpe import SPACE
from claimloom.llm.common import arrow_batches, table, written
from claimloom.session import spread

#: Code points of a chunk, of an overlap, and behind a match that may decide where it ends.
CHUNK, OVERLAP, LOOK = 32_768, 512, 16
#: Characters of the pieces that a worker remembers (about 100 bytes for each six of them), and of one such piece.
MEMO_CHARS, MEMO_PIECE = 4_000_000, 64
#: Bytes that a vocabulary file may have to be broadcast.
MOST_BYTES = 64 << 20
NEVER = 1 << 60
#: Bytes of a piece whose pairs are looked through each time.
SHORT = 64


def python_pattern(pattern: str) -> str:
    """The pattern with Unicode white space spelled out, since Python counts four control characters to ``\\s``."""
    if regex.search(r"\(\?<[=!]|\\[bBAGK]|(?<![\[\\])\^", pattern):
        raise ValueError("the pattern looks at what stands before a match, so that chunks cannot be stitched")
    out, inside = [], False
    for token in regex.findall(r"\\.|.", pattern, regex.DOTALL):
        inside = (inside or token == "[") and token != "]"
        if token == r"\S" and inside:
            raise ValueError(r"\S inside a class is not supported")
        out.append({r"\s": SPACE if inside else f"[{SPACE}]", r"\S": f"[^{SPACE}]"}.get(token, token))
    return "".join(out)


class Ranks:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, content: bytes, pattern: str):
        lines = (line.split() for line in content.splitlines() if line.strip())
        self.rank_of = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in self.rank_of.items()}
        self.pattern = regex.compile(python_pattern(pattern))
        self.pieces = self.pattern.findall
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        rank_of = self.rank_of
        if (whole := rank_of.get(piece)) is not None:
            return [whole]
        n = len(piece)
        if n <= SHORT:
            get, parts = rank_of.get, [piece[k : k + 1] for k in range(n)]
            pair = [get(x + y, NEVER) for x, y in zip(parts, parts[1:], strict=False)]
            while pair and (low := min(pair)) < NEVER:
                at = pair.index(low)
                parts[at] = own = parts[at] + parts[at + 1]
                del pair[at], parts[at + 1]
                if at:
                    pair[at - 1] = get(parts[at - 1] + own, NEVER)
                if at < len(pair):
                    pair[at] = get(own + parts[at + 1], NEVER)
            return [self.rank(part) for part in parts]
        after, ahead = list(range(1, n + 2)), list(range(-1, n))
        pair = [rank_of.get(piece[k : k + 2], NEVER) for k in range(n - 1)] + [NEVER, NEVER]
        heap = [(rank, at) for at, rank in enumerate(pair) if rank < NEVER]
        heapify(heap)
        while heap:
            rank, at = heappop(heap)
            if pair[at] != rank:
                continue
            gone = after[at]
            after[at] = follow = after[gone]
            ahead[follow] = at
            pair[gone] = NEVER
            left = ahead[at]
            for k in (at, left) if left >= 0 else (at,):
                right = after[k]
                pair[k] = new = rank_of.get(piece[k : after[right]], NEVER) if right < n else NEVER
                if new < NEVER:
                    heappush(heap, (new, k))
        ids, at = [], 0
        while at < n:
            ids.append(self.rank(piece[at : after[at]]))
            at = after[at]
        return ids

    def rank(self, token: bytes) -> int:
        if token not in self.rank_of:
            raise ValueError("the vocabulary lacks a byte")
        return self.rank_of[token]

    def known(self, piece: str) -> bytes:
        """Ids of a piece as 32-bit integers, remembered."""
        ids = array("i", self.merge(piece.encode("utf-8"))).tobytes()
        if len(piece) <= MEMO_PIECE:
            if self.held >= MEMO_CHARS:
                self.memo.clear()
                self.held = 0
            self.memo[piece] = ids
            self.held += len(piece)
        return ids

    def ids(self, text: str, first: int = 0, end: int | None = None) -> bytes:
        """Ids of the pieces that start from ``first`` on and before ``end``, both starts of pieces."""
        get, known = self.memo.get, self.known
        return b"".join([get(p) or known(p) for p in self.pieces(text[first:end])])

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def _built(content: bytes, pattern: str) -> Ranks:
    return Ranks(content, pattern)


def vocabulary(spark: SparkSession, path: str | None, pattern: str | None):
    """A function that gives the encoder in a worker; the file's size is checked before it is broadcast."""
    raw, pattern = Path(path or default_path()).read_bytes(), pattern or default_pattern()
    if len(raw) > MOST_BYTES:
        raise ValueError(f"a vocabulary of {len(raw)} bytes is too large to broadcast")
    python_pattern(pattern)
    content = spark.sparkContext.broadcast(raw)
    return lambda: _built(content.value, pattern)


def lists(of: list[bytes]) -> pa.Array:
    """An Arrow array of lists of 32-bit integers out of their bytes."""
    ends = [0, *accumulate(len(b) // 4 for b in of)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(of))]))


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, no, size, part): chunks of each (key, text); ``part`` goes on for the overlap behind the chunk's own ``size`` code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for at in range(0, len(text), 64 * chunk):
                    own = range(at, min(at + 64 * chunk, len(text)), chunk)
                    sizes = [min(chunk, len(text) - k) for k in own]
                    parts = [text[k : k + chunk + overlap] for k in own]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(own), pa.string()), pa.array([k // chunk for k in own], pa.int64()), pa.array(sizes, pa.int64()), pa.array(parts, pa.string())], ["key", "no", "size", "part"])

    return texts.mapInArrow(run, "key string, no long, size long, part string")


def bounded(chunks: DataFrame, get, overlap: int) -> DataFrame:
    """``chunks`` with the places where pre-tokens start in their first ``overlap`` code points (``head``) and behind their size (``tail``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = get()
        for batch in batches:
            heads, tails = [], []
            for size, part in zip(batch.column("size").to_pylist(), batch.column("part").to_pylist(), strict=True):
                found = ranks.starts(part)
                heads.append([k for k in found if k < overlap])
                tails.append([k - size for k in found if size <= k <= len(part) - LOOK])
            more = [pa.array(x, pa.list_(pa.int32())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "head", "tail"])

    return chunks.mapInArrow(run, T.StructType([*chunks.schema.fields, *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("head", "tail"))]))


def stitched(chunks: DataFrame) -> DataFrame:
    """(key, no, first, until, last, alone): where each chunk's own pieces begin and end; ``alone`` if the next one never meets it."""
    along = Window.partitionBy("key").orderBy("no")
    narrow = chunks.select("key", "no", "size", "tail", F.lead("head").over(along).alias("next"))
    met = narrow.withColumns({"last": F.col("next").isNull(), "meets": F.array_min(F.array_intersect("tail", "next"))})
    first = F.coalesce(F.lag("meets").over(along), F.lit(0))
    return met.select("key", "no", first.alias("first"), (F.col("size") + F.col("meets")).alias("until"), "last", (~F.col("last") & F.col("meets").isNull()).alias("alone"))


def joined_up(chunks: DataFrame, stitches: DataFrame) -> DataFrame:
    """Chunks that never meet the next one, put together with it."""
    along = Window.partitionBy("key").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    runs = stitches.select("key", "no", F.coalesce(F.sum(F.when(~F.col("alone"), 1).otherwise(0)).over(along), F.lit(0)).alias("run"))
    parts = chunks.select("key", "no", "size", "part").join(runs, ["key", "no"]).groupBy("key", "run").agg(F.sort_array(F.collect_list(F.struct("no", "size", "part"))).alias("of"))
    whole = F.array_join(F.transform("of", lambda p, k: F.when(k < F.size("of") - 1, F.substring(p["part"], F.lit(1), p["size"].cast("int"))).otherwise(p["part"])), "")
    return parts.select("key", F.col("of")[0]["no"].alias("no"), F.aggregate("of", F.lit(0).cast("long"), lambda n, p: n + p["size"]).alias("size"), whole.alias("part"))


def encoded_chunks(texts: DataFrame, get, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) of each different (key, text), by chunks."""
    chunks = cut(texts, chunk, overlap).groupBy("key", "no").agg(F.first("size").alias("size"), F.first("part").alias("part"))
    while True:
        chunks = written(bounded(chunks, get, overlap), "bpe-chunks")
        stitches = written(stitched(chunks), "bpe-stitches")
        if stitches.where("alone").isEmpty():
            break
        chunks = joined_up(chunks, stitches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = get()
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "first", "until")), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("no"), lists([ranks.ids(*row) for row in rows])], ["key", "no", "ids"])

    own = chunks.select("key", "no", "part").join(stitches, ["key", "no"]).select("key", "no", "part", "first", "until")
    pieces = own.mapInArrow(run, "key string, no long, ids array<int>")
    whole = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("of"))
    return whole.select("key", F.flatten(F.transform("of", lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with ``ids`` (array of int) added; ``path`` names a rank file."""
    spark = docs.sparkSession
    if not LOOK < overlap <= chunk:
        raise ValueError("an overlap is longer than what decides a match and no longer than a chunk")
    arrow_batches(spark)
    docs, get = docs.drop("ids"), vocabulary(spark, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = get()
        for batch in batches:
            ids = lists([ranks.ids(text or "") for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = docs.where(~is_long).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    key = F.sha2(F.col("text").cast("binary"), 256)
    long = docs.where(is_long)
    found = encoded_chunks(long.select(key.alias("key"), "text"), get, chunk, overlap)
    own = "key"
    while own.lower() in {c.lower() for c in docs.columns}:
        own += "_"
    return short.unionByName(long.withColumn(own, key).join(found.withColumnRenamed("key", own), own).select(*docs.columns, "ids"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded`` (binary) added: the bytes of its ``ids``."""
    spark = encoded.sparkSession
    arrow_batches(spark)
    encoded, get = encoded.drop("decoded"), vocabulary(spark, path, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = get()
        for batch in batches:
            ids = batch.column("ids")
            flat, ends, none = ids.values.to_numpy(zero_copy_only=False).tolist(), ids.offsets.to_pylist(), ids.is_null().to_pylist()
            out = pa.array([b"" if n else ranks.decode(flat[a:b]) for a, b, n in zip(ends, ends[1:], none, strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    both = decode(encode(docs).select("doc_id", "ids"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op12_byte_bpe": op12_byte_bpe}
ORACLE: dict[str, str] = {}
