"""Cross-tokenizer alignment: where the tokens of two tokenizers meet, and which of them stand for each other.

Tokenizer A is byte-level BPE (a tokenizers JSON file) over a space and the text, B a SentencePiece model over the text, which adds the
space itself. Both then spell the same bytes. Offsets where a token of A and one of B both end cut a text's tokens into groups, and
the two tokens that end there are linked. A pair of ids counts as often as it is linked in the corpus.

Plan: in Arrow batches texts are encoded, and token lengths summed to intervals of bytes. Texts are laid end to end in blocks of about
``BLOCK_TOKENS``, cut where A and B meet when one is longer. In each block DuckDB gets two interval tables: an ASOF join finds the
token of B that each token of A starts in, a range join the further ones that start inside it, those that end together are links, and
a window sum over them numbers the groups. What comes back is a row for each text with its different pairs. Spark sums the
pairs, first within a shard of rows (``SHARD_PAIRS`` pairs or a little more), then over the corpus. The sums go back to the shards that
hold the pair, so that a frequent pair is looked up once for a shard, not once for each of its documents.

Defined cases: null and empty texts have no tokens, nor have texts whose bytes either tokenizer does not give back (white space that B
normalises); all their columns are zeros and the groups ''. Strings of special tokens in a text are plain text. Repeated rows are rows of
their own, and count as often. Ties for a B id's highest count are all best. Texts of any length are aligned whole; B encodes each as one
value. Extra columns are kept, but those named like the result give way to it. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.bpe import MOST_BYTES, Bpe, default_path
from claimloom.llm.byte_bpe import default_pattern
from claimloom.llm.common import arrow_batches, table, written
from claimloom.session import spread

BLOCK_TOKENS, SHARD_PAIRS = 100_000, 1_000_000
#: Memory that a worker's DuckDB may use; a block takes about 50 MB.
MEMORY = "300MB"
#: An id pair is a * PAIR + b.
PAIR = 1 << 31
BLANK = "▁"

#: Overlaps of the tokens of a block. Tokens of the same bytes overlap each other alone; of the others, the token of B that a token of
#: A starts in, then those that start inside it. Steps are tables of their own, so that each join is planned for the rows that there are.
OVERLAPS = [
    "create or replace temp table a as select * from a_tokens",
    "create or replace temp table b as select * from b_tokens",
    "create or replace temp table same as select i, j, doc, a.id, b.id as other from a join b on a.s = b.s and a.e = b.e",
    "create or replace temp table more_a as select * from a anti join same using (i)",
    "create or replace temp table more_b as select * from b anti join same using (j)",
    "create or replace temp table first as select a.i, a.doc, a.id, a.s, a.e, b.j, b.id as other, b.e as till from more_a a asof join more_b b on a.s >= b.s",
    """create or replace temp table overlap as select i, j, doc, id, other, true as together from same
    union all select i, j, doc, id, other, e = till from first
    union all select f.i, b.j, f.doc, f.id, b.id, f.e = b.e from (select * from first where till < e) f join more_b b on b.s > f.s and b.s < f.e""",
]
GROUPS = "select i, j, sum(1) over (order by i rows between unbounded preceding and current row) as number from overlap where together order by i"
PAIRS = f"select doc, id::bigint * {PAIR} + other as pair, count(*)::integer as n from overlap where together group by all order by all"
TOUCHED = "select doc, count(*) as n from overlap group by doc order by doc"

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, groups string, shard string, pairs array<long>, counts array<int>"


def piece_bytes(piece: str) -> bytes:
    """The bytes of a SentencePiece piece: a blank for U+2581, one byte for <0xHH>."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(BLANK, " ").encode("utf-8")


def ranks(own: Bpe) -> dict[bytes, int]:
    """The tokens of a byte-level vocabulary by rank, where its merges are in the order of its ids; others are refused."""
    if own.made != sorted(own.made) or len(own.made) + 256 + len(own.special) != len(own.bytes_of):
        raise ValueError("the merges of A are not in the order of its ids")
    return {token: k for k, token in own.bytes_of.items() if k not in own.special.values()}


class Aligner:
    """Both tokenizers and a DuckDB connection, in a worker."""

    def __init__(self, a: str, b: bytes, pattern: str):
        own = Bpe(a)
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks(own), special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes = [own.bytes_of.get(k, b"") for k in range(max(own.bytes_of) + 1)]
        self.b_bytes = [piece_bytes(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.b_start = 2 * len(self.a_bytes)
        self.words = [f"{k}{end}" for of, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for k in range(len(of)) for end in ends]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B, none if either does not spell the text."""
        none = np.zeros(0, np.int32)
        if not text:
            return none, none
        whole = " " + text
        a, b = self.a.encode_to_numpy(whole, disallowed_special=()), self.b.encode(text)
        raw = whole.encode("utf-8")
        # A's tokens are the text's bytes in order, all of them if their sizes add up
        if self.a_sizes[a].sum() != len(raw) or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return none, none
        return a.astype(np.int32), np.array(b, np.int32)

    def segments(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tokens of a text, cut where A and B meet into parts of a block's size or as little more as may be."""
        if len(a) <= BLOCK_TOKENS:
            yield a, b
            return
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        meet = np.intersect1d(a_ends, b_ends, assume_unique=True)
        i, j = np.searchsorted(a_ends, meet) + 1, np.searchsorted(b_ends, meet) + 1
        at = (0, 0)
        while at[0] < len(a):
            k = min(np.searchsorted(i, at[0] + BLOCK_TOKENS), len(i) - 1)
            yield a[at[0] : i[k]], b[at[1] : j[k]]
            at = i[k], j[k]

    def block(self, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[dict, list[tuple[int, str, int]]]:
        """Pairs and overlaps by document of a block, and the text of each part's groups with their number."""
        doc = [p[0] for p in parts]
        a, b = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        of_doc = np.repeat(np.array(doc, np.int32), [len(p[1]) for p in parts])
        con = self.con
        con.register("a_tokens", pa.table({"i": np.arange(len(a), dtype=np.int32), "doc": of_doc, "id": a, "s": a_ends - self.a_sizes[a], "e": a_ends}))
        con.register("b_tokens", pa.table({"j": np.arange(len(b), dtype=np.int32), "id": b, "s": b_ends - self.b_sizes[b], "e": b_ends}))
        for step in OVERLAPS:
            con.execute(step)
        groups, pairs, touched = (con.execute(q).fetchnumpy() for q in (GROUPS, PAIRS, TOUCHED))
        i, j = groups["i"].astype(np.int64), groups["j"].astype(np.int64)
        # a group's tokens of A stand before its tokens of B, behind all of the groups before it
        before_i, before_j = np.r_[-1, i[:-1]], np.r_[-1, j[:-1]]
        word = np.empty(len(a) + len(b), np.int64)
        a_code, b_code = a.astype(np.int64) * 2, b.astype(np.int64) * 2 + self.b_start
        a_code[i] += 1
        b_code[j] += 1
        word[np.arange(len(a)) + np.repeat(before_j + 1, i - before_i)] = a_code
        word[np.arange(len(b)) + np.repeat(i + 1, j - before_j)] = b_code
        words, texts, at, a_at = list(map(self.words.__getitem__, word.tolist())), [], 0, 0
        for d, own, other in parts:
            until, a_until = at + len(own) + len(other), a_at + len(own)
            texts.append((d, "".join(words[at:until])[:-1], int(np.searchsorted(i, a_until) - np.searchsorted(i, a_at))))
            at, a_at = until, a_until
        return {"doc": pairs["doc"], "pair": pairs["pair"], "n": pairs["n"], "touched": dict(zip(touched["doc"].tolist(), touched["n"].tolist(), strict=True))}, texts


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _built(a: str, b: bytes, pattern: str) -> Aligner:
    return Aligner(a, b, pattern)


class Rows:
    """Rows of documents as their blocks come in; a document's parts may stand in several blocks."""

    def __init__(self, aligner: Aligner, texts: bool):
        self.aligner, self.texts = aligner, texts
        self.shard, self.shard_pairs = uuid.uuid4().hex, 0

    def of(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
        """The columns of ALIGNED for the texts of one batch."""
        n = len(tokens)
        digests, groups = [None] * n, [[] for _ in range(n)]
        n_groups, n_overlaps = np.zeros(n, np.int64), np.zeros(n, np.int64)
        found: list[dict] = []
        waiting, size = [], 0
        for d, both in enumerate(tokens):
            for a, b in self.aligner.segments(*both) if len(both[0]) else ():
                waiting.append((d, a, b))
                size += len(a)
                if size >= BLOCK_TOKENS:
                    found.append(self._put(waiting, digests, groups, n_groups, n_overlaps))
                    waiting, size = [], 0
        if waiting:
            found.append(self._put(waiting, digests, groups, n_groups, n_overlaps))
        doc, pair, count = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in ("doc", "pair", "n"))
        order = np.lexsort((pair, doc))
        doc, pair, count = doc[order], pair[order], count[order]
        heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]) if len(doc) else np.zeros(0, np.int64)
        doc, pair, count = doc[heads], pair[heads], np.add.reduceat(count, heads) if len(heads) else count
        ends = np.searchsorted(doc, np.arange(n + 1))
        shards = []
        for d in range(n):
            if self.shard_pairs >= SHARD_PAIRS:
                self.shard, self.shard_pairs = uuid.uuid4().hex, 0
            shards.append(self.shard)
            self.shard_pairs += int(ends[d + 1] - ends[d])
        offsets = pa.array(ends, pa.int32())
        longs = [np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1)] + [n_groups, n_groups, n_overlaps]
        sha = pa.array(["" if x is None else x.hexdigest() for x in digests], pa.string())
        text = pa.array([";".join(g) if self.texts else None for g in groups], pa.string())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pair.astype(np.int64), count.astype(np.int32))]
        return [*map(pa.array, longs), sha, text, pa.array(shards, pa.string()), *lists]

    def _put(self, parts, digests, groups, n_groups, n_overlaps) -> dict:
        found, texts = self.aligner.block(parts)
        for d, text, number in texts:
            if digests[d] is None:
                digests[d] = hashlib.sha256(text.encode())
            else:
                digests[d].update(b";" + text.encode())
            if self.texts:
                groups[d].append(text)
            n_groups[d] += number
        for d, number in found["touched"].items():
            n_overlaps[d] += number
        return found


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, texts: bool = False) -> DataFrame:
    """``docs`` without text, with the columns of ALIGNED: numbers, the groups' digest (and ``groups`` itself if ``texts``), and pairs with their links.

    A link stands at the end of each group, so there are as many of the one as of the other. A pair is a * PAIR + b.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    raw = [Path(a_path or default_path()).read_bytes(), Path(b_path or default_model()).read_bytes()]
    if max(map(len, raw)) > MOST_BYTES:
        raise ValueError("a vocabulary is too large to broadcast")
    content = spark.sparkContext.broadcast((raw[0].decode("utf-8"), raw[1], default_pattern()))
    ranks(Bpe(content.value[0]))
    schema = T._parse_datatype_string(ALIGNED)
    kept = [c for c in docs.columns if c not in (*schema.names, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _built(*content.value)
        rows = Rows(aligner, texts)
        for batch in batches:
            out = rows.of([aligner.tokens(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *out], [*kept, *schema.names])

    return docs.select(*kept, "text").mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), *schema.fields]))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(shard, pair, count, best): each pair's links in the corpus, for each shard that holds it; ``best`` if no A id has more with its B id."""
    linked = aligned.select("shard", F.explode(F.arrays_zip("pairs", "counts")).alias("l")).select("shard", F.col("l.pairs").alias("pair"), F.col("l.counts").alias("n"))
    own = written(linked.groupBy("shard", "pair").agg(F.sum("n").alias("n")), "alignment-shards")
    counts = written(own.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % PAIR), "alignment-pairs")
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    return own.select("shard", "pair").join(judged, "pair")


def scored(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a written table) without its pairs, with ``n_best`` and ``count_sum`` over each document's links."""
    kept = [f for f in aligned.schema.fields if f.name not in ("shard", "pairs", "counts")]
    names = [f.name for f in kept]

    def look_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
        pairs, n = (docs.column(c).combine_chunks() for c in ("pairs", "counts"))
        ends = pairs.offsets.to_numpy()
        pair, n = pairs.values.to_numpy()[ends[0] : ends[-1]], n.values.to_numpy()[ends[0] : ends[-1]].astype(np.int64)
        known = counts.column("pair").to_numpy()
        order = np.argsort(known)
        at = order[np.searchsorted(known[order], pair)] if len(pair) else np.zeros(0, np.int64)
        count, best = counts.column("count").to_numpy()[at], counts.column("best").to_numpy(zero_copy_only=False)[at].astype(bool)
        sums = [np.r_[0, np.cumsum(x)] for x in (np.where(best, n, 0), n * count)]
        return docs.select(names).append_column("n_best", pa.array(np.diff(sums[0][ends - ends[0]]))).append_column("count_sum", pa.array(np.diff(sums[1][ends - ends[0]])))

    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return aligned.groupBy("shard").cogroup(pair_counts(aligned).groupBy("shard")).applyInArrow(look_up, schema)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored(written(align(docs), "alignment")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


QUERIES = {"op13_alignment": op13_alignment}
ORACLE: dict[str, str] = {}
