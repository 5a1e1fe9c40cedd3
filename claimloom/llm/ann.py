"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a bounded sample (principal axes, then iterative quantisation; several rotations for narrow vectors) turns a
vector into a code of BITS bits, split into 4, 8 or 16 substrings, the pieces. Each piece has its own index: postings (piece,
value) -> vectors, dealt out by bits of the value, so a bucket holds neighbouring values. A query goes to those buckets of each
index whose bits can still be within the piece's threshold, and probes there the postings of the values within it. Thresholds add
up to radius - pieces + 1, so by the pigeonhole principle every code within ``radius`` differs from the query by no more than the
threshold in one piece at least, and is found; it counts in the first such piece alone, so nothing is counted twice. Codes found
are checked in full, and those within the radius are ranked by the exact inner product in double precision. More pieces mean more
postings but narrower thresholds, by which routing leaves out more buckets; their number is planned from the radius and the
numbers of vectors and queries (``Probing.planned``). It changes the cost, not what is found.

The radius comes from the table itself: PROBES queries are compared with every row, in one pass whose cost is linear, and the
radius holds the share RECALL of their true neighbours. So it shrinks as a growing table brings neighbours nearer. Queries with
fewer than k codes in the radius are asked again with a threshold that lets every code through one piece, which is exact search.

Vectors of varying length get one more coordinate before they are encoded, sqrt(longest ** 2 - length ** 2), and queries zero
there: the largest inner products are then the smallest angles.

Bounds. Of equal vectors the k + 1 smallest vec_ids alone can be among anyone's k nearest (ties go to the smaller vec_id, and a
query leaves out itself), so the others are asked about but not posted; this is exact. Buckets of more than POSTINGS are
dealt to several shards by the hash of vec_id, and queries of a bucket beyond QUERIES_PER_BLOCK likewise, so a task's input is bounded.

On vectors without structure (directions at random) the neighbours of a query stand at 60 degrees and more; a radius that holds
them leaves thresholds so wide that every bucket has to be visited, whatever the index. See README for measured shares.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with a null
vec_id or vectors of another dimension than most; repeated rows of one vec_id count once (the smallest vector stays); with
fewer than k candidates all are returned; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_batches, table, written

BITS, WORDS = 256, 4
SAMPLE, PROBES, RECALL = 4_096, 256, 0.97
#: Postings and queries of one task, at most; bits that buckets are told apart by, at least and at most.
POSTINGS, QUERIES_PER_BLOCK, LEAST_BITS, MOST_BITS = 16_384, 8_192, 2, 16
#: Comparisons of a query with a value that are held in memory at once.
AT_ONCE = 2_000_000
#: Numbers of pieces to choose from, and seconds, about, that a query's look at a posting and a posting's way to a bucket take.
PIECES, LOOK_S, WAY_S = (4, 8, 16), 1.5e-9, 2e-6
CODES = [f"c{i}" for i in range(WORDS)]
RESULT = "query_id long, rank int, vec_id long, score double"


class Coder:
    """Learned rotations: principal axes of the centred sample, then iterative quantisation."""

    def __init__(self, sample: np.ndarray, longest: float, rounds: int = 30):
        self.longest = longest
        x = self.widen(sample)
        self.mean = x.mean(axis=0)
        x = x - self.mean
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :BITS]
        width = axes.shape[1]
        rng = np.random.default_rng(7)
        at, parts = x @ axes, []
        for _ in range(ceil(BITS / width)):  # narrow vectors get several rotations
            spin = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(rounds if len(x) > width else 0):
                u, _, v = np.linalg.svd(np.sign(at @ spin).T @ at)
                spin = (u @ v).T
            parts.append(axes @ spin)
        self.turn = np.hstack(parts)[:, :BITS]

    def widen(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.longest**2 - (x * x).sum(axis=1)))
        return np.hstack([x, rest[:, None]])

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """One row of WORDS numbers for each vector."""
        bits = (self.widen(x, query) - self.mean) @ self.turn > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


@dataclass(frozen=True)
class Probing:
    """``limits``: the threshold of each piece, -1 where none is probed; ``bits``: how many of a piece's tell buckets apart."""

    radius: int
    limits: tuple[int, ...]
    bits: int

    @property
    def width(self) -> int:
        return BITS // len(self.limits)

    @staticmethod
    def within(radius: int, bits: int, pieces: int = 4) -> Probing:
        spare = radius - pieces + 1
        return Probing(radius, tuple(max(-1, spare // pieces + (i < spare % pieces)) for i in range(pieces)), min(bits, BITS // pieces))

    @staticmethod
    def planned(radius: int, vectors: int, queries: int, postings: int) -> Probing:
        """The number of pieces at which looking (queries x the share of buckets they visit) and posting cost least."""
        bits = min(MOST_BITS, max(LEAST_BITS, ceil(log2(max(1.0, vectors / postings)))))
        options = [Probing.within(radius, bits, m) for m in PIECES]
        return min(options, key=lambda o: queries * LOOK_S * sum(map(o.visited, o.limits)) + WAY_S * len(o.limits))

    def everything(self) -> Probing:
        """Every code through the first piece."""
        return Probing(BITS, (self.width, *[-1] * (len(self.limits) - 1)), self.bits)

    def visited(self, limit: int) -> float:
        """Share of buckets that a query visits at a piece's threshold."""
        return sum(comb(self.bits, k) for k in range(min(limit, self.bits) + 1)) / 2**self.bits

    def of(self, codes: np.ndarray, piece: int) -> np.ndarray:
        """A piece of each code."""
        word, at = divmod(piece * self.width, 64)
        return codes[:, word] >> np.uint64(at) & np.uint64((1 << self.width) - 1)

    def bucket(self, piece: int) -> Column:
        """A posted code's bucket of a piece: the piece's low bits."""
        word, at = divmod(piece * self.width, 64)
        return F.shiftrightunsigned(F.col(CODES[word]), at).bitwiseAND(F.lit((1 << self.bits) - 1).cast("long"))

    def buckets(self, piece: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among ``codes``, bucket) for the buckets that may hold codes within the piece's threshold."""
        flips = np.arange(1 << self.bits, dtype=np.uint64)
        flips = flips[np.bitwise_count(flips) <= self.limits[piece]] if self.limits[piece] >= 0 else flips[:0]
        own = self.of(codes, piece) & np.uint64((1 << self.bits) - 1)
        return np.repeat(np.arange(len(codes)), len(flips)), (own[:, None] ^ flips).ravel().astype(np.int64)


class Postings:
    """One bucket of one piece's index: its values and, for each, the rows that have it."""

    def __init__(self, codes: np.ndarray, piece: int, probing: Probing):
        self.codes, self.piece, self.probing = codes, piece, probing
        self.values, of, self.sizes = np.unique(probing.of(codes, piece), return_inverse=True, return_counts=True)
        self.rows = np.argsort(of, kind="stable")
        self.first = np.cumsum(self.sizes) - self.sizes

    def found(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) of the codes within the radius that this piece is the first to find, by blocks of queries."""
        probing, own = self.probing, self.probing.of(asked, self.piece)
        step = max(1, AT_ONCE // max(1, len(self.values)))
        for at in range(0, len(asked), step):
            q, value = np.nonzero(np.bitwise_count(own[at : at + step, None] ^ self.values) <= probing.limits[self.piece])
            size = self.sizes[value]
            row = self.rows[np.repeat(self.first[value] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            q = np.repeat(q, size) + at
            gone = asked[q] ^ self.codes[row]
            near = np.bitwise_count(gone).sum(axis=1, dtype=np.int16) <= probing.radius
            q, row, gone = q[near], row[near], gone[near]
            first = np.ones(len(q), dtype=bool)
            for i in range(self.piece):
                first &= np.bitwise_count(probing.of(gone, i)).astype(np.int16) > probing.limits[i]
            yield q[first], row[first]


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision; a row's value does not depend on the other rows."""
    return (x * q).sum(axis=1)


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best_of(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, q))
    own = q[order]
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
    return order[rank < k]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): rows that take part, one for each vec_id."""
    good = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    return vectors.where(good).select("vec_id", F.col("embedding").alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def encoded(rows: DataFrame, coder: Coder) -> DataFrame:
    """``rows`` (vec_id, v) with their codes as signed longs c0, c1, ..."""
    sent = rows.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = sent.value.codes(vectors_of(batch.column("v"))).view(np.int64) if batch.num_rows else np.zeros((0, WORDS), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(codes[:, i].copy()) for i in range(WORDS)]], [*batch.schema.names, *CODES])

    return rows.mapInArrow(run, ", ".join([f"vec_id long, v {rows.schema['v'].dataType.simpleString()}", *[f"{c} long" for c in CODES]]))


def radius_of(rows: DataFrame, probes: list, coder: Coder, k: int) -> int:
    """Radius that holds the share RECALL of the true neighbours of ``probes``, which are compared with every row."""
    sent = rows.sparkSession.sparkContext.broadcast((coder, np.array([p.v for p in probes], dtype=np.float64), np.array([p.vec_id for p in probes])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, q, q_ids = sent.value
        asked = coder.codes(q, query=True)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = vectors_of(batch.column("v")), batch.column("vec_id").to_numpy()
            codes = coder.codes(x)
            scores = np.where(q_ids[:, None] == ids, -np.inf, q @ x.T)
            near = np.argpartition(-scores, min(k, len(ids) - 1), axis=1)[:, :k] if len(ids) > k else np.tile(np.arange(len(ids)), (len(q), 1))
            probe, row = np.repeat(np.arange(len(q)), near.shape[1]), near.ravel()
            other = q_ids[probe] != ids[row]
            probe, row = probe[other], row[other]
            gone = np.bitwise_count(asked[probe] ^ codes[row]).sum(axis=1, dtype=np.int64)
            held = tuple(np.concatenate(pair) for pair in zip(held, (probe, ids[row], scores[probe, row], gone), strict=True))
            best = best_of(held[0], held[1], held[2], k)
            held = tuple(part[best] for part in held)
        yield pa.RecordBatch.from_arrays([pa.array(part) for part in held], ["probe", "vec_id", "score", "gone"])

    best = rows.select("vec_id", "v").mapInArrow(run, "probe long, vec_id long, score double, gone long")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    counted = sorted((r.gone, r.n) for r in best.groupBy("gone").agg(F.count("*").alias("n")).collect())  # BITS + 1 rows at most
    enough, upto = RECALL * sum(n for _, n in counted), 0
    for gone, n in counted:
        upto += n
        if upto >= enough:
            return gone
    return BITS


def _lookup(index: DataFrame, asked: DataFrame, coder: Coder, probing: Probing, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each query in each shard it visits."""
    spark = index.sparkSession
    v_type = index.schema["v"].dataType.simpleString()
    sent = spark.sparkContext.broadcast((coder, probing))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, probing = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = coder.codes(vectors_of(batch.column("v")), query=True)
            for piece, limit in enumerate(probing.limits):
                step = max(1, AT_ONCE // max(1, round(probing.visited(limit) * 2**probing.bits)))
                for start in range(0, len(codes), step):
                    place, bucket = probing.buckets(piece, codes[start : start + step])
                    for at in range(0, len(place), 4096):
                        own = place[at : at + 4096] + start
                        rows = batch.take(pa.array(own))
                        columns = [pa.array(np.full(len(own), piece, np.int32)), pa.array(bucket[at : at + 4096]), *rows.columns, *[pa.array(codes[own, i].view(np.int64)) for i in range(WORDS)]]
                        yield pa.RecordBatch.from_arrays(columns, ["piece", "bucket", "vec_id", "v", *CODES])

    pieces = [i for i, limit in enumerate(probing.limits) if limit >= 0]
    key = F.explode(F.array(*[F.struct(F.lit(i).alias("piece"), probing.bucket(i).alias("bucket")) for i in pieces])).alias("k")
    posted = index.select(key, "vec_id", "v", *CODES).select("k.*", "vec_id", "v", *CODES)
    routed = written(asked.select("vec_id", "v").mapInArrow(route, ", ".join(["piece int, bucket long, vec_id long", f"v {v_type}", *[f"{c} long" for c in CODES]])), "ann-routed")
    held = index.select(key).select("k.*").groupBy("piece", "bucket").agg(F.count("*").alias("rows"))
    visits = routed.groupBy("piece", "bucket").agg(F.count("*").alias("queries"))
    shard = lambda column, most: F.ceil(F.col(column) / most).cast("int")
    sizes = written(held.join(visits, ["piece", "bucket"]).select("piece", "bucket", shard("rows", POSTINGS).alias("shards"), shard("queries", QUERIES_PER_BLOCK).alias("blocks")), "ann-buckets")
    own = lambda salt, of: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))  # noqa: E731  one but for buckets over the bounds
    left = posted.join(sizes, ["piece", "bucket"]).withColumn("shard", own("shard", "shards")).withColumn("block", every("blocks"))
    right = routed.join(sizes, ["piece", "bucket"]).withColumn("block", own("block", "blocks")).withColumn("shard", every("shards"))
    keys, columns = ["piece", "bucket", "shard", "block"], ["vec_id", "v", *CODES]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        coder, probing = sent.value
        out = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())]
        if left.num_rows and right.num_rows:
            piece = left.column("piece")[0].as_py()
            codes, asked = (np.stack([t.column(c).to_numpy().view(np.uint64) for c in CODES], axis=1) for t in (left, right))
            (x, ids), (q, q_ids) = ((vectors_of(t.column("v")), t.column("vec_id").to_numpy()) for t in (left, right))
            parts = []
            for query, row in Postings(codes, piece, probing).found(asked):
                other = q_ids[query] != ids[row]
                query, row = query[other], row[other]
                scores = np.concatenate([products(x[row[at : at + 65_536]], q[query[at : at + 65_536]]) for at in range(0, len(row), 65_536)] or [np.zeros(0)])
                best = best_of(query, ids[row], scores, k)
                parts.append((q_ids[query[best]], ids[row[best]], scores[best]))
            out = [pa.array(np.concatenate(column)) for column in zip(*parts, strict=True)]
        return pa.table(dict(zip(["query_id", "vec_id", "score"], out, strict=True)))

    return left.select(*keys, *columns).groupBy(*keys).cogroup(right.select(*keys, *columns).groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _posted(rows: DataFrame, k: int) -> DataFrame:
    """Rows without those of equal vectors that nobody's k nearest can hold: all but the k + 1 smallest vec_ids."""
    same: list[Column | str] = [F.xxhash64("v").alias("h"), "v"]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))).where(F.col("__n") <= k + 1).drop("__n")


def search(vectors: DataFrame, k: int = 20, every: int = 20, postings: int = POSTINGS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    arrow_batches(spark, 4096)
    rows = written(usable(vectors), "ann-vectors")
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, 0d, (a, x) -> a + double(x) * double(x))")).alias("longest")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("v") == widths.w)
    asked = rows.where(F.col("vec_id") % every == 0)
    probes = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).collect()
    if not probes:
        return spark.createDataFrame([], RESULT)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    coder = Coder(np.array([r.v for r in sample], dtype=np.float64), float(np.sqrt(widths.longest)))
    probing = Probing.planned(radius_of(rows, probes, coder, k), widths.n, asked.count(), postings)
    index = written(encoded(_posted(rows, k), coder), "ann-codes")
    found = written(_ranked(_lookup(index, asked, coder, probing, k), k), "ann-found")
    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(enough, "vec_id", "left_anti"), "ann-short")
    if not short.limit(1).count():
        return found
    again = _ranked(_lookup(index, short, coder, probing.everything(), k), k)
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*again.columns).unionByName(again)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op8_neighbours": op8_neighbours}
ORACLE: dict[str, str] = {}
