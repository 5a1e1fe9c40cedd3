"""SimHash near-duplicates with a Gray-order hierarchical index.

A text's words (A-Z lower-cased) give shingles of three words, repeats included; a fingerprint bit is one if it is set in more
than half of the shingles' XXH64 (seed 42). Fingerprints link at ``radius`` or fewer differing bits, and a component is what
links reach.

Search. Equal fingerprints become one first, so copies never meet as pairs. Each distinct fingerprint is sent to the bins of
its masked blocks: with ``blocks`` blocks and ``radius`` differences, some ``blocks - radius`` blocks are equal, so every
choice of that many blocks is one table and every link is inside a bucket of one of them. ``blocks`` follows from the number
of fingerprints, so that a bucket of unrelated ones stays small. Buckets over ``HEAVY`` fingerprints are cut again by blocks of
their remaining bits, as often as it takes, which loses no link by the same argument. In a bin, fingerprints are sorted by bucket and Gray rank; runs
of 16 form leaves and runs of leaves upper nodes, each holding the bits its members share and its parent does not. A query goes
down from its bucket's root, adds up differences against those bits, and leaves a node once they pass the radius.

A bin returns a spanning forest (fingerprint, smallest fingerprint linked in the bin), not pairs. Components follow from
alternating large-star and small-star steps over those edges, each step a written table, until the edges no longer change.

Defined cases: null or empty text, or text of blanks, has fingerprint zero, which links like any other; texts of one or two
words are one shingle; repeated rows and ties are equal fingerprints; a null doc_id takes part, and a component's id is the
smallest doc_id that is not null (null if there is none); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm import near_copies
from claimloom.llm.common import DOCUMENT, arrow_batches, partitions, sieve, sifted, table, written
from claimloom.session import spread

#: Members of a leaf and children of an upper node.
FANOUT = 16
#: Fingerprints that one bucket may hold before it is cut by further blocks.
HEAVY = 20_000
#: Fingerprints, times tables, for each bin.
BIN_ROWS = 40_000
#: First number of rows without a doc_id in the pipeline's stage.
UNNAMED = 1 << 62


def fingerprint(text: str | None, n: int = 3) -> int:
    """64-bit SimHash of one text, as an unsigned number."""
    words = (text or "").encode("utf-8").lower().split()
    return _fingerprint(words, n)


def _fingerprint(words: list[bytes], n: int) -> int:
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= n:
        return digest(b" ".join(words), 42)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return majority(np.array([digest(s, 42) for s in shingles], dtype=np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingles' hashes, as an unsigned number: a bit is one if it is set in more than half of them."""
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(text, n) for text in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    arrow_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def block_masks(blocks: int, bits: int = 64) -> list[int]:
    """Masks of consecutive blocks of almost equal width."""
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def bucket_masks(blocks: int, radius: int) -> list[int]:
    """One mask for each choice of blocks that must be equal."""
    own = block_masks(blocks)
    return [sum(chosen) for chosen in combinations(own, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Fingerprints of one bin, in buckets, with an upper tree over each bucket.

    ``codes`` and ``keys`` are unsigned; a code stands once in each bucket. ``order`` sorts by bucket, then Gray rank.
    """

    def __init__(self, codes: np.ndarray, keys: np.ndarray):
        self.order = np.lexsort((gray_rank(codes), keys))
        self.codes, keys = codes[self.order], keys[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # first and last child, pattern, own mask
        masks: list[np.ndarray] = []
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        both, any_ = self.codes, self.codes
        while True:
            place = np.arange(sizes.sum()) - np.repeat(np.r_[0, np.cumsum(sizes)[:-1]], sizes)
            first = np.flatnonzero(place % FANOUT == 0)
            last = np.r_[first[1:], len(place)]
            both, any_ = np.bitwise_and.reduceat(both, first), np.bitwise_or.reduceat(any_, first)
            masks.append(~(both ^ any_))
            self.levels.append((first, last, both, masks[-1]))
            sizes = -(-sizes // FANOUT)
            if len(sizes) == 0 or sizes.max() == 1:
                break
        self.roots = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)]))
        for k in range(len(self.levels) - 1):  # what the parent has factored out is not compared again
            first, last, pattern, mask = self.levels[k]
            parent = np.repeat(np.arange(len(self.levels[k + 1][0])), self.levels[k + 1][1] - self.levels[k + 1][0])
            self.levels[k] = (first, last, pattern, mask & ~masks[k + 1][parent])
        self.masks = masks

    def pairs(self, radius: int, at_most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (a < b) of linked codes, by chunks of queries whose frontiers stay near ``at_most``."""
        n = len(self.codes)
        if n < 2:
            return
        sizes = np.bincount(self.roots)[self.roots]
        upto = np.cumsum(sizes)
        at = 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + at_most, side="right")))
            yield self._descend(np.arange(at, end), radius)
            at = end

    def _descend(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        node = self.roots[query]
        gone = np.zeros(len(query), dtype=np.uint8)
        for first, last, pattern, mask in reversed(self.levels):
            gone = gone + np.bitwise_count((self.codes[query] ^ pattern[node]) & mask[node])
            stay = gone <= radius
            query, node, gone = query[stay], node[stay], gone[stay]
            width = (last - first)[node]
            child = np.repeat(first[node], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            query, gone, node = np.repeat(query, width), np.repeat(gone, width), child
        ahead = node > query
        query, node = query[ahead], node[ahead]
        near = np.bitwise_count(self.codes[query] ^ self.codes[node]) <= radius
        return query[near], node[near]


def forest(codes: np.ndarray, keys: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, smallest linked code) for the codes of a bin that are not the smallest of their component."""
    index = GrayIndex(codes, keys)
    values = np.unique(codes)
    of = np.searchsorted(values, index.codes)
    parent = np.arange(len(values))
    for a, b in index.pairs(radius):
        a, b = of[a], of[b]
        while len(a):
            a, b = _root(parent, a), _root(parent, b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    root = _root(parent, np.arange(len(values)))
    linked = root != np.arange(len(values))
    return values[linked], values[root[linked]]


def _root(parent: np.ndarray, of: np.ndarray) -> np.ndarray:
    out = parent[of]
    while True:
        up = parent[out]
        if (up == out).all():
            return out
        out = up


def plan_blocks(n: int, radius: int) -> int:
    """Blocks so that a bucket of n random fingerprints holds about 64 at most."""
    blocks = radius + 1
    while blocks < radius + 4 and n / 2.0 ** (64 * (blocks - radius) / blocks) > 64:
        blocks += 1
    return blocks


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v), u > v: a spanning forest of each bin, for distinct fingerprints ``fps`` (fp)."""
    spark = fps.sparkSession
    n = fps.count()
    masks = bucket_masks(plan_blocks(n, radius), radius)
    rows = n * len(masks)
    keyed, parts = _by_masks(fps.select("fp", F.lit(0).alias("t"), F.lit(0).cast("long").alias("key")), [masks]), []
    while True:
        counts = written(keyed.groupBy("key").count().where(F.col("count") > HEAVY).select("key"), "simhash-heavy")
        if not counts.limit(1).count():
            break
        parts.append(keyed.join(counts, "key", "left_anti").select("fp", "key"))
        # each crowded bucket is cut by blocks of the bits that are not equal in it yet; the masks of a level are known here
        heavy, below = keyed.join(counts, "key", "left_semi"), [[mask | m for m in _split(mask, radius)] for mask in masks]
        keyed = written(_by_masks(heavy, below), "simhash-split")
        masks = [m for own in below for m in own]
        rows += keyed.count()
    for part in parts:
        keyed = keyed.select("fp", "key").unionByName(part)
    bins = max(4 * partitions(spark), rows // BIN_ROWS)
    schema = "u long, v long"

    def run(batch):
        codes = batch.column("fp").to_numpy().view(np.uint64)
        u, v = forest(codes, batch.column("key").to_numpy().view(np.uint64), radius)
        u, v = u.view(np.int64), v.view(np.int64)
        return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    return keyed.select("fp", "key", F.pmod("key", F.lit(bins)).alias("bin")).groupBy("bin").applyInArrow(run, schema)


def _by_masks(keyed: DataFrame, masks: list[list[int]]) -> DataFrame:
    """(fp, t, key): each row of ``keyed`` once for each mask that the masks' list number ``t`` holds; t then numbers all masks."""
    table_of, number = [], 0
    for own in masks:
        table_of.append(F.array(*[F.struct(F.lit(number + k).alias("t"), F.lit(_signed(m)).cast("long").alias("m")) for k, m in enumerate(own)]))
        number += len(own)
    cut = keyed.select("fp", "key", F.explode(F.element_at(F.array(*table_of), F.col("t") + 1)).alias("own"))
    return cut.select("fp", F.col("own.t").alias("t"), F.xxhash64("key", "own.t", F.col("fp").bitwiseAND(F.col("own.m"))).alias("key"))


def _split(mask: int, radius: int) -> list[int]:
    """Masks of radius + 1 blocks of the bits outside ``mask``; at least one is equal in fingerprints that link."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(i * len(free) / (radius + 1)) for i in range(radius + 2)]
    return [sum(1 << b for b in free[a:e]) for a, e in zip(cuts, cuts[1:], strict=False)]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for edges (u, v), u > v; alternates large-star and small-star until the edges stay the same.

    Neither step gathers a node's neighbours: a minimum is summed up partly before its shuffle, written, then joined back, so
    that the join may split the edges of a node that very many others link to. The edges' sum falls with each round that
    changes them, so the rounds end.
    """
    edges = written(edges.distinct(), "star-0")
    before = None
    for k in count(1):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if not state[0] or state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"star-large-{k}")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), f"star-edges-{k}")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), f"star-small-{k}")
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct(), f"star-{k}")


def named(nodes: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """(``node``, component_id) for ``nodes`` (``node``, low): the smallest ``low`` that links reach."""
    found = components(links).withColumnRenamed("node", "__node")
    rooted = written(nodes.select(node, "low").join(found, F.col(node) == F.col("__node"), "left").select(node, "low", F.coalesce("root", node).alias("root")), "component-roots")
    smallest = written(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    return rooted.join(smallest, "root").select(node, "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3, n: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``."""
    fps = written(fingerprints(docs, n), "simhash-fps")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    return fps.join(named(nodes, links(nodes.select("fp"), radius), "fp"), "fp").select("doc_id", "fp", "component_id")


def similar(docs: DataFrame, radius: int = 3) -> DataFrame:
    """(doc_id, digest, component_id) for each row of ``docs``: components of near copies, see ``near_copies``.

    The SimHash step: fingerprints of the five-word shingles link at ``radius`` bits (``links``), and the texts of each component of
    fingerprints are a bucket of candidates. MinHash adds the buckets of those pairs that differ in more bits, and each link of
    either kind is checked exactly.
    """
    signed = written(near_copies.signatures(docs, majority), "near-signatures")
    nodes = written(signed.groupBy("node").agg(F.min("doc_id").alias("low"), F.first("keys").alias("keys"), F.first("fp").alias("fp")), "near-nodes")
    own = nodes.where("fp is not null").select("node", "low", "fp")
    found = written(components(links(own.select("fp").distinct(), radius)), "near-fps").withColumnRenamed("node", "__fp")
    grouped = own.join(found, F.col("fp") == F.col("__fp"), "left")
    grouped = grouped.select("node", "low", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"))
    linked = near_copies.links(docs, nodes, grouped)
    return signed.select("doc_id", "digest", "node").join(named(nodes, linked, "node"), "node").select("doc_id", "digest", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component of near copies the document with the smallest doc_id stays, once.

    Links follow five-word shingles at a similarity of 0.8: candidates are what fingerprints at 3 bits link (``similar``), and what
    MinHash finds beyond that radius (``near_copies``). Rows
    without a doc_id stand behind all others under a number made from their text (from UNNAMED on, above any doc_id in use), so
    they meet near copies like any row. Texts that share a doc_id are documents of their own; of equal rows one stays.
    """
    docs = docs.select(*DOCUMENT)
    number = F.lit(UNNAMED) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    docs = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), number), "__digest": F.xxhash64("text")})
    near = written(similar(docs.select(F.col("__id").alias("doc_id"), "text")), "simhash-components")
    repeats = near.groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeats:
        stays = written(near.where("doc_id = component_id").groupBy("component_id").agg(F.min("digest").alias("stays")), "simhash-stays")
        near = near.join(stays, "component_id").withColumn("component_id", F.when(F.col("digest") == F.col("stays"), F.col("component_id")))
    gone = near.where("not doc_id <=> component_id").select(F.col("doc_id").alias("__gone"), F.col("digest").alias("__of")).distinct()
    # only texts that the sieve cannot rule out are shuffled to be looked up
    marked = sifted(docs, "__id", sieve(gone, "__gone"))
    looked_up = marked.where("maybe").join(gone, (F.col("__id") == F.col("__gone")) & (F.col("__digest") == F.col("__of")), "left_anti")
    kept = marked.where("not maybe").unionByName(looked_up)
    return (kept.dropDuplicates(["__id", "__digest"]) if repeats else kept).select(*DOCUMENT)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLE: dict[str, str] = {}
