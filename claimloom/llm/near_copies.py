"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

A 64-bit SimHash alone cannot serve here: at 0.8 about 10 of 64 bits differ on average, and at such a radius masked blocks are so narrow
that each bucket holds a fixed share of all texts. So SimHash gives the candidates within 3 bits (``simhash.similar``), MinHash those
beyond, and each link is checked exactly.

Texts with the same words (A-Z lower-cased) become one node first, named by 64 bits of XXH64. A node's ``BANDS`` keys each hash
``ROWS`` minima of its shingles' XXH64; two texts of similarity s share a key with probability 1 - (1 - s^4)^20, which is 0.99997
at 0.8. Only keys of two nodes or more go on, and of keys with the same nodes one. The texts that have such keys are read again
(a sieve of bounded size holds most others back before they are shuffled), and a bin gets the shingle sets of its buckets, counts
what each member shares with all others through the shingles' postings, and returns a spanning forest of the exact links, not
pairs.

Buckets of more than ``CHUNK`` nodes are dealt to chunks, and about ``PIVOTS`` of their nodes, the pivots, are in every chunk. A
hot group of near copies thus hangs together by its pivots, and no chunk has to see another. What a chunk does not link to the
main group of pivots is compared with all chunks in a second round, so every pair of a bucket is either checked or already joined.

Defined cases: null or empty text, or text of blanks, is one node without keys; a text of fewer than five words is one shingle;
repeated rows and ties are one node; texts of any length are read whole; rows need a doc_id, which the caller makes up where it is
null, since texts are read again by it; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import arrow_batches, partitions, sieve, sifted, written

WORDS, BANDS, ROWS = 5, 20, 4
#: Similarity from which texts are linked, as a fraction.
LEAST = (4, 5)
#: Nodes of a bucket that meet in one task, about, and pivots of a larger bucket, on average.
CHUNK, PIVOTS = 512, 32
#: Shingle sets for each bin.
BIN_ROWS = 256
#: What a node is in: a chunk of a bucket, or in the second round a chunk beside a block of late nodes.
UNIT = "struct<key:bigint,chunk:int,block:int,split:boolean,pivot:boolean>"
_RNG = np.random.default_rng(20)
_MULTIPLY = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def node(own: list[bytes]) -> int:
    """Name of the texts with these words, as a signed number."""
    value = xxhash.xxh64_intdigest(b" ".join(own), 42)
    return value - (1 << 64) if value >= 1 << 63 else value


def shingles(own: list[bytes]) -> np.ndarray:
    """Distinct XXH64 of the shingles, sorted."""
    if not own:
        return np.zeros(0, dtype=np.uint64)
    parts = map(b" ".join, zip(*(own[i:] for i in range(WORDS)), strict=False)) if len(own) > WORDS else [b" ".join(own)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in parts), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key for each band, as unsigned numbers; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[at : at + 512, None] * _MULTIPLY + _ADD).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))]


def signatures(docs: DataFrame, fingerprint: Callable[[np.ndarray], int]) -> DataFrame:
    """(doc_id, digest, node, keys, fp) for each row; ``digest`` tells texts under one doc_id apart, ``fp`` is the shingles' fingerprint
    as a signed number, null without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [words(text) for text in batch.column("text").to_pylist()]
            keys, fps = [], []
            for w in own:
                hashes = shingles(w)
                keys.append(np.array(band_keys(hashes), dtype=np.uint64).view(np.int64))
                fps.append(int(np.uint64(fingerprint(hashes)).view(np.int64)) if len(hashes) else None)
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array([node(w) for w in own], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "node", "keys", "fp"])

    arrow_batches(docs.sparkSession)
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("digest", T.LongType()), T.StructField("node", T.LongType())]
    schema = T.StructType([*fields, T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


def forest(nodes: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest linked node) for the nodes of a bin that are not the smallest of their component."""
    values, root = _components(nodes, keys, sets)
    linked = root != np.arange(len(values))
    return values[linked], values[root[linked]]


def _components(nodes: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, places of their roots): what the buckets ``keys`` of a bin link."""
    values, first, of = np.unique(nodes, return_index=True, return_inverse=True)
    parent = np.arange(len(values))
    order = np.argsort(keys, kind="stable")
    for members in np.split(of[order], np.flatnonzero(np.diff(keys[order])) + 1):
        members = np.unique(members)
        if len(members) > 1 and len(np.unique(_roots(parent, members))) > 1:
            _link(parent, members, [sets[first[m]] for m in members])
    return values, _roots(parent, np.arange(len(values)))


def _main(pivots: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The largest group that the pivots alone form; the same in every chunk of a bucket."""
    values, root = _components(pivots, np.zeros(len(pivots), dtype=np.int64), sets)
    sizes = np.bincount(root, minlength=len(values))
    return values[root == sizes.argmax()]


def _link(parent: np.ndarray, members: np.ndarray, sets: list[np.ndarray]) -> None:
    """Join the members of one bucket whose sets are similar enough."""
    n = len(members)
    sizes = np.array([len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    token, owner = token[count[token] > 1], owner[count[token] > 1]
    places = np.argsort(token, kind="stable")
    posted = owner[places]
    start = np.searchsorted(token[places], np.arange(len(count) + 1))
    ends = np.searchsorted(owner, np.arange(n + 1))
    up, down = LEAST
    for k in range(n - 1):
        if len(np.unique(_roots(parent, members[k:]))) == 1:
            return  # all that is left hangs together
        own = token[ends[k] : ends[k + 1]]
        width = start[own + 1] - start[own]
        hit = np.repeat(start[own] - np.cumsum(width) + width, width) + np.arange(width.sum())
        shared = np.bincount(posted[hit], minlength=n)[k + 1 :]
        near = np.flatnonzero(down * shared >= up * (sizes[k] + sizes[k + 1 :] - shared)) + k + 1
        if len(near):
            roots = _roots(parent, members[np.r_[k, near]])
            parent[roots] = roots.min()


def _roots(parent: np.ndarray, of: np.ndarray) -> np.ndarray:
    out = parent[of]
    while (parent[out] != out).any():
        out = parent[out]
    return out


def links(docs: DataFrame, nodes: DataFrame, grouped: DataFrame) -> DataFrame:
    """(u, v), u > v: a spanning forest of each bin. ``nodes`` has (node, low, keys), ``grouped`` (node, low, key) of further buckets; a
    node's text is read from row ``low`` of ``docs``."""
    keyed = nodes.select("node", "low", F.explode("keys").alias("key")).unionByName(written(grouped, "near-grouped"))
    members = F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))
    counts = keyed.groupBy("key").agg(F.count("*").alias("count"), members[0].alias("a"), members[1].alias("b")).where("count > 1")
    counts = counts.groupBy("count", "a", "b").agg(F.min("key").alias("key"))  # the same members need one check
    chunks = F.ceil(F.col("count") / CHUNK).cast("int")
    counts = written(counts.select("key", "count", F.when(F.col("count") > CHUNK, chunks).otherwise(1).alias("chunks")), "near-counts")
    shared = keyed.join(counts, "key").select("node", "low", "key", "count", "chunks", F.pmod(F.xxhash64("node", "key"), "chunks").cast("int").alias("own"))
    shared = written(shared, "near-shared")
    is_pivot = (F.col("chunks") > 1) & (F.pmod(F.xxhash64(F.lit("pivot"), "node"), "count") < PIVOTS)
    there = F.when(is_pivot, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))
    unit = lambda block, split, pivot: F.struct(F.col("key"), F.col("chunk"), block.alias("block"), split.alias("split"), pivot.alias("pivot")).alias("unit")
    no = F.lit(False)
    first = shared.select("node", "low", "key", F.explode(there).alias("chunk"), (F.col("chunks") > 1).alias("split"), is_pivot.alias("pivot"))
    first = first.select("node", "low", unit(F.lit(0), F.col("split"), F.col("pivot")))
    found = written(_checked(docs, first), "near-links")
    edges = found.where("v is not null").select("u", "v")
    late = found.where("v is null").select(F.col("u").alias("node"), "key").distinct()
    if not late.limit(1).count():
        return edges
    # nodes that their chunk did not link to the main pivots meet all chunks of their bucket, in blocks
    blocks = written(late.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("blocks")), "near-blocks")
    crowded = shared.join(blocks, "key")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    whole = crowded.select("node", "low", "key", F.col("own").alias("chunk"), every("blocks").alias("block"))
    block = F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int").alias("block")
    again = crowded.join(late, ["key", "node"]).select("node", "low", "key", every("chunks").alias("chunk"), block)
    pairs = whole.unionByName(again).select("node", "low", unit(F.col("block"), no, no)).distinct()
    return edges.unionByName(_checked(docs, pairs).select("u", "v"))


def _checked(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(u, v, key): links u > v of the units' members; v is null where node u of bucket ``key`` is not linked to its main pivots.

    ``units``: (node, low, unit), one row for each unit that a node is in.
    """
    spark = docs.sparkSession
    wanted = written(units.groupBy("node", "low").agg(F.collect_list("unit").alias("units"), F.count("*").alias("n")), "near-wanted")
    bins = max(4 * partitions(spark), (wanted.agg(F.sum("n")).first()[0] or 0) // BIN_ROWS)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, name, units in zip(batch.column("text").to_pylist(), batch.column("node").to_pylist(), batch.column("units"), strict=True):
                own = words(text)
                if node(own) == name:  # another text under the same doc_id else
                    n, data = len(units.values), shingles(own).tobytes()
                    for at in range(0, n, 64):  # a pivot's set goes to many chunks
                        part = units.values.slice(at, 64)
                        yield pa.RecordBatch.from_arrays([part, pa.array([name] * len(part), pa.int64()), pa.array([data] * len(part), pa.binary())], ["unit", "node", "shingles"])

    def run(batch: pa.Table) -> pa.Table:
        own = [np.frombuffer(s, dtype=np.uint64) for s in batch.column("shingles").to_pylist()]
        nodes = batch.column("node").to_numpy()
        units = batch.column("unit").to_pylist()
        place: dict[tuple, int] = {}
        of = np.array([place.setdefault((u["key"], u["chunk"], u["block"]), len(place)) for u in units], dtype=np.int64)
        values, root = _components(nodes, of, own)
        linked = root != np.arange(len(values))
        u, v = values[linked], values[root[linked]]
        apart: list[tuple[int, int]] = []
        split, pivot = (np.array([x[name] for x in units], dtype=bool) for name in ("split", "pivot"))
        for k in np.unique(of[split]):
            at = np.flatnonzero(pivot & (of == k))
            main = _main(nodes[at], [own[i] for i in at]) if len(at) else nodes[:0]
            joined = set(root[np.searchsorted(values, main)].tolist())
            apart += [(int(nodes[i]), units[i]["key"]) for i in np.flatnonzero(of == k) if root[np.searchsorted(values, nodes[i])] not in joined]
        none = [None] * len(apart)
        return pa.table(
            {
                "u": pa.concat_arrays([pa.array(np.maximum(u, v), pa.int64()), pa.array([a for a, _ in apart], pa.int64())]),
                "v": pa.concat_arrays([pa.array(np.minimum(u, v), pa.int64()), pa.array(none, pa.int64())]),
                "key": pa.concat_arrays([pa.nulls(len(u), pa.int64()), pa.array([k for _, k in apart], pa.int64())]),
            }
        )

    likely = sifted(docs.select("doc_id", "text"), "doc_id", sieve(wanted, "low")).where("maybe").drop("maybe")
    read = likely.join(wanted.withColumnRenamed("low", "doc_id"), "doc_id").select("text", "node", "units")
    found = read.mapInArrow(sets, f"unit {UNIT}, node long, shingles binary")
    return found.withColumn("bin", F.pmod(F.xxhash64("unit.key", "unit.chunk", "unit.block"), F.lit(bins))).groupBy("bin").applyInArrow(run, "u long, v long, key long")
