"""Source divergence audit: how far the vocabularies of a language's sources stand apart.

Terms are runs of ASCII letters and of bytes from 0x80 on, A-Z lower-cased. Each language keeps the terms that at least ``MIN_DOCS`` of
its documents hold; every (lang, source) group gives each kept term a smoothed share p in whole billionths. The result has, for each
group, all other sources of its language by the sum of absolute differences of p (part ``pair``), and the terms that it uses more
than its language does (part ``term``, ``TOP_TERMS`` of them).

Plan: texts are tokenized in Arrow batches. A lookup table over the batch's UTF-8 buffer marks the bytes of terms, so boundaries
are found without decoding; XXH3 groups the slices and every slice is compared byte by byte with its group's first, those that differ
are grouped by their bytes. What leaves a task is one row for each (lang, source, term) of the texts it has read so far, so only counts
are shuffled, summed before and after. Kept terms of a language are then dealt to blocks by a hash, as many as its counts need:
a block is a CSR matrix (sources by terms) in which the sums over stored counts are one ``reduceat``, and what is not stored (a count of
zero has a share, too) is added from sorted shares and their prefix sums. Blocks are added up by Spark, and the best terms of
each block are ranked again over all blocks. A language that has a third of all rows has a third of the blocks.

Arithmetic is exact: shares are found by long division in 64 bits, which holds for groups of up to 9e15 terms (more raise an error).

Defined cases: null text, lang and source are ''; a group without any term still has its rows in part ``pair``; a language without
kept terms has distances of 0; a single source has no pairs; each row is a document of its own, repeated or not, whatever its doc_id;
ties rank by the item's bytes; texts of any length are read whole, in windows that end between terms; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_batches, table, written
from claimloom.session import spread

MIN_DOCS, TOP_TERMS = 30, 50
SCALE_STEPS, STEP, SMOOTH = 3, 1000, 5
#: Bytes of text that are tokenized at a time, and different terms that a task holds before it hands its counts on.
WINDOW, HELD_TERMS = 2 << 20, 200_000
#: Counts of a block, about.
BLOCK = 200_000
#: The largest divisor for which a long division by steps of STEP stays within 64 bits.
LARGEST = (1 << 63) // STEP - 1
#: Each byte's lower-cased form, or 0 for one that stands between terms.
TERM_BYTE = np.zeros(256, np.uint8)
TERM_BYTE[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
TERM_BYTE[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
TERM_BYTE[0x80:] = np.arange(0x80, 0x100)

COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = "lang string, source string, part string, item string, value long"


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 * (count + 5) / total), by long division; ``total`` is N + 5 V."""
    total = np.asarray(total, np.int64)
    if total.size and total.max() > LARGEST:
        raise OverflowError("a group of more terms than 64 bits can divide")
    rest, out = np.asarray(count, np.int64) + SMOOTH, 0
    for _ in range(SCALE_STEPS):
        digit, rest = np.divmod(rest * STEP, total)
        out = out * STEP + digit
    return out + 1


def slices(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in lower-cased ``data``; ``breaks`` are places where a text starts."""
    inside = data != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    breaks = breaks[breaks < len(data)]
    first[breaks] = inside[breaks]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def grouped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest=xxhash.xxh3_64_intdigest) -> tuple[np.ndarray, list[bytes]]:
    """The number of each slice's term, and the terms: by hash first, then every slice by its bytes."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    raw = data.tobytes()
    hashes = np.fromiter((digest(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    _, found, number = np.unique(hashes, return_index=True, return_inverse=True)
    sizes, example = ends - starts, found[number]
    base = np.cumsum(sizes) - sizes
    within = np.arange(sizes.sum()) - np.repeat(base, sizes)
    other = np.minimum(np.repeat(starts[example], sizes) + within, len(data) - 1)
    same = np.minimum.reduceat(data[np.repeat(starts, sizes) + within] == data[other], base) & (sizes == sizes[example])
    terms = [raw[s:e] for s, e in zip(starts[found].tolist(), ends[found].tolist(), strict=True)]
    extra: dict[bytes, int] = {}
    for at in np.flatnonzero(~same).tolist():
        term = raw[starts[at] : ends[at]]
        if term not in extra:
            extra[term] = len(terms)
            terms.append(term)
        number[at] = extra[term]
    return number, terms


class Counter:
    """Counts of (group, term) over the texts of one task, and the documents that hold them."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.cells: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, langs: list[str], sources: list[str], texts: pa.Array) -> None:
        groups = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)], np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets, at, rows = offsets - offsets[0], 0, []
        while at < len(data):
            lower = TERM_BYTE[data[at : (until := self._end(data, offsets, at))]]
            starts, ends = slices(lower, offsets[(offsets >= at) & (offsets < until)] - at)
            number, terms = grouped(lower, starts, ends)
            own = np.array([self.terms.setdefault(t, len(self.terms)) for t in terms], np.int64)
            doc = np.searchsorted(offsets, starts + at, side="right") - 1
            rows.append((doc, own[number] if len(number) else number))
            at = until
        if rows:
            # the documents' CSR matrix: one entry for each term of a document
            width = max(1, len(self.terms))
            keys, n = np.unique(np.concatenate([d * width + t for d, t in rows]), return_counts=True)
            self._sum(groups[keys // width], keys % width, n, np.ones_like(n))

    def _end(self, data: np.ndarray, offsets: np.ndarray, at: int) -> int:
        """Where a window from ``at`` ends: at the end of a text or behind a byte that is in no term."""
        until = min(at + WINDOW, len(data))
        while until < len(data):
            part = data[max(at, until - WINDOW) : until]
            between = np.flatnonzero(TERM_BYTE[part] == 0)
            if len(between):
                return until - len(part) + int(between[-1]) + 1
            text_end = offsets[np.searchsorted(offsets, at, side="right")]
            if text_end <= until:
                return int(text_end)
            until = min(until + WINDOW, len(data))
        return until

    def _sum(self, group: np.ndarray, term: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        order = np.lexsort((term, group))
        group, term, n, docs = group[order], term[order], n[order], docs[order]
        heads = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (term[1:] != term[:-1])]) if len(group) else np.zeros(0, np.int64)
        if len(heads):
            self.cells.append((group[heads], term[heads], np.add.reduceat(n, heads), np.add.reduceat(docs, heads)))

    def rows(self) -> pa.RecordBatch:
        """Everything counted, and a row without a term for each group that occurred."""
        cells = self.cells
        self.cells = []
        if cells:
            self._sum(*map(np.concatenate, zip(*cells, strict=True)))
        group, term, n, docs = self.cells[0] if self.cells else [np.zeros(0, np.int64)] * 4
        names, terms = list(self.groups), pa.array(list(self.terms), pa.binary()).cast(pa.string())
        at = np.concatenate([group, np.arange(len(names))])
        none = np.zeros(len(names), np.int64)
        named = [pa.array([g[k] for g in names], pa.string()).take(pa.array(at)) for k in (0, 1)]
        words = pa.concat_arrays([terms.take(pa.array(term)), pa.nulls(len(names), pa.string())])
        return pa.RecordBatch.from_arrays([*named, words, pa.array(np.concatenate([n, none])), pa.array(np.concatenate([docs, none]))], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and documents that hold it; a null term marks a group."""
    arrow_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            counter.add(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.string()))
            if len(counter.terms) >= HELD_TERMS:
                yield counter.rows()
                counter.clear()
        yield counter.rows()

    read = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return read.mapInArrow(count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def block_parts(cells: pa.Table, groups: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """Distances of all pairs of a language's sources over one block of its terms, and each source's best terms there."""
    lang, sources = groups.column("lang")[0].as_py(), groups.column("source").to_pylist()
    column = lambda t, c: t.column(c).to_numpy()
    kept, divisor = int(column(groups, "kept")[0]), SMOOTH * int(column(groups, "kept")[0])
    place = {s: k for k, s in enumerate(sources)}
    row = np.array([place[s] for s in cells.column("source").to_pylist()], np.int64)
    order = np.argsort(row, kind="stable")
    row = row[order]
    words = cells.column("term").combine_chunks().dictionary_encode() if cells.num_rows else pa.array([], pa.string()).dictionary_encode()
    col, terms = words.indices.to_numpy()[order], words.dictionary
    totals = column(groups, "n_group") + divisor
    p = share(column(cells, "n")[order], totals[row]) if len(row) else np.zeros(0, np.int64)
    q = share(column(cells, "n_term")[order], int(column(groups, "n_lang")[0]) + divisor) if len(row) else p
    none = share(np.zeros(len(sources), np.int64), totals) if kept else np.zeros(len(sources), np.int64)
    # CSR: the entries of source k are indptr[k] to indptr[k + 1]
    indptr = np.searchsorted(row, np.arange(len(sources) + 1))
    full = np.flatnonzero(np.diff(indptr))
    out: list[tuple[str, str, str, int]] = []
    dense = np.zeros(len(terms), np.int64)
    for a, source in enumerate(sources):
        own = slice(indptr[a], indptr[a + 1])
        dense[:] = none[a]
        dense[col[own]] = p[own]
        # where b has no count its share is none[b]: over a's entries by sorted shares, over the others all alike
        ordered = np.sort(p[own])
        sums = np.r_[0, np.cumsum(ordered)]
        below = np.searchsorted(ordered, none)
        value = none * (2 * below - len(ordered)) + sums[-1] - 2 * sums[below] + np.abs(none - none[a]) * (len(terms) - len(ordered))
        if len(full):
            value[full] += np.add.reduceat(np.abs(p - dense[col]) - np.abs(none[row] - dense[col]), indptr[full])
        out.extend((source, "pair", other, int(value[b])) for b, other in enumerate(sources) if b != a)
        over = np.flatnonzero(p[own] > q[own]) + indptr[a]
        names = terms.take(pa.array(col[over])).to_pylist()
        best = sorted(zip((q[over] - p[over]).tolist(), (n.encode() for n in names), names, strict=True))[:top]
        out.extend((source, "term", name, -less) for less, _, name in best)
    texts = [pa.array([r[k] for r in out], pa.string()) for k in range(3)]
    return pa.table([pa.array([lang] * len(out), pa.string()), *texts, pa.array([r[3] for r in out], pa.int64())], ["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of ``docs``."""
    counts = written(term_counts(docs), "divergence-counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_term")).where(F.col("docs") >= min_docs)
    kept = written(kept.drop("docs"), "divergence-kept")
    held = written(counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "divergence-held")
    of_lang = counts.select("lang").distinct().join(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_term").alias("n_lang")), "lang", "left")
    of_lang = of_lang.join(held.groupBy("lang").agg(F.ceil(F.count("*") / block).alias("blocks")), "lang", "left").fillna({"kept": 0, "n_lang": 0, "blocks": 1})
    of_lang = written(of_lang, "divergence-langs")
    groups = counts.where("term is null").select("lang", "source").join(held.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left").fillna({"n_group": 0})
    groups = groups.join(of_lang, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    cells = held.join(of_lang.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).drop("blocks")
    parts = cells.groupBy("lang", "block").cogroup(groups.groupBy("lang", "block")).applyInArrow(lambda a, b: block_parts(a, b, top), PARTS)
    parts = written(parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "divergence-parts")
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spread(table(spark, sf_dir, "documents").select("text", "lang", "source")))


QUERIES = {"op11_divergence": op11_divergence}
ORACLE = {
    "op11_divergence": r"""
with d as (select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
t as (select k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from t group by all having count(distinct k) >= 30),
l as (select lang, count(*) as v, sum(n) as n from kept group by lang),
g as (select distinct lang, source from d),
held as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by all),
sums as (select lang, source, sum(n) as n from held group by all),
p as (select g.lang, g.source, kept.term, coalesce(held.n, 0) as n, (1 + (1000000000::hugeint * (coalesce(held.n, 0) + 5)) // (coalesce(sums.n, 0) + 5 * l.v))::bigint as p,
    (1 + (1000000000::hugeint * (kept.n + 5)) // (l.n + 5 * l.v))::bigint as q
  from g join kept using (lang) join l using (lang) left join held on held.lang = g.lang and held.source = g.source and held.term = kept.term left join sums on sums.lang = g.lang and sums.source = g.source),
pairs as (select a.lang, a.source, b.source as item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
terms as (select lang, source, term as item, p - q as value from p where n > 0 and p > q),
ranked as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from terms)
select lang, source, part, item, value, rank::integer as rank from ranked where part = 'pair' or rank <= 50"""
}
