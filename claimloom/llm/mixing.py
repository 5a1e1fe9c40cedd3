"""Mixing sources to target weights by systematic sampling.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share the sum of all sizes; a target stops at
``most`` times its source's size and the excess is shared again by weight until none is above. That is water-filling: the
target is min(most * size, level * weight), and the level rises with each pass over the sources until no more of them are full.

Sampling: documents of a source stand in one order, the longest first: (floor of the square root of the size, descending, then a
digest of doc_id and text). A document's expected copies are what its source still owes its target over what of the source is still to
come. The expected copies are summed along that order, one offset for each source (from the md5 of its name, so reruns agree) is added,
and a document is emitted once for each integer that its interval crosses. Two bounds keep a source near its target: a document is
taken no oftener than fits into what is owed, and no more seldom than the documents after it, each ``most`` times, could make up for; where
both cannot hold, the nearer of the two. So a source of few documents ends within about one of its smallest documents, whatever the
longest would have drawn; only where two or three documents are a source, or one is most of it, no choice of copies is near.
For documents of at most 1 / LARGE of their source the expected copies no longer change from one to the next by more than that
share allows, so the value after the last longer one holds for all of them, and rows need no pass one by one. Fewer than LARGE rows are
longer, so a source's fold over them is bounded by a parameter.

The running sum needs only each document's rank, found in steps so that no source goes to one task: counts by (source, size
class, first digits of the digest), summed up within the class and over the classes of a source, plus the rank within the cell.
More rows give more digits, which cuts the same order into more cells. Rows equal in doc_id, source and text are counted before
they are shuffled and stand for themselves again in the result. Sources are ranked by a sort over partitions and their level is
found by aggregation, so they may be as many as web hosts; no window is without a key.

Defined cases: null text has size 0; null source is a source, the last; a source of size 0 has target 0 and emits nothing;
null doc_ids are told apart by their texts; repeated rows and ties are each a document; texts of any length are counted whole;
extra columns are kept by ``mix``, whatever their names (of rows equal in doc_id, source and text, one row's), and ignored else;
an empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import DOCUMENT, WORD, table, written
from claimloom.session import spread

#: Rows for each cell of a size class, about, and digest digits that tell cells apart, at least.
ROWS_PER_CELL, LEAST_DIGITS = 20_000, 2
#: Documents of more than 1 / LARGE of their source have expected copies of their own each; fewer than LARGE rows of a source are.
LARGE = 200
#: Offsets are multiples of 1 / STEPS, so that they stay exact beside large ranks.
STEPS = 1024


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, their number from 0 in code point order: places within sorted partitions plus what stands ahead."""
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(sources.orderBy(F.col("src").asc_nulls_last()).withColumns({"part": F.spark_partition_id(), "own": own}), "mix-places")
    counts = {r.part: r.n for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row for each shuffle partition
    ahead, total = [], 0
    for part in range(max(counts, default=0) + 1):
        ahead.append(total)
        total += counts.get(part, 0)
    return placed.withColumn("place", F.element_at(F.array(*[F.lit(n).cast("long") for n in ahead]), F.col("part") + 1) + F.col("own")).drop("part", "own")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(src, source_size, source_rows, target) for each source of ``sizes`` (src, size, and optionally n, the rows it stands for)."""
    n = F.col("n") if "n" in sizes.columns else F.lit(1)
    totals = sizes.groupBy("src").agg(F.sum(F.col("size") * n).alias("source_size"), F.sum(n).cast("long").alias("source_rows"))
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("place") % len(cycle) + 1).cast("int")).cast("double")
    weighed = written(_ranked(totals).select("src", "source_size", "source_rows", weight.alias("weight")), "mix-sources")
    level, held = 0.0, None
    while True:
        full = (F.col("source_size") * most <= level * F.col("weight")) if held else F.lit(False)
        r = weighed.agg(F.sum("source_size"), F.sum("weight"), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(full, F.col("weight")))).first()
        now = (r[2] or 0, r[3] or 0.0)
        if not r[0] or now == held:
            break
        held, level = now, (r[0] - most * now[0]) / (r[1] - now[1])
    target = F.least((F.col("source_size") * most).cast("double"), F.lit(level) * F.col("weight"))
    return weighed.select("src", "source_size", "source_rows", target.alias("target"))


def _crossed(start: Column, rank: Column, share: Column, most: int) -> Column:
    """Integers between the sums of expected copies before and after the document at ``rank`` (from 1)."""
    rank = rank.cast("double")
    return F.least((F.floor(start + rank * share) - F.floor(start + (rank - 1) * share)).cast("long"), F.lit(most).cast("long"))


def _drawn(most: int) -> Column:
    """(left, taken, sum, copies) after the long documents ``rows`` of a source, one after the other."""
    most = F.lit(float(most))

    def one(at: Column, row: Column) -> Column:
        size = row["size"].cast("double")
        owed, left = F.col("target") - at["taken"], at["left"] - size
        fits = F.floor(owed / size).cast("double")
        over, under = size * (fits + 1) - owed, owed - most * left - size * fits
        needed = F.when(under > over, fits + 1).otherwise(F.least(fits, F.ceil((owed - most * left) / size).cast("double")))
        total = at["sum"] + F.least(most, F.greatest(F.lit(0.0), owed / at["left"]))
        crossed = F.floor(total).cast("double")
        copies = F.least(most, F.greatest(F.lit(0.0), needed, F.least(crossed, F.greatest(fits, needed))))
        return F.struct(left.alias("left"), (at["taken"] + copies * size).alias("taken"), (total - crossed).alias("sum"), F.concat(at["copies"], F.array(copies.cast("long"))).alias("copies"))

    none = F.array().cast("array<bigint>")
    empty = F.struct(F.col("source_size").cast("double").alias("left"), F.lit(0.0).alias("taken"), F.col("start").alias("sum"), none.alias("copies"))
    return F.aggregate("rows", empty, one)


def _key(source: str) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def _digest() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def with_copies(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(doc_id, key, digest, size, source_size, target, copies), one row for each row of ``docs`` (doc_id, text, source).

    ``key`` is the source, marked so that it is never null; ``digest`` the md5 of the text.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size")
    narrow = docs.select("doc_id", F.col("source").alias("src"), size, _digest().alias("digest"))
    sizes = written(narrow.groupBy("doc_id", "src", "digest", "size").agg(F.count("*").alias("n")), "mix-sizes")
    targets = written(source_targets(sizes, cycle, most), "mix-targets")
    n_rows = targets.agg(F.coalesce(F.sum("source_rows"), F.lit(0))).first()[0]
    digits = max(LEAST_DIGITS, ceil(log(max(1, n_rows) / ROWS_PER_CELL, 16)) if n_rows > ROWS_PER_CELL else 0)
    start = F.conv(F.substring(F.md5(F.coalesce(F.col("src"), F.lit(""))), 1, 6), 16, 10).cast("long") % STEPS / F.lit(float(STEPS))
    t = targets.select(_key("src").alias("key"), "source_size", "target", start.alias("start"))
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.col("digest")))
    sized = sizes.withColumns({"key": _key("src"), "order": order}).drop("src").join(t, "key")
    columns = ["doc_id", "key", "digest", "size", "source_size", "target", "copies"]
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("repeat")
    is_large = F.col("size") * LARGE > F.col("source_size")

    row = F.struct((-F.floor(F.sqrt(F.col("size").cast("double")))).alias("band"), "order", "repeat", "doc_id", "digest", "size")
    longest_first = F.array_sort(F.collect_list(row)).alias("rows")  # fewer than LARGE, by the condition
    large = sized.where(is_large).select("*", every).groupBy("key", "source_size", "target", "start").agg(longest_first)
    large = written(large.withColumn("drawn", _drawn(most)), "mix-large")
    met = large.select("key", F.col("drawn.left").alias("left"), F.col("drawn.taken").alias("taken"), F.col("drawn.sum").alias("sum"))
    large = large.select("key", "source_size", "target", F.explode(F.arrays_zip("rows", F.col("drawn.copies").alias("copies"))).alias("r")).select("*", "r.rows.*", "r.copies").select(*columns)
    left = F.coalesce("left", F.col("source_size").cast("double"))
    rate = F.when(left > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(most)), (F.col("target") - F.coalesce("taken", F.lit(0.0))) / left))).otherwise(F.lit(0.0))
    rates = t.join(met, "key", "left").select("key", rate.alias("rate"), F.coalesce("sum", "start").alias("after"))

    cell = {"bin": F.floor(F.sqrt(F.col("size").cast("double"))).cast("long"), "part": F.substring("order", 1, digits)}
    rest = sized.where(~is_large).withColumns(cell)
    cells = written(rest.groupBy("key", "bin", "part").agg(F.sum("n").alias("rows")), "mix-cells")
    before = lambda by, order: F.coalesce(F.sum("rows").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = cells.groupBy("key", "bin").agg(F.sum("rows").alias("rows")).select("key", "bin", before(["key"], F.desc("bin")).alias("bins_ahead"))
    ahead = cells.withColumn("parts_ahead", before(["key", "bin"], F.asc("part"))).join(bins, ["key", "bin"]).join(rates, "key")
    ahead = written(ahead.select("key", "bin", "part", (F.col("bins_ahead") + F.col("parts_ahead")).alias("ahead"), "rate", "after"), "mix-ahead")
    within = Window.partitionBy("key", "bin", "part").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rest.withColumn("within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(ahead, ["key", "bin", "part"]).select("*", every)
    drawn = ranked.withColumn("copies", _crossed(F.col("after"), F.col("ahead") + F.col("within") + F.col("repeat"), F.col("rate"), most))
    return drawn.select(*columns).unionByName(large)


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = with_copies(docs.select("doc_id", "text", "source"), cycle, most).where("copies > 0")
    taken = taken.groupBy("doc_id", "key", "digest").agg(F.sum("copies").alias("copies"))
    whole = docs.select(F.col("doc_id").alias("id"), _key("source").alias("key"), _digest().alias("digest"), F.struct(*docs.columns).alias("row"))
    whole = whole.dropDuplicates(["id", "key", "digest"]) if _repeats(docs) else whole
    out = whole.join(taken.withColumnsRenamed({"key": "key_", "digest": "digest_"}), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("key_")) & (F.col("digest") == F.col("digest_")))
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _repeats(docs: DataFrame) -> bool:
    """Whether a doc_id occurs twice; then copies are counted for the repeated rows together."""
    return bool(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents repeated or left out so that sources come near their targets."""
    return mix(docs.select(*DOCUMENT))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return with_copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def oracle(docs: str = "documents") -> str:
    return f"""
with recursive sizes as (select doc_id, source as src, md5(coalesce(text, '')) as digest,
                      len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from {docs}),
totals as (select src, sum(size)::bigint as source_size, count(*) as source_rows from sizes group by src),
placed as (select *, row_number() over (order by src nulls last) - 1 as place from totals),
weighed as (select *, (place % 3 + 1)::double as weight from placed),
leveled as (select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over up, 0))
                      / (sum(weight) over () - coalesce(sum(weight) over up, 0)) as own_level
            from weighed window up as (order by source_size / weight, place rows between unbounded preceding and 1 preceding)),
marked as (select *, 3 * source_size <= own_level * weight as is_full from leveled),
targets as (select src, source_size, case when is_full then (3 * source_size)::double
                   else max(case when not is_full then own_level end) over () * weight end as target from marked),
sized as (select s.*, t.source_size, t.target, size * {LARGE} > t.source_size as is_large,
                 (('0x' || substr(md5(coalesce(s.src, '')), 1, 6))::bigint % {STEPS}) / {STEPS}.0::double as start,
                 row_number() over (partition by s.src order by size * {LARGE} > t.source_size desc, floor(sqrt(size::double)) desc,
                                    md5(coalesce(doc_id::varchar, '') || '|' || digest))::double as place
          from sizes s join targets t on s.src is not distinct from t.src),
large as (select * from sized where is_large),
fold as (select distinct src, source_size, target, 0::bigint as step, source_size::double as remaining, 0.0::double as taken, start as total, 0::bigint as copies from large
         union all
         select src, source_size, target, step, remaining, taken + copies * size, total - crossed, copies::bigint from (
           select *, least(3.0::double, greatest(0.0::double, needed, least(crossed, greatest(fits, needed)))) as copies from (
             select *, case when owed - 3 * remaining - size * fits > size * (fits + 1) - owed then fits + 1 else least(fits, ceil((owed - 3 * remaining) / size)) end as needed, floor(total) as crossed from (
               select f.src, f.source_size, f.target, f.step + 1 as step, f.remaining - l.size as remaining, f.taken, l.size::double as size, f.target - f.taken as owed, floor((f.target - f.taken) / l.size) as fits,
                      f.total + least(3.0::double, greatest(0.0::double, (f.target - f.taken) / f.remaining)) as total
               from fold f join large l on l.src is not distinct from f.src and l.place = f.step + 1)))),
met as (select src, max(step) as large_rows, arg_max(remaining, step) as remaining, arg_max(taken, step) as large_taken, arg_max(total, step) as total from fold group by src),
rates as (select s.*, coalesce(large_rows, 0) as before, case when coalesce(remaining, source_size::double) > 0 then
                 greatest(0.0::double, least(3.0::double, (target - coalesce(large_taken, 0.0::double)) / coalesce(remaining, source_size::double))) else 0.0::double end as rate, coalesce(total, start) as after
          from sized s left join met m on s.src is not distinct from m.src where not is_large),
drawn as (select doc_id, size, source_size, target,
                 least(floor(after + (place - before) * rate) - floor(after + (place - before - 1) * rate), 3) as copies from rates
          union all select l.doc_id, l.size, l.source_size, l.target, f.copies from large l join fold f on l.src is not distinct from f.src and l.place = f.step)
select doc_id, size, source_size, target, (size * copies)::bigint as taken from drawn"""


QUERIES = {"op10_mixing": op10_mixing}
ORACLE = {"op10_mixing": oracle()}
