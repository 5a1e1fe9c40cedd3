"""Personal data and secrets: base formats, and further spans by candidate gradient boosting.

Base formats (email, ip, card, phone) are leftmost matches that do not overlap within their kind; matches that fail their check
(octets, Luhn, number of digits) are dropped. Beyond them, generators of high recall propose spans that may overlap: addresses
whose at sign is spelled out, numbers in groups without a plus, card numbers with other separators, IPv6, IBANs, and secrets
(values that follow an equals sign or colon, and long runs that mix letters and digits). Boosted trees score a candidate by
format (digits, letters, capitals, groups, separators, lengths) and context (the characters around it, words before it).

What they learn from: base spans are positives; base matches that fail their check, and numbers that belong to a base span of
another kind, are negatives. A proposed secret is a positive if a word such as password or token announces it or an issuer's
prefix begins it, else a negative. SAMPLE candidates of each kind, chosen by hash, are learned from at most, from one half of the
documents; the other half calibrates each kind's threshold by one aggregation over all its candidates: the lowest score from which
on a share of PRECISION (with half a candidate against it) of the known candidates that hold their check are positive. Proposed
spans that touch a base span, or fail their check, are never added.

All of it is DataFrame and SQL functions over arrays of the row. Each pattern goes over a text once: matches are marked, the
marked text is split, and offsets are sums of the parts' lengths, taken in two levels; whether a candidate touches base spans is a
binary search in their sorted starts. So texts with very many matches stay near linear. Patterns have no bound on the lengths of what they
propose but those of the formats themselves (IPv6, IBAN, groups of digits). Only found candidates are written, not texts.

Defined cases: null text is empty and has no spans; texts of any length are searched whole; repeated rows, and rows with the same or
no doc_id, are each searched and redacted in their own right; equal candidates of two generators are one span; where a kind has
too few known candidates (ten, if all are positive) the method adds none of it; extra columns are ignored by ``spans`` and kept
by ``redact``, which replaces one named ``redacted``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import boosting
from claimloom.llm.common import table, written
from claimloom.session import spread

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
#: Candidates of each kind to learn from, at most; share of positives above a threshold.
SAMPLE, PRECISION = 4_000, 0.95
#: Base formats. Runs are matched from their start on and never given back: the same matches as without that, in linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts that do not hold these have no match.
NEEDS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_AT, _DOT = r"\x20?[(\[{]\x20?(?:at|AT|@)\x20?[)\]}]\x20?", r"\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?"
#: Generators of further candidates: (kind, pattern, what a text must hold).
MORE = [
    ("email", rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)+", r"[(\[{]\x20?(?:at|AT|@)"),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", "[0-9A-Fa-f]:[0-9A-Fa-f]"),
    ("card", r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./_])", "[0-9]{4}[./_][0-9]{4}"),
    ("phone", r"(?<![0-9A-Za-z+./_-])(?:\([0-9]{2,5}\)\x20?|00[0-9]{1,3}[\x20.-]|0?[0-9]{2,4}[\x20.-])[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9A-Za-z_-]|\.[0-9])", r"[0-9][)\x20.-]{1,2}[0-9]"),
    ("secret", r"(?<=[=:]|[=:]\x20|[=:][\x22\x27]|[=:]\x20[\x22\x27])[A-Za-z0-9+/_-]{8,}+={0,2}", r"[=:][\x20\x22\x27]{0,2}[A-Za-z0-9]"),
    ("secret", r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+", "[0-9][A-Za-z]|[A-Za-z][0-9]"),
    ("secret", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}"),
]
#: Words that announce a kind, looked for in the characters before a candidate.
ANNOUNCE = {
    "email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|pay", "phone": "call|phone|tel|mobile|fax",
    "secret": "passw|passphrase|pwd|token|secret|api.?key|access.?key|private.?key|credential|auth|iban",
}
#: Prefixes by which issuers mark their keys.
ISSUED = "^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk_live_|rk_live_|xox[abpr]-|AIza|eyJ)"
CHUNK, BEFORE, MARK = 256, 32, "\x01"
BLOCK = 4096


def _before(values: Column, zero: Column, op: Callable[[Column, Column], Column]) -> Column:
    """What ``op`` makes of all elements before each, in two levels of at most CHUNK elements each step."""
    at = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(CHUNK))
    chunks = F.transform(at, lambda i: F.slice(values, i, CHUNK))

    def running(values: Column, start: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(values, F.struct(start.alias("s"), none.alias("a")), lambda acc, x: F.struct(op(acc.s, x).alias("s"), F.array_append(acc.a, acc.s).alias("a")), lambda acc: acc.a)

    whole = F.transform(chunks, lambda c: F.aggregate(c, zero, op))
    return F.flatten(F.zip_with(chunks, running(whole, zero), running))


def matches(text: str, pattern: str, needs: str, name: str, df: DataFrame) -> DataFrame:
    """``df`` with ``name``: array of (st, en, s, pre, nx) of the pattern's matches in column ``text``, which must not hold MARK."""
    t = F.col(text)
    marked = F.when(t.rlike(needs), F.regexp_replace(t, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")))
    df = df.withColumn("__p", F.when(marked.contains(MARK), F.split(marked, MARK, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__b", F.when(F.size("__p") > 0, _before(F.transform("__p", F.length), F.lit(0), lambda a, x: a + x)).otherwise(F.array().cast("array<int>")))
    part = lambda i: F.get(F.col("__p"), i)

    def one(i: Column) -> Column:
        st, own = F.get(F.col("__b"), i), part(i)
        return F.struct(st.alias("st"), (st + F.length(own)).alias("en"), own.alias("s"), F.right(part(i - 1), F.lit(BEFORE)).alias("pre"), F.left(part(i + 1), F.lit(1)).alias("nx"))

    odd = F.when(F.size("__p") > 2, F.sequence(F.lit(1), F.size("__p") - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(name, F.transform(odd, one)).drop("__p", "__b")


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def passes(kind: str, s: Column) -> Column:
    """Whether a base match holds its kind's check."""
    n = F.length(digits(s))
    if kind == "ip":
        octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return s.rlike(f"^{octet}(?:\\.{octet}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), F.call_function("luhn_check", digits(s))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def holds(kind: str, s: Column) -> Column:
    """The check of a proposed span; phones may lack their country, IP addresses be of the longer form."""
    if kind == "ip":
        return s.contains(":") | passes(kind, s)
    return F.length(digits(s)).between(8, 15) if kind == "phone" else passes(kind, s)


#: Neither the kind nor its check is learned from: the check decides labels, and a number that looks like a failed address must
#: not pass as a phone.
FEATURES = ["f_digits", "f_groups", "f_length", "f_separators", "f_last", "f_before", "f_after", "f_announced", "f_letters", "f_capitals", "f_hex"]


def described(kind: str, c: Column, good: Column) -> Column:
    """Candidate ``c`` with its kind and features; ``good``: its check. A leading plus is not counted, so that numbers without one can be alike."""
    s, n = F.ltrim(c.s, F.lit("+")), F.length(digits(c.s))
    groups = F.size(F.split(s, "[^0-9A-Za-z]+"))
    last = F.length(F.regexp_extract(s, "([0-9A-Za-z]*)$", 1))
    separators = s.contains(" ").cast("int") + 2 * s.contains("-").cast("int") + 4 * s.contains(".").cast("int") + 8 * s.rlike("[()\\[\\]{}]").cast("int")
    before = F.when(c.pre == "", 0).when(c.pre.rlike("[\\x20\\n]$"), 1).when(c.pre.rlike("[A-Za-z]$"), 2).when(c.pre.rlike("[0-9]$"), 3).when(c.pre.rlike("[=:\\x22\\x27]$"), 5).otherwise(4)
    after = F.when(c.nx == "", 0).when(c.nx.rlike("[\\x20\\n]"), 1).when(c.nx.rlike("[A-Za-z]"), 2).when(c.nx.rlike("[0-9]"), 3).otherwise(4)
    tenths = lambda drop: F.floor(10 * (1 - F.length(F.regexp_replace(s, drop, "")) / F.length(s))).cast("int")
    announced = F.lower(c.pre).rlike(ANNOUNCE[kind])
    return F.struct(
        F.lit(KINDS.index(kind)).alias("f_kind"), F.least(n, F.lit(24)).alias("f_digits"), F.least(groups, F.lit(12)).alias("f_groups"), F.least(F.length(s), F.lit(64)).alias("f_length"), separators.alias("f_separators"),
        good.cast("int").alias("f_check"), F.least(last, F.lit(10)).alias("f_last"), before.alias("f_before"), after.alias("f_after"), announced.cast("int").alias("f_announced"),
        tenths("[A-Za-z]").alias("f_letters"), tenths("[A-Z]").alias("f_capitals"), (~s.rlike("[^0-9a-f]")).cast("int").alias("f_hex"),
        (announced | c.s.rlike(ISSUED)).cast("int").alias("f_known"), c.st.alias("st"), c.en.alias("en"),
    )


def _touched(c: Column, kind: str) -> Column:
    """Whether ``c`` touches a base span of ``kind``: they are sorted and apart, so the last that starts before its end tells."""
    starts, ends = F.col(f"__st_{kind}"), F.col(f"__en_{kind}")
    steps = F.array(*[F.lit(1 << k) for k in range(24, -1, -1)])
    ahead = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.coalesce(F.get(starts, lo + step - 1) < c.en, F.lit(False)), lo + step).otherwise(lo))
    return (F.size(starts) > 0) & F.coalesce(F.get(ends, ahead - 1) > c.st, F.lit(False))


def found(docs: DataFrame, *keep: str) -> DataFrame:
    """(the columns ``keep``, base, failed, more): arrays of described candidates for each row of ``docs``; ``more`` has ``touch``,
    a bit for each kind of base span that it touches."""
    df = docs.select(*keep, F.translate(F.coalesce("text", F.lit("")), MARK, "\x02").alias("__t"))
    for kind in BASE_KINDS:
        df = matches("__t", BASE[kind], NEEDS[kind], f"__m_{kind}", df)
    for k, (_, pattern, needs) in enumerate(MORE):
        df = matches("__t", pattern, needs, f"__g_{k}", df)
    df = df.drop("__t")
    good, bad = (lambda kind: lambda c: passes(kind, c.s)), (lambda kind: lambda c: ~passes(kind, c.s) & (F.length(digits(c.s)) >= 6))
    as_base, as_failed = (lambda kind: lambda c: described(kind, c, F.lit(True))), (lambda kind: lambda c: described(kind, c, F.lit(False)))
    df = df.withColumns({f"__ok_{kind}": F.filter(f"__m_{kind}", good(kind)) for kind in BASE_KINDS})
    df = df.withColumns({f"__{end}_{kind}": F.col(f"__ok_{kind}.{end}") for kind in BASE_KINDS for end in ("st", "en")})
    base = F.concat(*[F.transform(f"__ok_{kind}", as_base(kind)) for kind in BASE_KINDS])
    failed = F.concat(*[F.transform(F.filter(f"__m_{kind}", bad(kind)), as_failed(kind)) for kind in BASE_KINDS[1:]])

    def proposed(kind: str) -> Callable[[Column], Column]:
        touch = lambda c: sum((F.when(_touched(c, own), 1 << k).otherwise(0) for k, own in enumerate(BASE_KINDS)), F.lit(0))
        return lambda c: F.struct(described(kind, c, holds(kind, c.s)).alias("c"), touch(c).alias("touch"))

    more = F.concat(*[F.transform(f"__g_{k}", proposed(kind)) for k, (kind, _, _) in enumerate(MORE)])
    return df.select(*keep, base.alias("base"), failed.alias("failed"), more.alias("more"))


def learned(seen: DataFrame, sample: int = SAMPLE) -> tuple[boosting.Trees, dict[str, float]]:
    """Trees, and for each kind the threshold from which on a candidate is a span (2.0: none), from ``found`` rows with a doc_id."""
    secret = KINDS.index("secret")
    crossed = f"filter(more, m -> m.touch & ~shiftleft(1, m.c.f_kind) <> 0 and m.c.f_kind <> {secret})"
    secrets = f"filter(more, m -> m.touch = 0 and m.c.f_kind = {secret})"
    labelled = "concat(transform(base, c -> struct(c as c, 1 as y)), transform(failed, c -> struct(c as c, 0 as y)), " f"transform({crossed}, m -> struct(m.c as c, 0 as y)), transform({secrets}, m -> struct(m.c as c, m.c.f_known as y)))"
    rows = written(seen.select("doc_id", F.expr(f"explode({labelled})").alias("r")).select(F.xxhash64("doc_id").alias("h"), "r.c.*", "r.y"), "pii-labelled")
    rows = rows.withColumn("half", F.pmod(F.xxhash64("h", F.lit("half")), F.lit(2)))
    taught = rows.where("half = 0")
    parts = [taught.where(F.col("f_kind") == k).orderBy(F.xxhash64("h", "st"), "st", "en").limit(sample) for k in range(len(KINDS))]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    model = boosting.fit(chosen, FEATURES, "cast(y as double)", trees=16)
    held = rows.where("half = 1 and f_check = 1").select("f_kind", "y", F.expr(f"floor(50 * {model.probability()})").alias("step"))
    counted = held.groupBy("f_kind", "step").agg(F.count("*").alias("n"), F.sum("y").alias("good")).collect()  # 5 x 51 rows at most
    thresholds = {}
    for k, kind in enumerate(KINDS):
        thresholds[kind], n, good = 2.0, 0, 0
        at = {r.step: r for r in counted if r.f_kind == k}
        for step in range(50, -1, -1):
            n, good = n + (at[step].n if step in at else 0), good + (at[step].good if step in at else 0)
            # a gap between known candidates belongs to the better side, down to even odds
            if good + 0.5 >= PRECISION * (n + 1) and (step in at or step >= 25):
                thresholds[kind] = step / 50
    return model, thresholds


def learn(docs: DataFrame, sample: int = SAMPLE) -> tuple[boosting.Trees, dict[str, float]]:
    """``learned`` from ``docs`` (doc_id, text)."""
    return learned(found(docs, "doc_id"), sample)


def marked(seen: DataFrame, model: boosting.Trees, thresholds: dict[str, float], *keep: str) -> DataFrame:
    """(the columns ``keep``, base, added): sorted arrays of (st, kind number, en) for ``found`` rows."""
    limit = "element_at(array({}), c.f_kind + 1)".format(", ".join(f"{thresholds[k]!r}D" for k in KINDS))
    free = "transform(filter(more, m -> m.touch = 0 and m.c.f_check = 1), m -> m.c)"
    chosen = f"filter({free}, c -> {model.probability('c.')} >= {limit})"
    plain = "array_sort(array_distinct(transform({}, c -> struct(c.st as st, c.f_kind as k, c.en as en))))"
    return seen.select(*keep, F.expr(plain.format("base")).alias("base"), F.expr(plain.format(chosen)).alias("added"))


def spans(docs: DataFrame, model: boosting.Trees, thresholds: dict[str, float]) -> DataFrame:
    """(doc_id, base, added): arrays of (st, kind number, en) for each row of ``docs`` (doc_id, text)."""
    return marked(found(docs, "doc_id"), model, thresholds, "doc_id")


def _joined(spans: str) -> Column:
    names = "array({})".format(", ".join(f"'{k}'" for k in KINDS))
    return F.expr(f"array_join(transform({spans}, c -> concat_ws(':', element_at({names}, c.k + 1), c.st, c.en)), ',')")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    seen = written(found(docs, "doc_id"), "pii-found")
    both = marked(seen, *learned(seen), "doc_id")
    of = lambda spans, k: F.expr(f"cast(size(filter({spans}, c -> c.k = {k})) as bigint)")
    counts = [of("base", k).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)]
    more = [F.expr("cast(size(added) as bigint)").alias("n_added"), of("added", KINDS.index("secret")).alias("n_secret"), F.expr("cast(size(base) + size(added) > 0 as int)").alias("has_span")]
    return both.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("array_sort(concat(base, added))").alias("spans"), *more)


def redact(docs: DataFrame, model: boosting.Trees, thresholds: dict[str, float]) -> DataFrame:
    """``docs`` with ``redacted``: each maximal stretch of spans replaced by the kind of its first, in brackets.

    Each row is searched and redacted by itself; nothing is joined. Pieces are cut out of blocks of BLOCK code points, so a long
    text is not walked again for each.
    """
    whole = docs.withColumn("__row", F.struct(*[c for c in docs.columns if c != "redacted"]))
    rows = marked(found(whole, "__row"), model, thresholds, "__row")
    rows = rows.select("__row", F.array_sort(F.concat("base", "added")).alias("a"), F.coalesce("__row.text", F.lit("")).alias("t"))
    rows = rows.withColumn("reach", F.when(F.size("a") > 0, _before(F.transform("a", lambda c: c.en), F.lit(0), lambda x, y: F.greatest(x, y))).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("first", F.filter(F.transform("a", lambda c, i: F.when(c.st >= F.get(F.col("reach"), i), i)), lambda i: i.isNotNull()))
    names = "array({})".format(", ".join(f"'[{k}]'" for k in KINDS))
    rows = rows.withColumn("cut", F.expr(f"transform(first, (i, j) -> struct(a[i].st as st, coalesce(get(reach, get(first, j + 1)), array_max(transform(a, c -> c.en))) as en, element_at({names}, a[i].k + 1) as name))"))
    rows = rows.withColumn("blocks", F.regexp_extract_all("t", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    start, end = "coalesce(get(cut, j - 1).en, 0)", "coalesce(get(cut, j).st, length(t))"
    own = lambda: f"substring(array_join(slice(blocks, cast({start} div {BLOCK} as int) + 1, cast({end} div {BLOCK} as int) - cast({start} div {BLOCK} as int) + 1), ''), {start} % {BLOCK} + 1, {end} - {start})"
    text = f"case when size(cut) = 0 then t else array_join(transform(sequence(0, size(cut)), j -> {own()} || coalesce(get(cut, j).name, '')), '') end"
    return rows.select("__row", F.expr(text).alias("redacted")).select("__row.*", "redacted")


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}
