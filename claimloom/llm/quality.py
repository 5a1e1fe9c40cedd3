"""Document quality by weak supervision: rules vote or abstain, EM estimates their accuracies, a posterior decides.

Each rule reads counts of one text and votes 1 (good), 0 (bad) or abstains. Votes of a document form a pattern; documents are
counted by pattern (at most 3 to the number of rules, however many documents), and expectation-maximisation over those counts
estimates the share of good documents and, for each rule, how often it votes good for good and for bad documents. A document's
posterior probability of being good is then a sum of the log odds of its votes, one CASE for each rule. It is kept if that
reaches ``threshold``; the two base rules (too few words, too much repetition) reject by themselves, and what they reject is not
learned from.

Everything on rows is DataFrame and SQL functions. Counts within a text are higher-order functions over its own arrays, so no
text is exploded and nothing but pattern counts is shuffled. Repeated word windows are found by 64-bit hashes of the windows (made
from 64-bit hashes of the words) alone, sorted with their places: linear in the text but for the sort.

Defined cases: null text has no words and fails the base rules, as does empty text; texts of any length are counted whole;
repeated rows are judged alike; a null doc_id is kept as it is; extra columns are ignored by ``judge``; an empty table gives an
empty result (no estimate is made).
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import BLANKS, DOCUMENT, table, written
from claimloom.session import spread

#: A rule's rates stay inside these bounds, and a rule votes good for good documents at least as often as for bad ones, so none
#: turns its meaning around; one that tells nothing apart ends with equal rates and no weight.
LEAST_RATE, MOST_RATE = 0.005, 0.995


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains; both are SQL over the counts."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), 0).when(F.expr(self.good), 1).otherwise(-1).alias(f"vote_{self.name}")


RULES = (
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 7 * n_words", "word_chars between 3 * n_words and 65 * n_words / 10"),
    Rule("symbols_by_word", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("symbols_by_char", "50 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    Rule("line_copies", "10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    Rule("repetition", "10 * n_repeat_words > 3 * n_words", "10 * n_repeat_words <= n_words"),
    Rule("sentences", "60 * n_stops < n_words", "30 * n_stops >= n_words"),
    Rule("digits", "5 * n_digits > word_chars", "20 * n_digits <= word_chars"),
)


def counts(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stops, n_digits) of each row.

    ``whole_rows`` adds ``row``, the row itself as a struct.
    """
    own = ["doc_id", "row"] if whole_rows else ["doc_id"]
    row = [F.struct(*docs.columns).alias("row")] if whole_rows else []
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *row)

    lines = F.expr("filter(split(text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')")
    words = F.array_remove(F.split(F.translate("text", BLANKS[1:], " " * (len(BLANKS) - 1)), " "), "")  # one blank: no pattern is compiled
    arrays = text.select(
        *own, words.alias("w"), lines.alias("l"), F.regexp_count("text", F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.regexp_count("text", F.lit("[.!?][\"')\\]]?(?=[\\x20\\x09-\\x0D]|$)")).alias("n_stops"), F.regexp_count("text", F.lit("[0-9]")).alias("n_digits"),
    )
    hashed = arrays.withColumn("g", F.expr("transform(w, x -> xxhash64(x))"))
    window = "case when size(g) < 3 then cast(array() as array<bigint>) else transform(slice(g, 1, size(g) - 2), (x, i) -> xxhash64(x, get(g, i + 1), get(g, i + 2))) end"
    hashed = hashed.withColumn("h", F.expr(window)).drop("g")
    # the natural order of structs, which sort_array uses, costs a fraction of a comparison by lambda
    placed = hashed.withColumn("s", F.expr("case when size(array_distinct(h)) = size(h) then null else sort_array(transform(h, (x, i) -> struct(x as h, i as i))) end"))
    twice = "filter(s, (x, k) -> get(s, k - 1).h = x.h or get(s, k + 1).h = x.h)"
    repeated = f"case when s is null then 0 else size(array_distinct(flatten(transform({twice}, x -> array(x.i, x.i + 1, x.i + 2))))) end"
    long = lambda c: c.cast("long")
    return placed.select(
        *own, long(F.size("w")).alias("n_words"), long(F.length(F.array_join("w", ""))).alias("word_chars"), long(F.col("n_symbols")).alias("n_symbols"),
        long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"), long(F.expr(repeated)).alias("n_repeat_words"), long(F.size("l")).alias("n_lines"),
        long(F.col("n_stops")).alias("n_stops"), long(F.col("n_digits")).alias("n_digits"),
    )


@dataclass(frozen=True)
class Estimate:
    """Share of good documents and, by rule, the rates of good votes among good and among bad documents."""

    good: float
    rates: tuple[tuple[float, float], ...]

    def posterior(self, votes: list[int]) -> float:
        odds = log(self.good / (1 - self.good)) + sum(log_odds(v, *r) for v, r in zip(votes, self.rates, strict=True))
        return 1 / (1 + exp(-max(-700.0, min(700.0, odds))))


def log_odds(vote: int, if_good: float, if_bad: float) -> float:
    if vote < 0:
        return 0.0
    return log(if_good / if_bad) if vote else log((1 - if_good) / (1 - if_bad))


def estimate(patterns: list[tuple[list[int], int]], rounds: int = 200, close: float = 1e-7) -> Estimate:
    """EM over (votes, documents with these votes). It starts from rules that mostly hold: good documents get good votes, bad ones
    either. Without documents that is the estimate."""
    n_rules = len(patterns[0][0]) if patterns else len(RULES)
    now = Estimate(0.9, ((0.97, 0.5),) * n_rules)
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        weight = [(votes, n, now.posterior(votes)) for votes, n in patterns]
        good = (sum(n * p for _, n, p in weight) + 9) / (total + 10)
        rates = []
        for k in range(n_rules):
            voted = [(v[k], n, p) for v, n, p in weight if v[k] >= 0]
            # a few imagined votes in each class keep rates of rare rules in place
            a = (sum(n * p for v, n, p in voted if v) + 9.7) / (sum(n * p for _, n, p in voted) + 10)
            b = (sum(n * (1 - p) for v, n, p in voted if v) + 5) / (sum(n * (1 - p) for _, n, p in voted) + 10)
            a = min(MOST_RATE, max(LEAST_RATE, a))
            rates.append((a, min(a, MOST_RATE, max(LEAST_RATE, b))))
        after = Estimate(min(0.999, max(0.001, good)), tuple(rates))
        moved = max([abs(after.good - now.good), *(abs(x - y) for r, s in zip(after.rates, now.rates, strict=True) for x, y in zip(r, s, strict=True))])
        now = after
        if moved < close:
            break
    return now


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, least_words: int = 50, most_repeated: int = 50, whole_rows: bool = False) -> DataFrame:
    """(doc_id, the counts, votes, base_failed, posterior, kept) for each row of ``docs`` (doc_id, text); ``row`` as in ``counts``."""
    voted = written(counts(docs, whole_rows).select("*", *[r.vote() for r in rules]), "quality-votes")
    names = [f"vote_{r.name}" for r in rules]
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    patterns = voted.where(~failed).groupBy(*names).count().collect()  # 3 to the number of rules at most
    model = estimate([([int(row[n]) for n in names], int(row["count"])) for row in patterns])
    odds = F.lit(log(model.good / (1 - model.good)))
    for name, rates in zip(names, model.rates, strict=True):
        odds = odds + F.when(F.col(name) == 1, log_odds(1, *rates)).when(F.col(name) == 0, log_odds(0, *rates)).otherwise(0.0)
    judged = voted.withColumn("base_failed", failed).withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that the rules keep. Rows are judged where they stand, so neither a missing nor a repeated
    doc_id matters, and no text is shuffled."""
    return judge(spread(docs.select(*DOCUMENT)), whole_rows=True).where("kept").select("row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


QUERIES = {"op3_quality": op3_quality}
ORACLE: dict[str, str] = {}
