"""URL filtering: rules by host and path first, gradient-boosted trees on lexical features for the rest.

A rule is ``host/path``: it fits its host and all subdomains where the url's path starts with its path; of the rules that fit,
the longest wins. URLs that rules decide are the labelled ones; a bounded sample of them (SAMPLE pages, by the hash of the url)
trains trees on length, depth, digit ratio, entropy, parameter counts, statistics of the host's suffix, and the share of allowed
pages among labelled ones that are alike in suffix, site or the beginning of the path (SHARES). A page's own fold of FOLDS is left out of its
shares, so that no label explains itself. Suffix statistics and shares are counts over all pages. Everything is DataFrame and SQL
functions; the driver sees the sample's cells, counted by feature.

Tables of shares hold keys of LEAST labelled pages or more. They are written before they are joined, so Spark may broadcast those
that are small by their size and split hot keys in the others.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is scored by its (empty) features;
urls of any length are read whole; repeated rows are judged alike; ties (a score of the threshold) are allowed; without labelled
urls the method allows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import boosting
from claimloom.llm.common import ascii_lower, table, written
from claimloom.session import spread

#: Labelled pages to learn from, at most; folds of the shares; labelled pages that a key's share needs.
SAMPLE, FOLDS, LEAST = 20_000, 4, 3
#: Keys that labelled pages are counted by; parts of a host are its last labels, of a path its first segment and what follows.
SHARES = {
    "suffix": "suffix",
    "site": "site",
    "first": "first",
    "suffix_first": "concat_ws('/', suffix, first)",
    "site_first": "concat_ws('/', site, first)",
    "site_head": "concat_ws('/', site, first, left(second, 1))",
}
_SHARE_STEPS = [0.01, 0.05, 0.15, 0.3, 0.45, 0.55, 0.7, 0.85, 0.95, 0.99]


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    def fits(self) -> Column:
        host, _, path = self.text.partition("/")
        on_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        return on_host & F.col("path").startswith(f"/{path}")


RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"), Rule("block", "com/de/"))


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, by_rule) for each row of ``pages`` (page_id, url)."""
    url = F.coalesce("url", F.lit(""))
    parts = pages.select("page_id", url.alias("url"), ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)([^?#]*)", 1)).alias("host"), F.regexp_extract(url, "(?s)^.*?://([^/?#]*)([^?#]*)", 2).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):  # the longest is asked first
        rule, verdict = F.when(r.fits(), r.text).otherwise(rule), F.when(r.fits(), r.verdict).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("by_rule", verdict)


def _steps(value: str, edges: list[float]) -> str:
    """SQL for the number of ``edges`` that ``value`` reaches."""
    return " + ".join(f"cast({value} >= {e} as int)" for e in edges)


FEATURES = {
    "f_length": _steps("length(url)", [16, 24, 32, 36, 40, 44, 48, 56, 64, 80, 128]),
    "f_host": _steps("length(host)", [8, 12, 16, 20, 24, 28, 32, 48]),
    "f_labels": "least(size(split(host, '[.]')), 8)",
    "f_depth": "least(length(path) - length(replace(path, '/', '')), 12)",
    "f_path": _steps("length(path)", [2, 5, 8, 10, 12, 16, 24, 48]),
    "f_digits": _steps("(length(url) - length(translate(url, '0123456789', ''))) / greatest(length(url), 1)", [0.02, 0.05, 0.08, 0.1, 0.13, 0.16, 0.2, 0.3, 0.5]),
    "f_entropy": _steps("entropy", [2.0, 2.5, 3.0, 3.4, 3.6, 3.8, 3.9, 4.0, 4.1, 4.2, 4.4, 4.8]),
    "f_params": "least(length(url) - length(translate(url, '=&', '')), 8)",
    "f_query": "cast(contains(url, '?') as int)",
    "f_fragment": "cast(contains(url, '#') as int)",
    "f_slash": "cast(endswith(path, '/') as int)",
    "f_file": "cast(path rlike '[.][A-Za-z0-9]{1,5}$' as int)",
    "f_secure": "cast(startswith(url, 'https') as int)",
    "f_dashes": "least(length(host) - length(replace(host, '-', '')), 6)",
    "f_suffix": _steps("suffix_share", [0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.6]),
    "f_site": _steps("suffix_sites", [2, 8, 32, 128, 512, 2048]),
    **{f"f_share_{name}": _steps(f"share_{name}", _SHARE_STEPS) for name in SHARES},
}


def with_features(parts: DataFrame, taught: str) -> DataFrame:
    """``parts`` with FEATURES, small integers, and ``taught`` (SQL: whether a row's label counts for the shares)."""
    segment = lambda k: F.coalesce(F.get(F.split("path", "/"), F.lit(k)), F.lit(""))
    named = {"suffix": F.substring_index("host", ".", -1), "site": F.substring_index("host", ".", -2), "first": segment(1), "second": segment(2)}
    of = parts.withColumns(named).withColumns({"taught": F.coalesce(F.expr(taught), F.lit(False)), "fold": F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")})
    of = of.withColumns({f"key_{name}": F.expr(sql) for name, sql in SHARES.items()}).drop("site", "first", "second")
    hosts = parts.select(named["suffix"].alias("suffix"), F.substring_index("host", ".", -3).alias("site")).groupBy("suffix", "site").agg(F.count("*").alias("n"))
    suffixes = written(hosts.groupBy("suffix").agg(F.sum("n").alias("suffix_pages"), F.count("*").alias("suffix_sites")), "url-suffixes")
    total = suffixes.agg(F.coalesce(F.sum("suffix_pages"), F.lit(0))).first()[0]
    joined = of.join(suffixes.select("suffix", (F.col("suffix_pages") / float(max(1, total))).alias("suffix_share"), "suffix_sites"), "suffix", "left")
    for name in SHARES:
        joined = _with_share(joined, of, name)
    plain = joined.withColumn("plain", F.regexp_replace("url", "[^\\x21-\\x7e]", "?"))  # 94 different characters at most
    share = "(length(plain) - length(replace(plain, c, ''))) / length(plain)"
    entropy = f"case when plain = '' then 0D else aggregate(array_distinct(split(plain, '')), 0D, (a, c) -> a - case when c = '' then 0D else {share} * log2({share}) end) end"
    found = plain.withColumn("entropy", F.expr(entropy))
    return found.select(*parts.columns, "taught", *[F.expr(sql).cast("int").alias(name) for name, sql in FEATURES.items()])


def _with_share(rows: DataFrame, of: DataFrame, name: str) -> DataFrame:
    """``rows`` with the smoothed share of allowed pages among the taught ones of other folds that have the same key."""
    key, allowed = f"key_{name}", F.col("by_rule") == "allow"
    folds = [F.count_if(F.col("fold") == k).alias(f"n_{k}") for k in range(FOLDS)] + [F.count_if((F.col("fold") == k) & allowed).alias(f"a_{k}") for k in range(FOLDS)]
    counts = of.where("taught").groupBy(key).agg(F.count("*").alias("n"), F.count_if(allowed).alias("a"), *folds).where(F.col("n") >= LEAST)
    own = lambda c: F.element_at(F.array(*[F.col(f"{c}_{k}") for k in range(FOLDS)]), F.col("fold") + 1)
    joined = rows.join(written(counts, f"url-share-{name}"), key, "left")
    n, a = F.col("n") - own("n"), F.col("a") - own("a")
    share = F.coalesce((a + 0.5) / (n + 1.0), F.lit(0.5))
    return joined.withColumn(f"share_{name}", share).drop("n", "a", *[f"{c}_{k}" for c in "na" for k in range(FOLDS)])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, taught: str = "true") -> DataFrame:
    """(page_id, host, path, rule, verdict, score, method) for each row of ``pages`` (page_id, url).

    ``method`` is what the trees say where no rule is asked. Labels count where ``taught`` (SQL) holds; the rest is held out.
    """
    seen = written(with_features(with_rule(pages, rules), f"by_rule is not null and ({taught})"), "url-features")
    sample = seen.where("taught").orderBy(F.xxhash64("url"), "page_id").limit(SAMPLE)
    model = boosting.fit(sample, list(FEATURES), "cast(by_rule = 'allow' as double)")
    scored = seen.withColumn("score", F.expr(model.probability())).withColumn("method", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "method").alias("verdict"), "score", "method")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spread(table(spark, sf_dir, "pages").select("page_id", "url")))


QUERIES = {"op5_url_filter": op5_url_filter}
ORACLE: dict[str, str] = {}
