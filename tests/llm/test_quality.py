import re
from collections import Counter


from claimloom.llm import quality
from tests.llm import cases

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    extra = [(100 + k, t) for k, t in enumerate(["a b c a b c", "x\ny\nx\n\n\nx", "a a a a", "# $ % | <b>", "p q r s p q r t p q"])]
    docs = spark.createDataFrame([(r[0], r[1]) for r in cases.ROWS] + extra, "doc_id long, text string")
    texts = dict([(r[0], r[1]) for r in cases.ROWS] + extra)
    for r in quality.counts(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(texts[r.doc_id]), r.doc_id


def test_counts_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.counts(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(texts[r.doc_id])


def test_em_finds_the_rates():
    import random

    rng = random.Random(5)
    rates = [(0.95, 0.2), (0.9, 0.1), (0.85, 0.3), (0.9, 0.25)]
    seen = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        seen[tuple(-1 if rng.random() < 0.1 else int(rng.random() < r[0 if good else 1]) for r in rates)] += 1
    found = quality.estimate([(list(v), n) for v, n in seen.items()])
    assert abs(found.good - 0.8) < 0.03
    assert all(abs(a - c) < 0.05 and abs(b - d) < 0.08 for (a, b), (c, d) in zip(found.rates, rates, strict=True))
    assert found.posterior([1, 1, 1, 1]) > 0.95 > 0.1 > found.posterior([0, 0, 0, 0])


def test_verdicts(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = quality.op3_quality(spark, "/root/testdata/sf0.01").collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert sum(good) > 0.98 * len(good)
    assert sum(bad) < 0.2 * len(bad)
    assert not any(r.kept for r in rows if r.base_failed)


def test_tables(spark):
    assert quality.judge(cases.documents(spark)).count() == len(cases.ROWS)
    assert quality.judge(cases.empty(spark)).count() == 0
