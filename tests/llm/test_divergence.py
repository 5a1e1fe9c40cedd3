import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.llm import divergence
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def slow(rows, min_docs, top=50):
    held, count, groups = defaultdict(set), Counter(), set()
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in terms(text):
            held[lang, t].add(k)
            count[lang, source, t] += 1
    out = set()
    for lang, source in groups:
        kept = [t for (x, t), d in held.items() if x == lang and len(d) >= min_docs]

        def p(*sources, kept=kept, lang=lang):
            n = {t: sum(count[lang, s, t] for s in sources) for t in kept}
            return {t: 1 + 1_000_000_000 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        own = p(source)
        q = p(*[s for x, s in groups if x == lang])
        others = {s: p(s) for x, s in groups if x == lang and s != source}
        far = sorted((-sum(abs(own[t] - b[t]) for t in kept), s.encode(), s) for s, b in others.items())
        over = sorted((q[t] - own[t], t.encode(), t) for t in kept if count[lang, source, t] and own[t] > q[t])[:top]
        for part, found in (("pair", far), ("term", over)):
            out |= {(lang, source, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)}
    return out


def rows_of(df):
    got = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("min_docs", [1, 2, 3, 30])
def test_awkward_documents(spark, min_docs):
    docs = cases.documents(spark).withColumns({"term": F.lit(1), "n": F.lit("x"), "block": F.lit(None).cast("string")})
    want = slow([(r[1], r[2], r[3]) for r in cases.ROWS], min_docs)
    assert rows_of(divergence.audit(docs, min_docs)) == want
    assert rows_of(divergence.audit(docs, min_docs, block=2)) == want  # blocks of a term or two
    assert divergence.audit(cases.empty(spark)).count() == 0


def test_groups_without_terms(spark):
    rows = [("12 34", "xx", "a"), ("", "xx", "b"), (None, None, "a"), ("ab ab", None, None), ("ab", "", "z")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = rows_of(divergence.audit(docs, 2))
    assert got == slow(rows, 2) and {r for r in got if r[0] == "xx"} == {("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)}
    assert {r[4] for r in got if r[2] == "pair"} == {0}  # one kept term has share 1 everywhere


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = slow([(r.text, r.lang, r.source) for r in docs.collect()], 5)
    assert rows_of(divergence.audit(docs, 5, block=300)) == want


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from("aAbZ é日1 .\n@[`{\x7f"), max_size=30), max_size=6), window=st.integers(1, 9), weak=st.booleans())
def test_windows_and_collisions(texts, window, weak):
    digest, size = divergence.xxhash.xxh3_64_intdigest, divergence.WINDOW
    divergence.WINDOW = window
    divergence.grouped.__defaults__ = ((lambda b: len(b) % 2) if weak else digest,)  # nearly all slices collide
    try:
        counter = divergence.Counter()
        counter.add(["x"] * len(texts), ["y"] * len(texts), pa.array(texts, pa.string()))
        got = {r["term"]: (r["n"], r["docs"]) for r in counter.rows().to_pylist() if r["term"]}
    finally:
        divergence.WINDOW, divergence.grouped.__defaults__ = size, (digest,)
    want = Counter(t for x in texts for t in terms(x))
    assert got == {t: (n, sum(t in terms(x) for x in texts)) for t, n in want.items()}


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    total = rng.integers(1, divergence.LARGEST, 300)
    count = (total * rng.random(300)).astype(np.int64)
    assert divergence.share(count, total).tolist() == [1 + 10**9 * (c + 5) // t for c, t in zip(count.tolist(), total.tolist(), strict=True)]
    with pytest.raises(OverflowError):
        divergence.share(np.array([1]), divergence.LARGEST + 1)


def test_query_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert rows_of(divergence.op11_divergence(spark, sf)) == set(con.execute(divergence.ORACLE["op11_divergence"]).fetchall())
