import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimloom.llm import toxicity
from tests.llm import cases


def test_l1_keeps_noise_at_zero_and_finds_the_signal():
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for k in range(600):
        own = rng.integers(1000, 50_000, 80)
        y = int(k % 6 == 0)
        rows.append(np.unique(np.append(own, 7 if y else 8)))
        labels.append(y)
    model = toxicity.ftrl(rows, labels)
    weight = dict(zip(model.features.tolist(), model.values.tolist(), strict=True))
    assert weight[7] > 1 and weight.get(8, 0) <= 0
    assert len(weight) < 500


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = toxicity.op1_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p for y, p in held if y)
    assert hit > 0.7 * sum(y for y, _ in held)
    assert sum(p for y, p in held if not y) < 0.02 * len(held)


def test_tables(spark):
    docs, empty = cases.documents(spark), cases.empty(spark)
    labels = spark.createDataFrame([(1, 1), (6, 1), (6, 1), (9, 0), (12, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.learn(labels, docs)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(cases.ROWS) and len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    nothing = toxicity.learn(labels.where("false"), docs)
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {toxicity.logistic(-35.0)}
    assert toxicity.score(empty, model).count() == 0
    assert len(toxicity.learn(labels, empty).features) == 0


def slow_grams(text):
    """Feature numbers of a text by the docstring's rule, in whole numbers."""
    m = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
    h = [xxhash.xxh64_intdigest(w) for w in re.findall(r"[^\W\d_]+|\d+", text.lower())]
    cut = lambda x: x % 2**64 >> 44
    return {cut(a * m[0]) for a in h} | {cut((a * m[1] + b) * m[2]) for a, b in zip(h, h[1:])} | {cut((a * m[3] + b) * m[1]) for a, b in zip(h, h[2:])}


def slow_ftrl(rows, labels, l1):
    z, n, w_of = {}, {}, lambda z, n: 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((1 + math.sqrt(n)) + 0.1)
    share = sum(labels) / len(labels)
    bias, bias_n, order = math.log(share / (1 - share)), 0.0, np.random.default_rng(11)
    for _ in range(2):
        for k in order.permutation(len(rows)):
            w = {i: w_of(z.get(i, 0.0), n.get(i, 0.0)) for i in rows[k]}
            g = 1 / (1 + math.exp(-bias - sum(w.values()))) - labels[k]
            for i in rows[k]:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) * w[i]
                n[i] = old + g * g
            bias_n += g * g
            bias -= g / (1 + math.sqrt(bias_n))
    return lambda row: 1 / (1 + math.exp(-bias - sum(w_of(z.get(i, 0.0), n.get(i, 0.0)) for i in row)))


def test_query_against_a_plain_learner(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: (slow_grams(r.text or ""), r.h) for r in spark.read.parquet(f"{sf}/documents.parquet").withColumn("h", F.xxhash64("doc_id")).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    ids = sorted(labels, key=lambda i: docs[i][1])
    rows, y = [docs[i][0] for i in ids], [labels[i] for i in ids]
    train, test = [k for k in range(len(ids)) if k % 5], [k for k in range(len(ids)) if k % 5 == 0]

    def loss(l1):
        of = slow_ftrl([rows[k] for k in train], [y[k] for k in train], l1)
        return -sum(math.log((p if y[k] else 1 - p) + 1e-12) for k in test for p in [of(rows[k])])

    want = slow_ftrl(rows, y, min(toxicity.STRENGTHS, key=loss))
    found = {r.doc_id: r.score for r in toxicity.op1_toxicity(spark, sf).collect()}
    assert found.keys() == docs.keys() and all(found[i] == pytest.approx(want(docs[i][0]), abs=1e-6) for i in docs)


def test_the_sample_is_bounded_by_characters(spark):
    rows = [(k, "word " * 200 + ("bad" if k % 2 else "good"), k % 2) for k in range(200)] + [(500, "long good " * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(df.select("doc_id", "toxic"), df.select("doc_id", "text"), chars=60_000)
    score = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert min(score[k] for k in range(1, 200, 2)) > 0.3 > max(score[k] for k in range(0, 200, 2))
