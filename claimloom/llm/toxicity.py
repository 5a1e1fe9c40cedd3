"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashes, modulo 2 ** BITS, of its words, its pairs of neighbours (n-grams) and its pairs with one word
between them (skip-grams); each counts once however often it occurs. Training visits a bounded sample of labelled rows and updates
each coordinate with its own rate; L1 keeps a weight at zero until its gradients agree, so the model is a short list of (feature,
weight) pairs that is broadcast, at most 2 ** BITS of them. Every whole text is then scored in one pass without a shuffle.

The sample is taken in the order of the hash of doc_id, which does not depend on partitions: SAMPLE documents at most, and as
many of them as have SAMPLE_CHARS characters together (the first one in any case). All features of a sampled document
count. One executor task gets the sample's features and trains; the driver sees the weights alone. The strength of L1 is chosen
among STRENGTHS by the loss on every FOLDS-th document of the sample, then all of it is learned from. A feature whose gradients cannot add up to L1
(each is below one, and comes once an epoch for each document that has it) stays at zero, so it is left out from the start.

Labels, lang, source and doc_id are never features; doc_id only picks the sample and marks what was held out.

Defined cases: null or empty text has the bias alone as its score; texts of any length are scored whole; rows whose label is null
are not learned from; a doc_id with several labels or texts gives one training row (the toxic label, the smaller text); with one
class only, all scores are next to 0 or next to 1, and next to 0 without labels; repeated rows score alike; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import arrow_batches, table, written
from claimloom.session import spread

BITS = 20
#: Documents to learn from, and their characters, at most.
SAMPLE, SAMPLE_CHARS = 16_000, 64 << 20
#: Strengths of L1 to choose from, and the share of the sample (one in FOLDS) to choose by.
STRENGTHS, FOLDS = (3.0, 6.0, 10.0), 5
#: Words that a worker remembers the hashes of.
MEMO = 1_000_000
words_of = re.compile(r"[^\W\d_]+|\d+").findall
#: Odd multipliers of the mixing steps.
MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Hashes(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def grams(text: str | None, memo: Hashes) -> np.ndarray:
    """Feature indices of a text, with repeats."""
    words = words_of((text or "").lower())
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    shift = np.uint64(64 - BITS)
    parts = [h * MIX[0] >> shift]
    if len(h) > 1:
        parts.append((h[:-1] * MIX[1] + h[1:]) * MIX[2] >> shift)
    if len(h) > 2:
        parts.append((h[:-2] * MIX[3] + h[2:]) * MIX[1] >> shift)
    return np.concatenate(parts).astype(np.int64)


@dataclass
class Weights:
    """The nonzero coordinates of a model."""

    features: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.features] = self.values
        return out


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(35.0, max(-35.0, x)))))


def ftrl(rows: list[np.ndarray], labels: list[int], alpha: float = 1.0, beta: float = 1.0, l1: float = 6.0, l2: float = 0.1, epochs: int = 2) -> Weights:
    """FTRL-proximal: z and n are sums of gradients and of their squares, by coordinate."""
    share = sum(labels) / len(labels) if labels else 0.0
    if not 0 < share < 1:
        return Weights(np.zeros(0, np.int64), np.zeros(0), 35.0 if share else -35.0)
    bias, bias_n = float(np.log(share / (1 - share))), 0.0
    held = np.zeros(1 << BITS, dtype=np.int64)  # documents that have each feature; a row names a feature once
    for r in rows:
        held[r] += 1
    able = np.flatnonzero(held * epochs > l1)
    place = np.full(1 << BITS, -1, dtype=np.int64)
    place[able] = np.arange(len(able))
    rows = [(own := place[r])[own >= 0] for r in rows]
    z, n = np.zeros(len(able)), np.zeros(len(able))

    def weights(i):
        zi, w = z[i], np.zeros(len(i))
        on = np.abs(zi) > l1
        w[on] = -(zi[on] - np.sign(zi[on]) * l1) / ((beta + np.sqrt(n[i][on])) / alpha + l2)
        return w

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            g = logistic(bias + float(w.sum())) - labels[k]
            root = np.sqrt(n[i])
            after = np.sqrt(n[i] + g * g)
            z[i] += g - (after - root) / alpha * w
            n[i] += g * g
            bias_n += g * g
            bias -= alpha / (beta + bias_n**0.5) * g
    i = np.flatnonzero(np.abs(z) > l1)
    return Weights(able[i], weights(i), bias)


def loss(model: Weights, rows: list[np.ndarray], labels: list[int]) -> float:
    """Mean logarithmic loss."""
    w = model.dense()
    p = np.array([logistic(model.bias + float(w[r].sum())) for r in rows])
    return float(-np.log(np.where(np.array(labels) > 0, p, 1 - p) + 1e-12).mean()) if rows else 0.0


def chosen_fit(rows: list[np.ndarray], labels: list[int]) -> Weights:
    """A model of all rows, with the strength of L1 that does best on a part of them after learning from the others."""
    train, test = [[k for k in range(len(rows)) if (k % FOLDS == 0) == held] for held in (False, True)]
    part = lambda of, keep: [of[k] for k in keep]
    tried = {l1: loss(ftrl(part(rows, train), part(labels, train), l1=l1), part(rows, test), part(labels, test)) for l1 in STRENGTHS}
    return ftrl(rows, labels, l1=min(STRENGTHS, key=tried.get))


def learn(labelled: DataFrame, docs: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Weights:
    """Fit on at most ``sample`` of ``labelled`` (doc_id, toxic), of ``chars`` characters, whose texts ``docs`` (doc_id, text) holds."""
    arrow_batches(docs.sparkSession)
    one = labelled.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text"))
    texts = written(texts.withColumns({"h": F.xxhash64("doc_id"), "chars": F.length("text").cast("long")}), "toxicity-sample")
    upto, last = 0, None
    for r in sorted(texts.select("h", "chars").collect()):  # ``sample`` pairs of numbers
        upto += r.chars
        if last is not None and upto > chars:
            break
        last = r.h
    if last is None:
        return ftrl([], [])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for batch in batches:
            found = [np.unique(grams(t, memo)).astype(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["h", "toxic", "grams"])

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("h")
        model = chosen_fit([g.values.to_numpy() for g in group.column("grams")], [int(x) for x in group.column("toxic").to_pylist()])
        return pa.table({"feature": pa.array(np.r_[-1, model.features].astype(np.int64)), "weight": pa.array(np.r_[model.bias, model.values].astype(np.float64))})

    rows = texts.where(F.col("h") <= last).select("h", "toxic", "text").mapInArrow(features, "h long, toxic int, grams array<int>")
    found = sorted(rows.groupBy(F.lit("model").alias("model")).applyInArrow(fit, "feature long, weight double").collect())  # bias first, then the weights
    return Weights(np.array([r.feature for r in found[1:]], dtype=np.int64), np.array([r.weight for r in found[1:]]), found[0].weight)


def score(docs: DataFrame, model: Weights) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, memo = sent.value.dense(), sent.value.bias, Hashes()
        on = weights != 0
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                found = grams(text, memo)
                out.append(logistic(bias + float(weights[np.unique(found[on[found]])].sum())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    scored = score(docs, learn(labels, docs))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLE: dict[str, str] = {}
