from collections import Counter, defaultdict

import numpy as np
import pytest

from claimloom.llm import mixing
from tests.llm import cases


def slow_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        target = {s: float(most * sizes[s]) for s in full} | {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 3, "e": 0, None: 50}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "src string, size long")
    found = {r.src: r.target for r in mixing.source_targets(df).collect()}
    want = slow_targets(sizes)
    assert found.keys() == want.keys() and all(abs(found[s] - want[s]) < 1e-6 for s in want)


def test_mix_comes_near_its_targets(spark):
    rows = mixing.op10_mixing(spark, "/root/testdata/sf0.1").collect()
    docs = {r.doc_id: r.source for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source").collect()}
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[docs[r.doc_id]] += r.taken
        target[docs[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
    assert all(abs(taken[s] - t) <= 0.02 * t for s, t in target.items())
    again = {(r.doc_id, r.taken) for r in mixing.op10_mixing(spark, "/root/testdata/sf0.1").collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_tables(spark):
    docs = cases.documents(spark)  # with columns named size, score and key
    rows = mixing.with_copies(docs).collect()
    assert len(rows) == len(cases.ROWS)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in rows)
    assert mixing.with_copies(cases.empty(spark)).count() == 0 == mixing.mix(cases.empty(spark)).count()


def test_many_sources(spark):
    sizes = {f"host{k}.é" if k % 7 else f"Z{k}": (k * 7919) % 1000 + (5000 if k % 40 == 0 else 0) for k in range(700)} | {None: 12, "": 3}
    found = {r.src: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "src string, size long")).collect()}
    want = slow_targets(sizes)
    assert found.keys() == want.keys() and all(abs(found[s] - want[s]) < 1e-6 for s in want)


@pytest.mark.parametrize("rows_per_cell", [20_000, 1])
def test_mix_against_one_running_sum(spark, monkeypatch, rows_per_cell):
    """One repeated document, rows without an id, long documents, a source of nulls; more cells leave the draw as it is."""
    from tests.llm.test_pipeline import slow_mix

    monkeypatch.setattr(mixing, "ROWS_PER_CELL", rows_per_cell)
    rows = [(k, "w " * (k * 37 % 400), f"s{k % 5}") for k in range(600)] + [(7, "same text again", "s1")] * 300
    rows += [(None, "no id " * (k % 9), None) for k in range(100)] + [(2000 + k, "long " * 30_000, "s2") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert Counter((r.doc_id, r.text) for r in mixing.mix(docs).collect()) == Counter(slow_mix(rows))
    assert mixing.with_copies(docs).count() == len(rows)


def test_small_sources_come_near_their_targets(spark):
    """Sources of a few dozen documents of very unlike lengths: within 2 % or one smallest document, whatever the longest would draw."""
    rng = np.random.default_rng(11)
    rows = [(k * 1000 + i, "w " * int(n), f"s{k:02}") for k in range(40) for i, n in enumerate(np.maximum(5, rng.lognormal(4, 1, 60)).astype(int))]
    found = defaultdict(lambda: [0, 0.0, 10**9])
    for r in mixing.with_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        own = found[r.key]
        own[0], own[1], own[2] = own[0] + r.size * r.copies, r.target, min(own[2], r.size)
        assert 0 <= r.copies <= 3
    assert len(found) == 40 and all(abs(taken - target) <= max(0.02 * target, smallest) for taken, target, smallest in found.values())
