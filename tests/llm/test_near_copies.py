import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import near_copies, simhash


def slow_set(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = slow_set(a), slow_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def slow_keep(rows):
    """Smallest doc_id of each component of rows (doc_id, text)."""
    parent = {i: i for i, _ in rows}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, s in rows:
        for j, t in rows:
            if i < j and jaccard(s, t) >= 0.8:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(i for i, _ in rows if root(i) == i)


def edited(words, changes, rng):
    """A copy with single words replaced at places far apart: each takes five shingles away and brings five others."""
    out = list(words)
    for at in rng.sample(range(5, len(words) - 5, 7), changes):
        out[at] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


def copies():
    """Pairs (original, copy) of 200 words at several similarities, some below 0.8; a chain; short and empty texts."""
    rng = random.Random(4)
    rows = []
    for group in range(36):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(len(rows) + 1, " ".join(words)), (len(rows) + 2, edited(words, 1 + group % 6, rng))]
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for at in range(0, 60, 12):  # neighbours are alike, the ends are not
        rows.append((len(rows) + 1, " ".join(words[at:] + [f"x{k}" for k in range(at)])))
    return rows + [(1000, "one two"), (1001, "One  two"), (1002, "one two three"), (1003, ""), (1004, " \n")]


@pytest.mark.parametrize(("chunk", "pivots"), [(near_copies.CHUNK, near_copies.PIVOTS), (1, 1), (2, 0), (2, 2)])
def test_stage_drops_near_copies_and_only_those(spark, monkeypatch, chunk, pivots):
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    monkeypatch.setattr(near_copies, "PIVOTS", pivots)
    rows = copies()
    found = [jaccard(rows[k][1], rows[k + 1][1]) for k in range(0, 72, 2)]
    assert sum(0.8 <= s < 0.96 for s in found) >= 24 and sum(0.7 < s < 0.8 for s in found) >= 6
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == slow_keep(rows)


def test_simhash_gives_candidates_of_its_own(spark, monkeypatch):
    """Without any MinHash key the fingerprints at 3 bits still find near copies; what they link is checked exactly."""
    monkeypatch.setattr(near_copies, "band_keys", lambda hashes: [])
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(1, " ".join(words)), (2, edited(words, 1, rng)), (3, edited(words, 2, rng)), (4, " ".join(reversed(words))), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == slow_keep(rows) == [1, 4, 5]
    far = lambda own: 0
    monkeypatch.setattr(simhash, "majority", far)  # fingerprints that link all texts: none that is unlike goes
    assert sorted(r.doc_id for r in simhash.stage(spark, docs, "").collect()) == [1, 4, 5]


def test_forest_finds_the_exact_components_of_a_bucket():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    sets = []
    for k in range(120):
        own = base.copy()
        own[rng.choice(100, k % 25, replace=False)] = rng.integers(0, 1 << 63, k % 25, dtype=np.uint64)
        sets.append(np.unique(own))
    nodes, keys = np.arange(120) * 3 - 150, np.zeros(120, dtype=np.int64)
    parent = list(range(120))
    for a in range(120):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    got = dict(zip(*(x.tolist() for x in near_copies.forest(nodes, keys, sets)), strict=True))
    assert [got.get(n, n) for n in nodes.tolist()] == [int(nodes[p]) for p in parent]
    assert 1 < len(set(parent)) < 119


@pytest.mark.parametrize("pivots", [1, 3])
def test_a_hot_group_over_many_chunks(spark, monkeypatch, pivots):
    """Near copies of one text, a chain of texts that no pivot reaches, and a second group that shares buckets with the first."""
    monkeypatch.setattr(near_copies, "CHUNK", 8)
    monkeypatch.setattr(near_copies, "PIVOTS", pivots)
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(k + 1, edited(words, 1, rng)) for k in range(90)]
    rows += [(200 + k, " ".join(words[at:] + [f"x{j}" for j in range(at)])) for k, at in enumerate(range(0, 72, 12))]
    other = words[:100] + [f"o{rng.randrange(10**6)}" for _ in range(100)]
    rows += [(300 + k, edited(other, 1, rng)) for k in range(40)]
    rows += [(None, edited(words, 1, rng)), (None, edited(other, 1, rng)), (None, "a text of its own without an id"), (7, "the id of another text")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = sorted(slow_keep([(i, t) for i, t in rows[:-4]]) + [7])
    left = simhash.stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == want
    assert [r.text for r in left if r.doc_id is None] == ["a text of its own without an id"]


def test_sieve_lets_through_all_that_it_holds(spark):
    from claimloom.llm.common import sieve, sifted

    every = spark.range(0, 40_000).select((F.col("id") * 7919 - 5).alias("id"))
    marked = sifted(every, "id", sieve(every.where("id % 10 = 0"), "id"))
    rows = {r.id: r.maybe for r in marked.collect()}
    assert len(rows) == 40_000 and all(rows[i] for i in rows if i % 10 == 0) and sum(rows.values()) < 4200
