import numpy as np
import pytest
import xxhash

from claimloom.llm import simhash
from tests.llm import cases


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, radius):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


@pytest.mark.parametrize("text", [r[1] for r in cases.ROWS])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 1 << 63, size=max(2, n // 12), dtype=np.uint64)
    codes = centers[rng.integers(0, len(centers), n)]
    for _ in range(3):
        codes = codes ^ np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
    return np.unique(codes)


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_index_finds_every_pair(radius):
    codes = clustered(600)
    index = simhash.GrayIndex(codes, np.zeros(len(codes), dtype=np.uint64))
    found = {(int(index.codes[a]), int(index.codes[b])) for x, y in index.pairs(radius, 500) for a, b in zip(x, y, strict=True)}
    want = {(int(a), int(b)) for a in codes for b in codes if a < b and (int(a) ^ int(b)).bit_count() <= radius}
    assert {(min(p), max(p)) for p in found} == want


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("heavy", [20_000, 20])
def test_components(spark, monkeypatch, heavy):
    monkeypatch.setattr(simhash, "HEAVY", heavy)
    codes = [int(c) for c in clustered(900)]
    want = slow_components(codes, 3)
    fps = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    found = simhash.components(simhash.links(fps, 3)).collect()
    group = {simhash._signed(c): simhash._signed(c) for c in codes} | {r.node: r.root for r in found}
    same = {}
    for c in codes:
        same.setdefault(want[c], set()).add(group[simhash._signed(c)])
    assert all(len(s) == 1 for s in same.values()) and len({next(iter(s)) for s in same.values()}) == len(same)


def test_tables(spark):
    rows = {r.doc_id: r for r in simhash.near_duplicates(cases.documents(spark)).collect()}
    assert rows[1].fp == rows[2].fp == rows[3].fp == 0 and {rows[k].component_id for k in (1, 2, 3)} == {1}
    assert rows[6].component_id == rows[7].component_id == 6
    assert rows[None].component_id is None
    assert simhash.near_duplicates(cases.documents(spark)).count() == len(cases.ROWS)
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_blocks_grow_with_the_input():
    assert [simhash.plan_blocks(n, 3) for n in (10, 10**6, 10**9, 10**11)] == [4, 4, 5, 6]
    for blocks in (4, 5, 6):
        masks = simhash.bucket_masks(blocks, 3)
        rng = np.random.default_rng(1)
        for _ in range(300):
            flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(not flips & m for m in masks)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    fps = {r.doc_id: slow_fingerprint(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    of = slow_components(sorted(set(fps.values())), 3)
    low = {}
    for i, f in fps.items():
        low[of[f]] = min(i, low.get(of[f], i))
    want = {(i, f"{f:016x}", low[of[f]]) for i, f in fps.items()}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.op7_simhash(spark, sf).collect()} == want


def test_one_giant_component(spark):
    """A hub that thousands link to, and a chain: neither the stars nor the rounds have a bound."""
    edges = [(k, 0) for k in range(1, 4000)] + [(k + 1, k) for k in range(10_000, 10_400)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(found) == set(range(1, 4000)) | set(range(10_001, 10_401))
    assert all(root == (0 if node < 4000 else 10_000) for node, root in found.items())
