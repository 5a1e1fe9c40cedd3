import base64
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.llm import byte_bpe
from tests.llm import cases

tiktoken = pytest.importorskip("tiktoken")


def library(path, pattern):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def both():
    path, pattern = byte_bpe.default_path(), byte_bpe.default_pattern()
    return byte_bpe.Ranks(open(path, "rb").read(), pattern), library(path, pattern)


ODD = [r[1] or "" for r in cases.ROWS] + ["<|endoftext|> x", "ab" * 3000, "\x1c\x1d \x85  ", "'s 'S it's '", "１２ ½ Ⅷ", "a" * 3000 + " " * 500 + "!" * 700, "日本" * 900]


@pytest.mark.parametrize("text", ODD)
def test_same_ids_as_the_library(both, text):
    import numpy as np

    own, lib = both
    ids = np.frombuffer(own.ids(text), np.int32).tolist()
    assert ids == lib.encode_ordinary(text) and own.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    own = byte_bpe._built(open(byte_bpe.default_path(), "rb").read(), byte_bpe.default_pattern())
    lib = test_any_text.lib = getattr(test_any_text, "lib", None) or library(byte_bpe.default_path(), byte_bpe.default_pattern())
    assert [i for p in own.pieces(text) for i in own.merge(p.encode())] == lib.encode_ordinary(text)


def test_chunks_give_the_same_ids(spark, both):
    """Chunks of 40 code points that overlap by 20: words, runs longer than an overlap or than many chunks, runs at every offset."""
    rng = random.Random(5)
    made = ["".join(rng.choice(["a", "b ", " ", "é", "'re", "'", "1", "!?", "\n", "x" * rng.randint(1, 90), " " * rng.randint(1, 60)]) for _ in range(rng.randint(1, 90))) for _ in range(150)]
    texts = [*made, *made[:5], *(t[:2000] for t in ODD), "y" * 5000, "y" * 5000, "z" * 999 + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key_", F.lit(1)).withColumn("KEY", F.lit("k"))
    got = {r.doc_id: r.ids for r in byte_bpe.encode(docs, chunk=40, overlap=20).collect()}
    assert got == {k: both[1].encode_ordinary(t) for k, t in enumerate(texts)}


def test_neighbours_that_agree_on_a_wrong_place(spark, both):
    """Digits in threes: two chunks may both be out of step, and alike; only what is stitched from the text's start counts."""
    pattern = r"\p{N}{1,3}|[^\p{N}]+"
    lib = library(byte_bpe.default_path(), pattern)
    texts = ["1234567890" * 40, "a" + "1234567890" * 40, "ab" + "12345" * 90 + " x " + "9" * 333]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (40, 41, 42, 45):
        got = {r.doc_id: r.ids for r in byte_bpe.encode(docs, pattern=pattern, chunk=chunk, overlap=30).collect()}
        assert got == {k: lib.encode_ordinary(t) for k, t in enumerate(texts)}


def test_tables(spark):
    docs = cases.documents(spark).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = byte_bpe.decode(byte_bpe.encode(docs, chunk=4000)).collect()
    assert len(rows) == len(cases.ROWS) and all(bytes(r.decoded) == (r.text or "").encode() and r.key in (None, "k") for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(cases.empty(spark))).count() == 0
    assert bytes(byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().decoded) == b""


def test_query(spark, both):
    sf = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = both[1].encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(both[1].decode_bytes(ids)).hexdigest()))
    assert {tuple(r) for r in byte_bpe.op12_byte_bpe(spark, sf).collect()} == want


def test_other_vocabularies_and_patterns(tmp_path, both):
    for pattern in (r"(?<=a)b", r"\bx", r"^a", r"a|\Ab", r"[a\S]"):
        with pytest.raises(ValueError):
            byte_bpe.python_pattern(pattern)
    with pytest.raises(ValueError):
        byte_bpe.Ranks(base64.b64encode(b"a") + b" 0\n", byte_bpe.default_pattern()).merge(b"ab")
    byte_bpe_memo = byte_bpe.MEMO_CHARS
    try:
        byte_bpe.MEMO_CHARS = 5
        own = byte_bpe.Ranks(open(byte_bpe.default_path(), "rb").read(), byte_bpe.default_pattern())
        assert [own.ids(t) for t in ODD] == [both[0].ids(t) for t in ODD]
    finally:
        byte_bpe.MEMO_CHARS = byte_bpe_memo
