import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimloom.llm import bpe
from tests.llm import cases

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    path = bpe.default_path()
    own = bpe.Bpe(open(path, encoding="utf-8").read())
    return own, tokenizers.Tokenizer.from_file(path)


@pytest.mark.parametrize("text", [r[1] or "" for r in cases.ROWS] + ["<|endoftext|><|endoftext|> x", "ab" * 3000, "\x1c\x1d \x85  ", "'s 'S it's '", "１２ ½ Ⅷ"])
def test_same_ids_as_the_library(both, text):
    own, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    n, sha, decoded = own.digest(text)
    assert (n, sha) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert decoded == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    path = bpe.default_path()
    own = bpe._built(open(path, encoding="utf-8").read())
    library = test_any_text.library = getattr(test_any_text, "library", None) or tokenizers.Tokenizer.from_file(path)
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids and own.decode(ids) == text


def test_tree_names_the_leftmost_lowest():
    tree = bpe.PairTree([rank << bpe.SHIFT | place for place, rank in enumerate([5, 3, 9, 3, 8])])
    assert tree.root() == 1
    tree.put(1, bpe.NEVER)
    assert tree.root() == 3
    tree.put(3, 7 << bpe.SHIFT | 3)
    assert tree.root() == 0
    for place in range(5):
        tree.put(place, bpe.NEVER)
    assert tree.root() is None


def test_tables(spark):
    rows = {r.doc_id: r for r in bpe.digests(cases.documents(spark)).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == 0
    assert rows[6].n_tokens == rows[7].n_tokens > 30_000
    assert bpe.digests(cases.empty(spark)).count() == 0
    again = bpe.decode(bpe.encode(cases.documents(spark))).collect()
    assert all(r.decoded == (r.text or "") for r in again)


def test_clashing_columns_and_null_ids(spark):
    from pyspark.sql import functions as F

    docs = cases.documents(spark).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert all(r.decoded == (r.text or "") and r.key in (None, "k") for r in rows) and len(rows) == len(cases.ROWS)
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first().decoded == ""


def test_small_memory_and_other_vocabularies(monkeypatch):
    import json

    content = open(bpe.default_path(), encoding="utf-8").read()
    own = bpe.Bpe(content)
    want = [own.digest(r[1]) for r in cases.ROWS]
    monkeypatch.setattr(bpe, "MEMO_CHARS", 5)
    assert [bpe.Bpe(content).digest(r[1]) for r in cases.ROWS] == want
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}):
        with pytest.raises(ValueError):
            bpe.refuse(json.loads(content) | change)
    stated = json.loads(content)
    stated["model"]["ignore_merges"] = True
    with pytest.raises(ValueError):
        bpe.refuse(stated)


def test_short_pieces_need_no_tree(both, monkeypatch):
    import random

    own, library = both
    draw = random.Random(4)
    words = ["".join(draw.choice(letters) for _ in range(n)) for letters in ("etaoin", "aé'ß", "日本語𝒳", "ab") for n in range(1, bpe.FLAT + 1)]
    short, long = [w for w in words if len(w.encode()) <= bpe.FLAT], [w for w in words if len(w.encode()) > bpe.FLAT]
    want = [own.merge(w.encode()) for w in long]
    monkeypatch.setattr(bpe, "FLAT", 1)
    trees = [own.merge(w.encode()) for w in short]
    monkeypatch.setattr(bpe, "FLAT", 1000)
    assert [own.merge(w.encode()) for w in long] == want
    monkeypatch.undo()
    monkeypatch.setattr(bpe, "PairTree", None)
    assert [own.merge(w.encode()) for w in short] == trees
    assert all(own.encode(w) == library.encode(w, add_special_tokens=False).ids for w in short)
