import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimloom.llm import alignment
from tests.llm import cases

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    import sentencepiece

    a = tokenizers.Tokenizer.from_file(alignment.default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_model())


def slow(texts, both):
    """(n_a, n_b, n_groups, n_links, n_overlaps, groups, n_best, count_sum) of each text, token by token."""
    a, b = both
    decode = tokenizers.decoders.ByteLevel()
    symbols = {s: bytes([k]) for k, s in enumerate(alignment_symbols())}
    rows, links = [], []
    for text in texts:
        rows.append([0, 0, 0, 0, 0, ""])
        links.append([])
        if not text:
            continue
        left = [(i, b"".join(symbols[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, alignment.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
        if not (b"".join(t for _, t in left) == b"".join(t for _, t in right) == (" " + text).encode()):
            continue
        spans = [[], []]
        for of, tokens in zip(spans, (left, right), strict=True):
            at = 0
            for i, t in tokens:
                of.append((at, at + len(t), i))
                at += len(t)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, last = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, f, i in of if last < f <= e) for of in spans))
            last = e
        links[-1] = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[1] == y[1]] if len(left) < 300 else [(next(i for s, f, i in spans[0] if f == e), next(i for s, f, i in spans[1] if f == e)) for e in ends]
        n_over = len(left) + len(right) - len(ends)
        rows[-1] = [len(left), len(right), len(groups), len(links[-1]), n_over, ";".join(groups)]
    count = Counter(p for of in links for p in of)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    assert decode
    return [(*r, sum(count[p] == most[p[1]] for p in of), sum(count[p] for p in of)) for r, of in zip(rows, links, strict=True)]


def alignment_symbols():
    from claimloom.llm.bpe import byte_symbols

    return byte_symbols()


def aligner():
    return alignment.Aligner(open(alignment.default_path(), encoding="utf-8").read(), open(alignment.default_model(), "rb").read(), alignment.default_pattern())


def found(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_overlaps, r.groups, r.n_best, r.count_sum) for r in df.collect()}


def test_awkward_documents(spark, both, tmp_path):
    texts = [r[1] if r[1] is None or len(r[1]) < 6000 else r[1][:3000] for r in cases.ROWS]
    texts += ["<|endoftext|> <s> <unk> ▁ <0x41>", "  two  blanks ", "tab\tnew\nline", "é" * 40, "日本語テキスト 🙂🙂", " lead", "a", " ", "x" * 300, "a b", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("shard", F.lit(1)).withColumn("n_a", F.lit("x")).withColumn("own", F.lit("kept"))
    aligned = alignment.align(docs, texts=True)
    aligned.write.parquet(str(tmp_path / "a"))
    got = alignment.scored(spark.read.parquet(str(tmp_path / "a")))
    assert found(got) == dict(enumerate(slow(texts, both))) and {r.own for r in got.select("own").collect()} == {"kept"}
    assert alignment.scored(alignment.align(cases.empty(spark))).count() == 0


def test_small_blocks_and_shards(spark, both, monkeypatch):
    """Texts cut into parts of a few tokens, documents dealt to shards of a few pairs."""
    rng = random.Random(3)
    words = ["the", "Haus", "straße", "été", "3.14", "—", "naïve", "\n", "ing", "日本", "don't", "xq", "zzz"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", 7)
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 5)
    own = aligner()
    columns = alignment.Rows(own, True).of([own.tokens(t) for t in texts])
    want = slow(texts, both)
    assert [tuple(c[k].as_py() for c in (*columns[:5], columns[6])) for k in range(len(texts))] == [w[:6] for w in want]
    assert [c.as_py() for c in columns[5]] == [hashlib.sha256(w[5].encode()).hexdigest() if w[5] else "" for w in want]
    assert len(set(columns[7].to_pylist())) > 20
    rows = [(k, *(c[k].as_py() for c in columns)) for k in range(len(texts))]
    aligned = spark.createDataFrame(rows, f"doc_id long, {alignment.ALIGNED}")
    assert found(alignment.scored(aligned)) == dict(enumerate(want))


def test_query(spark, both):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = {r.doc_id: (*w[:4], w[6], w[7], hashlib.sha256(w[5].encode()).hexdigest() if w[5] else "") for r, w in zip(docs, slow([r.text for r in docs], both), strict=True)}
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in alignment.op13_alignment(spark, sf).collect()}
    assert got == want and any(w[0] for w in want.values())


def test_vocabularies_of_the_same_bytes(both):
    own = aligner()
    assert alignment.piece_bytes("<0x0A>") == b"\n" and alignment.piece_bytes("▁a") == b" a" and alignment.piece_bytes("<0x0A") == b"<0x0A"
    for text in ("a\x00b", "Grüße", "x" * 5000):
        a, _ = own.tokens(text)
        assert a.tolist() == (both[0].encode(" " + text, add_special_tokens=False).ids if len(a) else [])


def test_every_token_is_one_token(both):
    """What the ranks give for the bytes of a token is what merging gives."""
    own = alignment.Bpe(open(alignment.default_path(), encoding="utf-8").read())
    ranks = alignment.ranks(own)
    assert all(own.merge(token) == [k] for token, k in ranks.items())
    own.made = own.made[::-1]
    with pytest.raises(ValueError):
        alignment.ranks(own)
