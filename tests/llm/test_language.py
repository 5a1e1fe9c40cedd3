import zlib

import regex
import zstandard
from pyspark.sql import functions as F

from claimloom.llm import language
from tests.llm import cases


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang").collect()}
    held = [(lang[r.doc_id], r.lang_pred, r.rejected) for r in language.op2_language(spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(a == b for a, b, _ in held) > 0.98 * len(held)
    sure = [(a, b) for a, b, no in held if not no]
    assert len(sure) > 0.95 * len(held) and sum(a == b for a, b in sure) > 0.985 * len(sure)


def test_tables(spark):
    docs = cases.documents(spark)
    model = language.learn(docs)
    assert set(model) == {"en", "de"} | ({"fr"} & set(model))
    rows = language.predict(docs, model).collect()
    assert len(rows) == len(cases.ROWS)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in rows if r.doc_id in (6, 7)} == {"en"}
    assert language.predict(cases.empty(spark), model).count() == 0
    assert language.learn(cases.empty(spark)) == {}
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}


def test_blocks_cover_the_whole_text():
    encoders = language.Encoders({"a": b"alpha beta gamma " * 50, "b": b"uno dos tres " * 50})
    short, long = encoders.sizes("uno dos tres"), encoders.sizes("uno dos tres " * 4000)
    assert long.sum() > 5 * short.sum()
    assert encoders.predict("alpha " * 100)[0] == "a" and encoders.predict("tres " * 100_000)[0] == "b"


def test_more_languages_than_get_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rows = [(k, f"words of language number {k % 5} {k}", f"l{k % 5}") for k in range(40)] + [(100 + k, "and one more text", "l4") for k in range(3)]
    assert set(language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))) == {"l0", "l1", "l4"}


def test_query_against_a_plain_scorer(spark):
    """Dictionaries and sizes worked out without the operator's code."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("h", F.xxhash64("doc_id")).collect()
    tidy = lambda t: (" " + regex.sub(r"[^\p{L}\p{M}]+", " ", t.lower()).strip() + " ").encode()
    parts = {}
    for d in sorted(docs, key=lambda d: d.h):
        if d.lang is not None and zlib.crc32(str(d.doc_id).encode()) % 5:
            raw = tidy(d.text)
            at = d.h % max(1, len(raw) - 1023)
            parts.setdefault(d.lang, []).append((d.h % 16, raw[at : at + 1024]))
    joined = {}
    for name, own in parts.items():
        of_salt = [0] * 16
        joined[name] = b"\n".join(raw for salt, raw in own if (of_salt.__setitem__(salt, of_salt[salt] + 1) or of_salt[salt] <= 10))
    settings = zstandard.ZstdCompressionParameters.from_level(6, strategy=zstandard.STRATEGY_FAST, min_match=5, write_checksum=False, write_content_size=False, write_dict_id=False)

    def size(name, raw):
        words = zstandard.ZstdCompressionDict(joined[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return sum(len(zstandard.ZstdCompressor(dict_data=words, compression_params=settings).compress(raw[at : at + 4096])) for at in range(0, len(raw), 4096))

    found = {r.doc_id: r.lang_pred for r in language.op2_language(spark, sf).collect()}
    assert len(found) == len(docs)
    for d in docs:
        if regex.search(r"\p{L}", d.text):
            sizes = {name: size(name, tidy(d.text)) for name in joined}
            least = min(sizes.values())
            assert found[d.doc_id] == min((n for n in sizes if sizes[n] == least), key=lambda n: (-len(joined[n]), n))
        else:
            assert found[d.doc_id] == "und"
