import hashlib
from collections import defaultdict

from claimloom.llm import line_dedup
from tests.llm import cases


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def slow(rows, least=20, docs=3):
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least and doc_id is not None:
                held[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(held[key(x)]) < docs or doc_id == max(held[key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in cases.ROWS]
    want = sorted(slow(rows), key=str)
    found = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in line_dedup.dedup_lines(cases.documents(spark)).collect()), key=str)
    assert found == want
    assert {r[2] for r in found if r[0] in (9, 10)} == {1}
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.op9_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert found == {(a, b, c, hashlib.sha256(t.encode()).hexdigest()) for a, b, c, t in slow(rows)}


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(k, "A line that is long enough to count\nown", "x", 5.0) for k in range(4)], "doc_id long, text string, n_lines string, n_dropped double")
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(0, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 0)]
