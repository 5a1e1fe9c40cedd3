import hashlib
import random
import re

from claimloom.llm import pii
from tests.llm import cases

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def slow(text):
    text, out = text or "", []
    for k, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else None, "card": 12 <= len(d) <= 19 and luhn(d) if d else False, "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def texts():
    rng = random.Random(8)
    out = [r[1] for r in cases.ROWS]
    for n in (5, 40, 300):
        out += ["".join(rng.choice("0123456789  -.+()@ab_é\n12.+") for _ in range(n)) for _ in range(120)]
    out += ["a@b.c_d@e.f", "x@y.zz.x@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255", "4111 1111-1111 1111", "+1 (212) 555-0100.", "é" * 9 + " jo@ex.com", "1-" * 9000 + "1", "9" * 5000, "a" * 20_000, "x@y.z " * 1000]
    return out


def test_base_spans(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.base for r in pii.spans(docs, pii.boosting.Trees(), dict.fromkeys(pii.KINDS, 2.0)).collect()}
    for doc_id, text in rows:
        assert [f"{pii.KINDS[s.k]}:{s.st}:{s.en}" for s in found[doc_id]] == slow(text), text


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in pii.op6_pii(spark, "/root/testdata/sf0.001").collect():
        want = slow(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in pii.BASE_KINDS]
        assert set(want) <= set(filter(None, r.spans.split(","))) and r.n_added == len(list(filter(None, r.spans.split(",")))) - len(want)


def test_the_method_adds_what_looks_alike(spark):
    rng = random.Random(3)
    rows = []
    for k in range(800):
        a, b, c = rng.randrange(100, 999), rng.randrange(100, 999), rng.randrange(1000, 9999)
        rows.append((k, f"please call +1 ({a}) {b}-{c} today, order {rng.randrange(10**13, 10**14)} of 2020.{b}.{a}.{c} is late"))
    rows += [(1000 + k, f"please call (212) {100 + k}-4567 today") for k in range(20)] + [(2000, "nothing here 12.50 and 3-4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, thresholds = pii.learn(docs)
    assert thresholds["phone"] <= 1 and thresholds["email"] == 2.0
    found = {r.doc_id: r for r in pii.spans(docs, model, thresholds).collect()}
    assert sum(len(found[1000 + k].added) == 1 for k in range(20)) >= 18
    assert sum(len(found[k].added) for k in range(800)) == 0
    assert not found[2000].added and not found[2000].base
    redacted = {r.doc_id: r.redacted for r in pii.redact(docs, model, thresholds).collect()}
    assert redacted[1000] == "please call [phone] today" and redacted[2000] == rows[-1][1]


def test_tables(spark):
    model, thresholds = pii.learn(cases.empty(spark))
    assert pii.spans(cases.empty(spark), model, thresholds).count() == 0
    assert pii.spans(cases.documents(spark), model, thresholds).count() == len(cases.ROWS)


NONE = dict.fromkeys(pii.KINDS, 2.0)


def slow_redact(text, spans):
    out, end = "", 0
    for st, k, en in sorted(spans):
        if st >= end:
            out += text[end:st] + f"[{pii.KINDS[k]}]"
        end = max(end, en)
    return out + text[end:]


def test_redaction_is_by_row(spark):
    """Rows without an id, rows that share one, clashing columns, spans that overlap, very long texts: nothing leaks, no row goes."""
    rows = [(None, "mail jo@ex.com now", "a", 1), (None, "no id, +1 (212) 555-0100 and +1 (212) 555-0100", "b", 2), (1, "first a@b.cc", "c", 3), (1, "a longer text before x@y.zz", "d", 4), (2, None, "e", 5)]
    rows += [(3, "é\x01 jo@ex.com x +12345678901 y 4111 1111 1111 1111 z 10.0.0.1 " * 900, "f", 6), (4, "id 4111 1111 1111 1111@x.y", "g", 7), (5, "", "h", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, redacted string, base int")
    got = pii.redact(docs, pii.boosting.Trees(), NONE).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "text", "base", "redacted"]
    found = {r.redacted for r in got}
    place = {k: n for n, k in enumerate(pii.KINDS)}
    assert found == {slow_redact(t or "", [(int(s.split(":")[1]), place[s.split(":")[0]], int(s.split(":")[2])) for s in slow(t)]) for _, t, _, _ in rows}
    assert not any("@" in r or "4111" in r for r in found)


def test_many_spans_beside_many_candidates(spark):
    text = "call (212) 555-0100 or +1 (212) 555-0100, 1.2.3.4 " * 3000
    seen = pii.found(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id").first()
    assert len(seen.base) == 6000
    assert {(m.touch > 0) for m in seen.more if m.c.st % 50 < 20} == {False}
    spans_ = [(c.st, c.en) for c in seen.base]
    for m in seen.more[::97]:
        assert (m.touch > 0) == any(a < m.c.en and m.c.st < b for a, b in spans_)


def test_secrets(spark):
    rng = random.Random(5)
    digest = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(k, f'the token = "{digest(40)}" of it') for k in range(60)] + [(100 + k, f"key AKIA{''.join(rng.choice('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') for _ in range(16))} there") for k in range(60)]
    rows += [(200 + k, f"see page{k}-of-the-2nd-manual-part or Section = chapter{k}and") for k in range(60)] + [(300 + k, f"password={digest(18)} and more") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, thresholds = pii.learn(docs)
    found = {r.doc_id: r.added for r in pii.spans(docs, model, thresholds).collect()}
    text = dict(rows)
    assert thresholds["secret"] <= 1
    right = [i for i, _ in rows if not 200 <= i < 260]
    assert sum(len(found[i]) > 0 for i in right) >= 0.95 * len(right)
    assert sum(len(found[i]) > 0 for i in text if 200 <= i < 260) == 0
    assert all(text[i][s.st : s.en].strip("\"=") in text[i] and s.en - s.st >= 16 for i in right for s in found[i])


def test_planted_documents_have_a_span(spark):
    """On sf0.1 every document that holds a planted token has a span, and what is added is a secret or holds a check."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    rows = {r.doc_id: r for r in pii.op6_pii(spark, "/root/testdata/sf0.1").collect()}
    assert rows.keys() == docs.keys()
    planted = [i for i, t in docs.items() if re.search(r"(?i)token = \"[0-9a-f]{40}\"", t)]
    assert len(planted) > 100 and sum(rows[i].has_span and rows[i].n_secret > 0 for i in planted) >= 0.97 * len(planted)
    clean = [i for i, t in docs.items() if not re.search(r"[0-9@]{3}|@", t)]
    assert len(clean) > 5000 and not any(rows[i].has_span for i in clean)
