import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from claimloom.llm import mixing, quality
from claimloom.llm.common import DOCUMENT
from tests.llm import cases
from tests.llm.test_line_dedup import slow as slow_lines
from tests.llm.test_mixing import slow_targets
from tests.llm.test_near_copies import slow_keep

SF = "/root/testdata/sf0.001"


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def slow_mix(docs):
    """(doc_id, text) as often as the mix takes them, from rows (doc_id, text, source): one running sum for each source."""
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += words(text)
    targets = slow_targets(dict(sizes))
    out = []
    for source, size in sizes.items():
        start = int(hashlib.md5((source or "").encode()).hexdigest()[:6], 16) % mixing.STEPS / mixing.STEPS
        order = lambda i, t: hashlib.md5(f"{'' if i is None else i}|{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()
        own = sorted((words(t) * mixing.LARGE <= size, -math.isqrt(words(t)), order(i, t), words(t), i, t) for i, t, s in docs if s == source)
        total, taken, left, rate = start, 0, sum(r[3] for r in own), 0.0
        for is_rest, _, _, n, i, t in own:
            if not is_rest:
                owed, after = targets[source] - taken, left - n
                # the choices of copies, by how far off the source must end whatever the rest does, then by the integers crossed
                crossed = math.floor(total + min(3.0, max(0.0, owed / left)))
                miss = lambda k: max(0.0, k * n - owed, owed - k * n - 3 * after)  # noqa: E731, B023
                least = min(miss(k) for k in range(4))
                copies = min((k for k in range(4) if miss(k) <= least + 1e-9 * size), key=lambda k: (abs(k - crossed), k))
                total, taken, left = total + min(3.0, max(0.0, owed / left)) - crossed, taken + copies * n, after
                out.extend([(i, t)] * copies)
        if left:
            rate = max(0.0, min(3.0, (targets[source] - taken) / left))
        for k, (_, _, _, _, i, t) in enumerate([r for r in own if r[0]], 1):
            out.extend([(i, t)] * min(3, math.floor(total + k * rate) - math.floor(total + (k - 1) * rate)))
    return out


def test_pipeline_against_brute_force(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from claimloom.llm.bpe import default_path

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = {r.doc_id for r in quality.op3_quality(spark, SF).collect() if r.kept}
    docs = [(r.doc_id, r.text, r.source) for r in rows if r.doc_id in kept]
    cleaned = {i: t for i, _, _, t in slow_lines([(i, t) for i, t, _ in docs])}
    docs = [(i, cleaned[i], s) for i, _, s in docs if words(cleaned[i])]
    keep = set(slow_keep([(i, t) for i, t, _ in docs]))
    library = tokenizers.Tokenizer.from_file(default_path())
    want = Counter()
    for i, text in slow_mix([d for d in docs if d[0] in keep]):
        ids = library.encode(text, add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert found == want and len(want) > 50


def test_stages_keep_the_columns_and_take_awkward_rows(spark):
    for docs in (cases.documents(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == DOCUMENT, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_near_dedup_leaves_one_of_repeated_rows(spark):
    from claimloom.llm import simhash

    left = simhash.stage(spark, cases.documents(spark), SF).collect()
    assert sorted(r.doc_id for r in left if r.doc_id in (1, 2, 3, 6, 7)) == [1, 6]
    assert sum(r.doc_id is None for r in left) == 1


def test_quality_stage_judges_rows_without_an_id(spark):
    good = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id in (1, 2)").collect()
    rows = [(None, good[0].text), (None, "bad"), (5, good[1].text), (5, "bad")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r.doc_id, r.text) for r in quality.stage(spark, docs, SF).collect()} == {rows[0], rows[2]}


def test_run_leaves_one_table(spark, tmp_path, monkeypatch):
    from claimloom.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [p.name.split("-")[0] for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["mixing"]
