import re

import pytest

import corpus_pipeline as C
from scoreflow.llm import decontamination as D
from scoreflow.llm import language_id as L
from scoreflow.llm import secret_scan as S
from tests.llm.conftest import DOCUMENTS, SF
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_secret_scan import brute_base
from tests.llm.test_simhash import brute_components, brute_fingerprint, near


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = C.table(spark, SF, "documents"), []
    for name, f in C.STAGES:
        before, docs = docs, C.written(f(spark, docs, SF), name)
        out.append((before, docs))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_stage_keeps_clean_documents(stages):
    before, after = map(rows, stages[0])
    gone = set(before) - set(after)
    assert not gone or all(not re.search(r"[^\W\d_]{3}", before[i]["text"]) for i in gone)
    assert all(tuple(after[i]) == tuple(before[i]) for i in after) and stages[0][1].columns == C.COLUMNS


def test_one_document_of_each_group_stays(stages):
    before, after = map(rows, stages[1])
    ids = sorted(before)
    fps = [brute_fingerprint(before[i]["text"]) for i in ids]
    assert sorted(after) == sorted({ids[c] for c in brute_components(fps, near)})
    assert all(tuple(after[i]) == tuple(before[i]) for i in after)


def test_leaks_go(spark, stages):
    before, after = map(rows, stages[2])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaky = {d for d, *_ in brute_leaks([(i, r["text"]) for i, r in before.items()], items)}
    assert leaky and set(after) == set(before) - leaky


def test_secrets_are_masked(stages):
    before, after = map(rows, stages[3])
    assert set(before) == set(after)
    changed = 0
    for i, r in before.items():
        base = brute_base(r["text"])
        assert not brute_base(after[i]["text"]) or not base
        if base:
            changed += 1
            assert "[SECRET]" in after[i]["text"] and after[i]["n_chars"] == len(after[i]["text"])
        assert all(r["text"][a:b] not in after[i]["text"] for a, _, b in base)
    assert changed > 5


def test_tokens_decode_exactly(stages):
    before, after = map(rows, stages[4])
    assert set(before) == set(after) and all(r["exact"] for r in after.values())


def test_run_equals_its_stages(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1].collect()))


def test_odd_documents_pass_every_stage(spark):
    text = "the that of and with by are is on for " * 3
    odd = [(None, text), (None, None), (1, None), (2, ""), (3, "123 456"), (4, text), (4, text), (5, text + "secret=abcdef123"), (6, "ok"),
           (7, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in odd], DOCUMENTS + ", lang_pred string")
    for name, f in C.STAGES:
        for d in (docs, docs.limit(0)):
            assert f(spark, d, SF).count() <= len(odd)
        docs = C.written(f(spark, docs, SF), name)
    assert {r["doc_id"] for r in docs.collect()} >= {4, 6, 7}


def test_names():
    assert [n for n, _ in C.STAGES] == ["language_id", "simhash_near_dedup", "decontamination", "secret_scan", "sentencepiece"]
    assert C.ORACLE_SQL is None and D.THRESHOLD == 0.8 and L.UNDETERMINED == "und" and S.FDR == 0.01
