import numpy as np
import pytest

from scoreflow.llm import token_counts as T
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.load_ranks())


def brute(enc, text, rule):
    """Token by token and byte by byte."""
    data = (text or "").encode()
    cuts = T.sentence_sections(data)
    section = [i for i in range(len(cuts) - 1) for _ in range(cuts[i], cuts[i + 1])]
    count, at = [0.0] * (len(cuts) - 1), 0
    for i in enc.encoding.encode_ordinary(text or ""):
        n = len(enc.encoding.decode_single_token_bytes(i))
        held = {}
        for s in section[at:at + n]:
            held[s] = held.get(s, 0) + 1
        at += n
        if rule == "share":
            for s, c in held.items():
                count[s] += c / n
        elif rule == "start":
            count[min(held)] += 1
        else:
            count[max(held, key=lambda s: (held[s], -s))] += 1
    return count


TEXTS = [None, "", "One. Two! Three? four\n\n\nfive", "é☃. 😀! x", "a.b.c", "...", "no marks at all", "x.  " * 300, "dup. dup", "dup. dup", ". " * 9]


@pytest.mark.parametrize("rule", T.RULES)
def test_rules_against_brute_force(spark, documents, encoder, rule):
    df = documents(list(enumerate(TEXTS)))
    got = {}
    for r in T.section_tokens(df, ["doc_id", "score"], rule=rule).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = r
    for i, t in enumerate(TEXTS):
        rows = [got[i][k] for k in sorted(got[i])]
        assert np.allclose([r["n_tokens"] for r in rows], brute(encoder, t, rule))
        text = t or ""
        assert [r["start"] for r in rows] == [0] + [r["end"] for r in rows][:-1] and rows[-1]["end"] == len(text)
    assert T.section_tokens(df.limit(0), ["doc_id"]).count() == 0


def test_query_adds_up_to_whole_documents(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sums, crossing = {}, 0
    for r in T.op8_token_counts(spark, SF).collect():
        sums[r["doc_id"]] = sums.get(r["doc_id"], 0) + r["n_tokens"]
        crossing += r["n_crossing"] > 0
    assert sums == {r["doc_id"]: len(encoder.encoding.encode_ordinary(r["text"])) for r in docs} and crossing > 1000


def test_tokens_over_three_sections():
    tokens, sections = np.array([0, 10, 12]), np.array([0, 2, 9, 12])
    assert [T.attribute(tokens, sections, r)[0].tolist() for r in ("start", "majority")] == [[1, 0, 1], [0, 1, 1]]
    assert np.allclose(T.attribute(tokens, sections, "share")[0], [0.2, 0.7, 1.1])
    assert T.attribute(tokens, sections)[1].tolist() == [1, 1, 1]


def test_unknown_rule(documents):
    with pytest.raises(ValueError):
        T.section_tokens(documents([(1, "a")]), ["doc_id"], rule="other")


def test_a_long_text(spark, documents):
    r = T.section_tokens(documents([(1, "word and word. " * 20_000)]), ["doc_id"]).collect()
    assert len(r) == 20_000 and len({x["n_tokens"] for x in r[1:-1]}) == 1
