import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow.llm import sentencepiece_viterbi as V
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def pieces():
    return V.Pieces(V.load_pieces())


def ids(p, text):
    return np.frombuffer(p.encode([text])[0], "<i4").tolist()


def test_against_the_library(pieces, duck):
    """The library's own search over the same pieces and scores (a unigram model) finds the same sum."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    table = V.load_pieces()
    m = pb.ModelProto()
    with open(V.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    for i, p in enumerate(m.pieces):
        if table[i][1] is not None:
            p.score = table[i][1]
    m.trainer_spec.model_type = 1
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    texts = [r[0] for r in duck.sql("select text from documents order by doc_id limit 60").fetchall()]
    texts += ["hello  world", " a", "naïve café ☃ 😀", "x" * 40, "\n\t12,345"]
    same = 0
    for t in texts:
        mine, theirs = ids(pieces, t), lib.encode(t)
        score = lambda x: sum(table[i][1] or 0 for i in x)
        assert abs(score(mine) - score(theirs)) < 1e-3 * max(1, len(mine)) and len(mine) <= len(theirs) + 2
        same += mine == theirs
    assert same >= 0.9 * len(texts)


def test_against_every_split(pieces):
    table = {p: (i, s) for i, (p, s, _) in enumerate(V.load_pieces()) if s is not None}
    for word in ["▁the", "▁token", "▁abc12", "▁☃a", "▁▁▁x"]:
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, a = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(word[a:i])
                    a = i
            parts.append(word[a:])
            if all(p in table or len(p) == 1 for p in parts):
                best = max(best, sum(table[p][1] if p in table else pieces.unknown for p in parts))
        by_id = dict(table.values())
        got = np.frombuffer(pieces.search([word])[0], "<i4").tolist()
        odd = sum(c not in table for c in word)
        assert abs(sum(by_id.get(i, 0) for i in got) + odd * pieces.unknown - best) < 1e-6


def test_units_of_one_length_advance_together(pieces):
    words = ["▁cat", "▁dog", "▁the", "▁☃☃x", "▁▁ab"[:4]]
    assert pieces.search(words[:3]) == [pieces.search([w])[0] for w in words[:3]]
    assert V.units("a  b c ") == ["a", "▁▁b", "c", "▁"] and V.units("") == V.units(None) == []
    assert V.units("a b") == ["a", "b"]


def test_round_trip(spark, documents):
    texts = [None, "", " ", "  ", "a", " lead", "trail ", "two  spaces", "tab\tline\n", "☃😀é\u0301", "x" * 3000, "word " * 40_000, "a▁b", "dup", "dup"]
    df = documents(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in V.round_trip(df).collect()}
    assert len(got) == len(texts) and all(r["exact"] for r in got.values())
    assert got[0]["n_tokens"] == got[1]["n_tokens"] == 0
    assert got[13]["ids_sha256"] == got[14]["ids_sha256"]
    enc = V.encode(df, ["doc_id", "score"])
    dec = {r["doc_id"]: r["text"] for r in V.decode(enc, ["doc_id"]).collect()}
    assert [dec[i] for i in range(len(texts))] == [(t or "").replace("▁", " ") for t in texts]
    assert V.round_trip(df.limit(0)).count() == 0


def test_query_is_exact_on_all_documents(spark):
    r = V.op5_sentencepiece(spark, SF).agg(F.count("*"), F.sum(F.col("exact").cast("int")), F.min("n_tokens")).first()
    assert r[0] == r[1] == 1000 and r[2] > 0
