import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow.llm import language_id as L
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return L.train(d.where(~L.held_out("doc_id")).select("doc_id", "text", "lang"))


def test_held_out_accuracy(spark):
    got = L.op2_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    r = got.join(truth, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert r[0] >= 0.98 and r[1] > 200 and 0 <= r[2] and r[3] <= 1
    assert got.count() == truth.count()


def test_masks_hold_every_language_of_an_ngram(model):
    # a Bloom filter has no false negatives: whatever was added is found, for all its languages at once
    h = L.mix64(np.arange(500, dtype=np.uint64))
    words = np.zeros((1, 1 << 12), np.uint64)
    member = (np.arange(500) % 7 + 1).astype(np.uint64)
    for p in L.probes(h, 1 << 12):
        np.bitwise_or.at(words[0], p, member)
    found = L.Model(["a", "b", "c"], words).masks(h)[0]
    assert ((found & member) == member).all()


def test_correction_for_false_positives():
    rng = np.random.default_rng(1)
    words = np.zeros((1, 1 << 10), np.uint64)
    for p in L.probes(L.mix64(rng.integers(0, 1 << 60, 300).astype(np.uint64)), 1 << 10):
        words[0][p] |= np.uint64(1)
    m = L.Model(["a", "b"], words)
    assert m.fp[0] > 0.05 and m.fp[1] == 0
    h = L.mix64(rng.integers(0, 1 << 60, 20000).astype(np.uint64))
    assert abs((m.masks(h)[0] & np.uint64(1)).mean() - m.fp[0]) < 0.02


def test_defined_cases(spark, model):
    texts = [None, "", "12 34 !?", "é", "De.", "the " * 50_000, "the that of", "the that of"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("x"))
    got = {r["doc_id"]: r for r in L.identify(d, model, ["doc_id"]).collect()}
    assert [got[i]["lang_pred"] for i in range(3)] == ["und"] * 3 and got[0]["score"] == 0.0
    assert all(got[i]["lang_pred"] in model.langs for i in range(3, 8))
    assert got[6][1:] == got[7][1:]
    assert L.identify(d.limit(0), model, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in L.identify(d, None, ["doc_id"]).collect()} == {"und"}


def test_training_on_nothing(spark):
    d = spark.createDataFrame([(1, None, "en"), (None, "text", "en"), (2, "text", None)], "doc_id long, text string, lang string")
    assert L.train(d) is None


def test_grams_stay_in_their_text():
    h, own, has = L.grams(["the cat", "", "THE", "a 1"])
    alone = [sorted(L.grams([t])[0].tolist()) for t in ("the cat", "", "THE", "a 1")]
    assert [sorted(h[own == i].tolist()) for i in range(4)] == alone
    assert has.tolist() == [True, False, True, True] and len(alone[1]) == 0
    assert set(alone[2]) <= set(alone[0])  # letters in either case, same word


@pytest.mark.parametrize("n", [70])
def test_more_languages_than_a_word_has_bits(n):
    words = np.zeros((2, 1 << 10), np.uint64)
    h = L.mix64(np.arange(5, dtype=np.uint64))
    for p in L.probes(h, 1 << 10):
        words[1][p] |= np.uint64(1 << 5)
    m = L.Model([f"l{i}" for i in range(n)], words)
    assert (m.masks(h)[1] >> np.uint64(5) & np.uint64(1)).all() and not m.masks(h)[0].any()
