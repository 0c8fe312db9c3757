import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow.llm import toxicity as T

BIG = "/root/testdata/sf0.1"


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    got = T.op13_toxicity(spark, BIG).persist()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == 10_000
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert all(r["held_out"] == out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    for held in (True, False):
        mine = [r for r in rows if r["held_out"] == held]
        right = sum(r["predicted"] == 1 == r["toxic"] for r in mine)
        # the toxic texts that are missed (6 of 120 held out) were overwritten by junk and hold no abusive word
        assert right / sum(r["toxic"] for r in mine) >= 0.92
        assert right / sum(r["predicted"] for r in mine) >= 0.95
    mine = [r for r in rows if r["held_out"]]  # calibrated: mean score near the rate
    assert abs(np.mean([r["score"] for r in mine]) - np.mean([r["toxic"] for r in mine])) < 0.02


def corpus(n, seed=0, word="grubol"):
    rng = np.random.default_rng(seed)
    plain = ["lorem", "tesa", "mirun", "kolat", "paveri", "sindo"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choice(plain, 30).tolist()
        toxic = int(rng.random() < 0.3)
        if toxic:
            words[3] = words[17] = word + str(rng.choice(["", "en", "is"]))
        docs.append((i, " ".join(words), "en", "s", "x"))
        labels.append((i, 1, toxic, "y"))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, score string, predicted string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"))


def test_labels_held_out_are_not_learned(spark):
    docs, labels = corpus(600)
    flipped = [(i, q, 1 - t if out(i) else t, x) for i, q, t, x in labels]
    scores = []
    for mine in (labels, flipped):
        d, l = frames(spark, docs, mine)
        scores.append(sorted(map(tuple, T.score(d, T.train(d, l), ["doc_id"]).collect())))
    assert scores[0] == scores[1]
    right = sum(p == t for (_, _, p), (_, _, t, _) in zip(scores[0], labels))
    assert right >= 0.97 * len(labels)


def test_odd_rows(spark):
    docs, labels = corpus(300)
    docs += [(None, "grubol grubol", None, "s", "x"), (1000, None, "en", "s", "x"), (1001, "", "en", "s", "x"), (1002, "lorem " * 300_000 + "grubol", "en", "s", "x"),
             (1003, "\x00 𝄞 ???!!!", "en", "s", "x"), (5, docs[5][1], "en", "s", "x"), (5, "other text", "en", "s", "x")]
    labels += [(None, 1, 1, "y"), (1, 1, None, "y"), (2, 1, 1, "y"), (2, 1, 0, "y")]
    d, l = frames(spark, docs, labels)
    got = T.score(d, T.train(d, l), ["doc_id", "lang"]).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    same = [r["score"] for r in got if r["doc_id"] in (1000, 1001)]
    assert same[0] == same[1]
    with pytest.raises(ValueError):
        T.score(d, T.train(d, l), ["doc_id", "score"])


def test_nothing_to_learn_and_empty_tables(spark):
    docs, labels = corpus(20)
    d, l = frames(spark, docs, labels)
    none = T.train(d, l.limit(0))
    assert {r["score"] for r in T.score(d, none, ["doc_id"]).collect()} == {0.0}
    only = T.train(d, l.withColumn("toxic", F.lit(1)))
    assert {r["score"] for r in T.score(d, only, ["doc_id"]).collect()} == {1.0}
    assert T.score(d.limit(0), T.train(d.limit(0), l.limit(0)), ["doc_id"]).collect() == []


def test_sample_bounds_one_id_with_many_texts(spark):
    docs = [(7, f"text {i}", "en", "s", "x") for i in range(900)] + [(8, "copy", "en", "s", "x")] * 500
    d, l = frames(spark, docs, [(7, 1, 1, "y"), (8, 1, 0, "y")])
    assert T.sample_of(d, l, 100).count() < 160


def test_isotonic_is_the_least_squares_fit():
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 25, 60).astype(float), rng.integers(0, 2, 60).astype(float)
    places, values = T.isotonic(x, y)
    assert (np.diff(values) >= 0).all()
    # max-min formula over places
    n = np.array([(x == p).sum() for p in places])
    s = np.array([y[x == p].sum() for p in places])
    for k in range(len(places)):
        assert values[k] == pytest.approx(max(min(s[i:j + 1].sum() / n[i:j + 1].sum() for j in range(k, len(places))) for i in range(k + 1)))


def test_first_tree_is_the_best_newton_split():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (200, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (rng.random(200) < 0.1)).astype(float)
    t = T.Trees(rounds=1, depth=1, rate=1.0).fit(x, y)
    q = 1 / (1 + np.exp(-t.base))
    g, h = q - y, np.full(200, q * (1 - q))

    def gain(j, c):
        left = x[:, j] <= c
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)

    best = max(gain(j, c) for j in range(3) for c in range(5))
    assert gain(t.feature[0, 0], t.cut[0, 0]) == pytest.approx(best)
    left = x[:, t.feature[0, 0]] <= t.cut[0, 0]
    assert t.raw(x) == pytest.approx(np.where(left, *[t.base - g[m].sum() / (h[m].sum() + 1) for m in (left, ~left)]))


def test_features():
    lex = T.Lexicon({"grubol": 4.0, "grub*": 3.0, "tesa": 1.0})
    names = T.FEATURES
    f = dict(zip(names, T.features(["You are a grubol! tesa GRUBOLS"], lex)[0]))
    assert f["strong_hits"] == pytest.approx(np.log1p(2)) and f["weak_share"] == pytest.approx(1 / 6)
    assert f["near_hits"] == pytest.approx(np.log1p(2)) and f["shouted"] == pytest.approx(1 / 6)
    assert f["top_weight"] == 4.0 and f["exclaims"] == pytest.approx(1 / 30)
    f = dict(zip(names, T.features(["1d10t g-r-u-b-o-l grubooool i d i o t gru$bol"], lex)[0]))
    assert f["undone_hits"] >= np.log1p(3) and f["drawn_words"] > 0 and f["spaced_words"] > 0
    assert (T.features([""], lex) == 0).all()
