import math

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from scoreflow.operators import metrics as M

# 12 rows; the values below are worked out by hand from them
Y = [1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
P = [1, 1, 1, 1, 0, 1, 1, 0, 0, 0, 0, 0]
PROB = [0.95, 0.75, 0.75, 0.55, 0.30, 0.75, 0.65, 0.45, 0.25, 0.20, 0.10, 0.05]


def _df(spark):
    return spark.createDataFrame(list(zip(Y, P, PROB)), "y int, p int, prob double")


def test_goldens(spark):
    r = M.binary_metrics(_df(spark), "y", "p", "prob").collect()[0].asDict()
    # pairs won: 0.95 beats 7; each 0.75 beats 6 and ties one; 0.55 beats 5; 0.30 beats 4 -> 29 of 35
    loss = -sum(math.log(p if y else 1 - p) for y, p in zip(Y, PROB)) / len(Y)
    assert r == {"accuracy": 0.75, "recall": 0.8, "precision": 0.666667, "f1": 0.727273,
                 "roc_auc": round(29 / 35, 6), "log_loss": round(loss, 6)}
    c = M.confusion(_df(spark), "y", "p").collect()[0]
    assert (c.tp, c.fp, c.fn, c.tn) == (4, 2, 1, 5)


def test_no_probability_path(spark):
    r = M.binary_metrics(_df(spark), "y", "p", prefix="test_").collect()[0].asDict()
    assert set(r) == {"test_accuracy", "test_recall", "test_precision", "test_f1"}


def test_auc_matches_exact_evaluator_with_ties(spark):
    from scoreflow.sources.tables import subjects
    from tests.conftest import SF_MID
    df = subjects(spark, SF_MID).selectExpr("label", "cast(round(coalesce(fare, 0) / 50000) as double) as s")
    mine = M.roc_auc(df, "label", "s").collect()[0][0]
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="label", numBins=0)
    ref = ev.evaluate(df.selectExpr("cast(label as double) as label", "s"))
    assert abs(mine - ref) < 1e-12


def test_grouped_auc_and_cv_summary(spark):
    rows = [(f, y, p) for f in range(3) for y, p in zip(Y, PROB)]
    df = spark.createDataFrame(rows, "fold int, y int, prob double")
    a = {r["fold"]: r["roc_auc"] for r in M.roc_auc(df, "y", "prob", by=["fold"]).collect()}
    assert all(abs(v - 29 / 35) < 1e-12 for v in a.values())
    cv = spark.createDataFrame([(0, 0.25), (1, 0.5), (2, 0.25), (3, 0.5)], "fold int, f1 double")
    s = M.cv_summary(cv, ["f1"]).collect()[0]
    assert s["cv_f1_mean"] == 0.375 and s["cv_f1_std"] == 0.125


def test_classification_report(spark):
    rows = {r["row"]: r for r in M.classification_report(_df(spark), "y", "p").collect()}
    assert rows["positive"]["precision"] == 0.666667 and rows["positive"]["support"] == 5
    assert rows["negative"]["recall"] == 0.714286 and rows["accuracy"]["f1_score"] == 0.75
    assert rows["accuracy"]["precision"] is None and rows["weighted avg"]["support"] == 12


def test_auc_same_for_any_range_count(spark):
    from scoreflow.sources.tables import subjects
    from tests.conftest import SF_MID
    df = subjects(spark, SF_MID).selectExpr("label", "coalesce(fare, 0.0) * (1 + tier) as s")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = set()
    for n in (1, 3, 40):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.add(M.roc_auc(df, "label", "s").collect()[0][0])
        found.add(M.roc_auc(df.withColumn("g", F.col("label") * 0), "label", "s", by=["g"]).collect()[0]["roc_auc"])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1


def test_auc_null_scores_and_null_group(spark):
    nan = float("nan")
    rows = [(None, 1, None), (None, 0, 0.2), (None, 1, 0.9), (None, 0, nan), ("a", 1, 0.5), ("a", 0, 0.5), ("b", 1, 0.1)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "s", by=["g"]).collect()}
    # NULL and NaN tie below 0.2: of four pairs, 0.9 wins two and the NULL ties one
    assert got == {None: 2.5 / 4, "a": 0.5, "b": None}
    m = M.binary_metrics(df.withColumn("p", F.lit(1)), "y", "p", "s", by=["g"]).collect()
    assert {r["g"]: r["recall"] for r in m} == {None: 1.0, "a": 1.0, "b": 1.0}


def test_auc_does_not_overflow(spark):
    n = 4_000_000_000
    ranked = spark.createDataFrame([(0, n, 0), (n, 0, n)], "_pos long, _neg long, _neg_before long")
    won, pos, neg = M._ranked_auc(ranked, [])
    assert ranked.agg(M._auc(won, pos, neg)).first()[0] == 1.0
