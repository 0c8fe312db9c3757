import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from scoreflow.operators.learners import SEARCH_SPACES, positive_probability
from scoreflow.operators.tuning import sample_params, trials_frame
from scoreflow.plans import catalog as C
from scoreflow.plans import training as TRN
from tests.conftest import SF_SMALL

SMALL = {"random_forest": {"n_estimators": 10}, "xgboost": {"n_estimators": 8},
         "lightgbm": {"n_estimators": 8}, "catboost": {"iterations": 8},
         "adaboost": {"n_estimators": 15, "learning_rate": 0.5},
         "mlp": {"max_iter": 30, "hidden_layer_sizes": [8]}, "svm": {"n_components": 16}}


@pytest.fixture(scope="module")
def split(spark):
    s = C.split_subjects(spark, SF_SMALL).persist()
    yield s.where(~F.col("is_test")), s.where(F.col("is_test"))
    s.unpersist()


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "xgboost", "lightgbm", "catboost",
                                  "adaboost", "svm", "mlp"])
def test_learner_auc_floor_and_probability_range(spark, split, name):
    train, test = split
    cfg = TRN.TrainConfig()
    m = TRN.fit_learner(name, SMALL.get(name, {}), train, train.count(), cfg)
    s = positive_probability(m.transform(test))
    r = s.agg(F.min("prob"), F.max("prob"), F.count("*")).collect()[0]
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == test.count()
    assert TRN.test_metrics(m, test, cfg)["roc_auc"] > 0.8


def test_pipeline_round_trip(spark, split, tmp_path):
    train, test = split
    cfg = TRN.TrainConfig()
    m = TRN.fit_learner("adaboost", SMALL["adaboost"], train, train.count(), cfg)
    path = str(tmp_path / "ada")
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = positive_probability(m.transform(test)).select("subject_id", "prob").collect()
    b = positive_probability(back.transform(test)).select("subject_id", "prob").collect()
    assert sorted(a) == sorted(b)


def test_cross_validation_summary(spark, split):
    train, _ = split
    cfg = TRN.TrainConfig(folds=3)
    from scoreflow.operators.splits import assign_folds
    folded = assign_folds(train, "label", "subject_id", 3)
    rows = TRN.cross_validate("logistic_regression", {}, folded, cfg)
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    s = TRN.summarise(rows)
    assert 0.5 < s["cv_roc_auc_mean"] <= 1.0 and s["cv_roc_auc_std"] >= 0


def test_trials_reproducible_and_in_range(spark):
    space = SEARCH_SPACES["xgboost"]
    a = sample_params("xgboost", space, 5, 42)
    assert a == sample_params("xgboost", space, 5, 42)
    for t in a:
        for p, spec in space.items():
            if spec[0] in ("int", "float"):
                assert spec[1] <= t[p] <= spec[2]
    df = {(r["trial"], r["param"]): r["value"]
          for r in trials_frame(spark, "xgboost", space, 5, 42).collect()}
    for i, t in enumerate(a):
        for p, spec in space.items():
            assert math.isclose(df[(i, p)], t[p], rel_tol=1e-12, abs_tol=1e-300), (i, p)


def test_voting_and_stacking(spark, split, tmp_path):
    from scoreflow.operators.ensemble import load_model, save_model
    train, test = split
    cfg = TRN.TrainConfig(folds=2)
    specs = {"logistic_regression": {}, "random_forest": {"n_estimators": 3, "max_depth": 3}}
    n = train.count()
    for kind, fit in (("voting", TRN.fit_voting), ("stacking", TRN.fit_stacking)):
        model = fit(specs, train, n, cfg)
        assert TRN.test_metrics(model, test, cfg)["roc_auc"] > 0.8
        save_model(model, str(tmp_path / kind), spark)
        back = load_model(str(tmp_path / kind), spark)
        a, b = (positive_probability(m.transform(test)).select("subject_id", "prob") for m in (model, back))
        assert sorted(a.collect()) == sorted(b.collect()) and a.count() == test.count()
    parts = [positive_probability(m.transform(test)).select("subject_id", "prob") for m in model.members.values()]
    wide = model.member_columns(test).select("subject_id", "_member_0", "_member_1")
    for i, p in enumerate(parts):
        j = wide.join(p, "subject_id")
        assert j.count() == test.count() and j.where(F.abs(F.col(f"_member_{i}") - F.col("prob")) > 1e-9).count() == 0


def test_adaboost_weights_and_alphas(spark, split):
    from scoreflow.operators.learners import AdaBoostStumps
    from scoreflow.operators.features import EncodedFeatures, ENCODED_FEATURES
    train, _ = split
    feats = EncodedFeatures(keepCols=["label"]).fit(train).transform(train)
    m = AdaBoostStumps(featureCols=ENCODED_FEATURES, nEstimators=12, learningRate=0.5).fit(feats)
    alphas = m.getOrDefault("alphas")
    assert 0 < len(alphas) <= 12 and all(a > 0 for a in alphas)


def test_adaboost_tries_every_distinct_value(spark):
    """A split in the tail of a column that is mostly zero, one between neighbours of many values, nulls, constants."""
    from scoreflow.operators.learners import AdaBoostStumps
    rows = [(float(i - 5700) if i >= 5700 else 0.0, float(i * 7919 % 6000), 1.0, None if i % 3 else 2.0) for i in range(6000)]
    df = spark.createDataFrame([(*r, int(r[0] > 263), int(r[1] > 3457), i % 5 // 4) for i, r in enumerate(rows)],
                               "zeros double, many double, same double, gaps double, tail int, middle int, other int")
    for label, f, thr in (("tail", 0, 263.0), ("middle", 1, 3457.0)):
        m = AdaBoostStumps(featureCols=["zeros", "many", "same", "gaps"], labelCol=label, nEstimators=5).fit(df)
        assert (m.getOrDefault("stumpFeatures"), m.getOrDefault("stumpThresholds")) == ([f], [thr])
        assert m.transform(df).where(F.col("prediction") != F.col(label)).count() == 0
    null = AdaBoostStumps(featureCols=["gaps"], labelCol="label", nEstimators=1).fit(df.withColumn("label", F.col("gaps").isNull().cast("int")))
    assert [null.getOrDefault(x) for x in ("stumpThresholds", "leftClass", "rightClass")] == [[2.0], [0], [1]]
    same = AdaBoostStumps(featureCols=["same"], labelCol="other", nEstimators=1).fit(df)
    assert same.getOrDefault("stumpThresholds") == [math.inf] and same.getOrDefault("leftClass") == [0]


def plain_boosting(x, y, rounds, rate):
    """SAMME with stumps, in plain numpy over all distinct values."""
    import numpy as np
    w, out = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= v
                sums = [[w[side & (y == c)].sum() for c in (0, 1)] for side in (left, ~left)]
                gini = round(sum(2 * a * b / (a + b) for a, b in sums) / w.sum(), 12)
                if best is None or gini < best[0]:
                    best = (gini, f, v, *[int(b > a) for a, b in sums])
        _, f, v, cl, cr = best
        miss = np.where(x[:, f] <= v, cl, cr) != y
        err = w[miss].sum() / w.sum()
        if err >= 0.5:
            break
        alpha = rate * np.log((1 - err) / err)
        out.append((f, float(v), cl, cr, alpha))
        w = w * np.exp(alpha * miss)
        w /= w.sum()
    return out


def test_adaboost_equals_plain_boosting(spark, monkeypatch):
    """Small parts and blocks, so that equal values and lists are cut; weights stored every third round."""
    import numpy as np
    from scoreflow.operators import attribute_lists as A
    monkeypatch.setattr(A, "PART_ROWS", 150)
    monkeypatch.setattr(A, "BLOCK_ROWS", 64)
    monkeypatch.setattr(A, "RENEW", 3)
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 4, 400), rng.normal(size=400).round(2), np.where(rng.random(400) < 0.7, 0, rng.integers(0, 50, 400))], 1).astype(float)
    y = ((x[:, 0] + x[:, 1] + x[:, 2] / 20 + rng.normal(size=400) * 0.7) > 2).astype(int)
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(5)
    got = A.boost_stumps(df, 3, 10, 0.5)
    want = plain_boosting(x, y, 10, 0.5)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


@pytest.mark.parametrize("codes", [0, 5, 4096])
def test_adaboost_with_lists_and_codes_equals_plain_boosting(spark, monkeypatch, codes):
    """All features in lists, some of them, none: the same stumps."""
    import numpy as np
    from scoreflow.operators import attribute_lists as A
    for name, value in (("PART_ROWS", 150), ("BLOCK_ROWS", 64), ("RENEW", 3), ("MOST_CODES", codes)):
        monkeypatch.setattr(A, name, value)
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 4, 300), rng.normal(size=300).round(2), rng.integers(0, 90, 300)], 1).astype(float)
    y = ((x[:, 0] + x[:, 1] + x[:, 2] / 40 + rng.normal(size=300) * 0.7) > 3).astype(int)
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(3)
    got, want = A.boost_stumps(df, 3, 7, 0.5), plain_boosting(x, y, 7, 0.5)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_adaboost_lists_hold_a_row_once_per_wide_feature(spark):
    from scoreflow.operators import attribute_lists as A
    df = spark.createDataFrame([([float(i % 3), float(i % 7), float(i)], i % 2) for i in range(500)], "x array<double>, y int")
    lists, total, layout = A.attribute_lists(df, 3)
    assert total == 500 and layout.wide == [] and sum(len(r["y"]) for r in lists.collect()) == 500


def test_stage1_two_learners(spark, split):
    train, test = split
    cfg = TRN.TrainConfig(folds=3, parallelism=2, overrides=SMALL)
    res = TRN.stage1(train, test, ["logistic_regression", "lightgbm"], cfg)
    assert [r.run_id for r in res] == ["stage1__logistic_regression", "stage1__lightgbm"]
    for r in res:
        assert 0.5 < r.metrics["cv_roc_auc_mean"] <= 1 and 0.5 < r.metrics["test_roc_auc"] <= 1


def test_stage2_random_search(spark, split):
    train, test = split
    cfg = TRN.TrainConfig(folds=2, n_trials=2, parallelism=2)
    trials = []
    res = TRN.stage2(train, test, ["logistic_regression"], cfg, trial_runs=trials)
    assert len(res) == 1 and res[0].run_id == "stage2__logistic_regression"
    assert 0.5 < res[0].metrics["best_cv_roc_auc"] <= 1 and "C" in res[0].params
    assert [t.parent_run_id for t in trials] == ["stage2__logistic_regression"] * 2
    runs = TRN.runs_frame(spark, res + trials)
    assert runs.where("parent_run_id = 'stage2__logistic_regression'").count() == 2


def test_run_batch_end_to_end(spark, split, tmp_path):
    from scoreflow.plans import batch as B
    from scoreflow.sources.tables import subjects
    train, _ = split
    cfg = TRN.TrainConfig()
    model = TRN.fit_learner("logistic_regression", {}, train, train.count(), cfg)
    src = subjects(spark, SF_SMALL)
    out = str(tmp_path / "predictions")
    summ = B.run_batch(spark, src, model, "subject_id", out, "logistic_regression", "1").collect()[0]
    written = spark.read.parquet(out)
    assert summ["total"] == written.count() == src.count()
    assert summ["positive"] + summ["negative"] == summ["total"]
    assert set(written.columns) >= {"subject_id", "pred", "prob", "confidence", "predicted_at"}


def test_categorical_indices_from_metadata(spark, split):
    from pyspark.ml import Pipeline
    from scoreflow.operators.learners import categorical_indices, indexed_native_stages
    train, _ = split
    out = Pipeline(stages=indexed_native_stages()).fit(train).transform(train)
    idx = categorical_indices(out)
    assert sorted(idx.values()) == [0, 1, 2] and set(idx) == {"sex_idx", "port_idx", "tier_idx"}


def test_polynomial_kernel_map_is_exact(spark):
    import numpy as np
    from scoreflow.operators.learners import PolynomialKernelFeatures
    rng = np.random.default_rng(0)
    X = rng.normal(size=(6, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double, d double")
    m = PolynomialKernelFeatures(inputCols=["a", "b", "c", "d"], degree=3, gamma="0.5").fit(df)
    Z = np.array([[r[c] for c in m.output_cols()] for r in m.transform(df).collect()])
    K = (0.5 * X @ X.T) ** 3
    assert np.allclose(Z @ Z.T, K, atol=1e-9)


def test_svm_poly_kernel(spark, split):
    train, test = split
    cfg = TRN.TrainConfig()
    m = TRN.fit_learner("svm", {"kernel": "poly"}, train, train.count(), cfg)  # degree 3 (default)
    assert TRN.test_metrics(m, test, cfg)["roc_auc"] > 0.7


def test_only_acting_parameters_are_searched():
    from scoreflow.operators.learners import build_stages, search_space
    assert search_space("svm")["kernel"][1] == ["rbf", "linear", "poly"]
    assert set(search_space("mlp")) == {"hidden_layer_sizes"} and "solver" not in search_space("logistic_regression")
    for bad in ({"kernel": "sigmoid"}, {"kernel": "other"}):
        with pytest.raises(ValueError):
            build_stages("svm", bad)
    with pytest.raises(ValueError):
        build_stages("random_forest", {"max_depth": 31})


def test_newton_logistic_is_the_optimum(spark):
    """Gradient zero at the solution, also with equal columns and null rows; separable labels stay finite under the penalty."""
    import numpy as np
    from scoreflow.operators.newton_logistic import NewtonLogistic
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=300) > 0.3).astype(float)
    rows = [(float(a), float(b), float(c), float(a), float(t)) for (a, b, c), t in zip(x, y)] + [(None, 0.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double")
    m = NewtonLogistic(featureCols=["a", "b", "c", "d"], C=0.5).fit(df)
    w, b0 = np.array(m.getOrDefault("coefficients")), m.getOrDefault("intercept")
    X = np.column_stack([x, x[:, 0]])
    p = 1 / (1 + np.exp(-(X @ w + b0)))
    assert np.abs(X.T @ (y - p) - w / 0.5).max() < 1e-6 and abs((y - p).sum()) < 1e-6 and abs(w[0] - w[3]) < 1e-8
    easy = NewtonLogistic(featureCols=["a"], C=1.0).fit(df.withColumn("label", (F.col("a") > 0).cast("double")))
    assert 1 < easy.getOrDefault("coefficients")[0] < 1000


def test_out_of_fold_rows_are_unseen_by_their_member(spark, split, monkeypatch):
    from scoreflow.operators.splits import assign_folds
    train, _ = split
    cfg = TRN.TrainConfig(folds=3, parallelism=1)
    folded = assign_folds(train, "label", "subject_id", 3).persist()
    seen, fit = {}, TRN.fit_voting

    def recorded(specs, rows, n, cfg):
        ids = {r[0] for r in rows.select("subject_id").collect()}
        assert len(ids) == n
        seen[len(seen)] = ids
        return fit(specs, rows, n, cfg)

    monkeypatch.setattr(TRN, "fit_voting", recorded)
    oof = TRN.out_of_fold({"logistic_regression": {"max_iter": 2}}, folded, folded.count(), cfg).collect()
    assert sorted(r["subject_id"] for r in oof) == sorted(r[0] for r in train.select("subject_id").collect())
    assert not any(r["subject_id"] in seen[r["fold"]] for r in oof)
