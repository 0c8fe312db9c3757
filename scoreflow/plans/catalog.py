"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the driver tables through ``subjects`` (or another real
table) so its work grows with the data.  Doubles that come out of
aggregation or interpolation are rounded to 6 digits so the DuckDB oracle can
compare them bit-for-bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.functions import exact_quantiles, mode_of
from scoreflow.functions import scalars as S
from scoreflow.operators.attribute_lists import boost_stumps
from scoreflow.operators.features import (ENCODED_FEATURES, FARE_QUANTILES, PASS_PREFIX, EncodedFeatures,
                                          NativeCategoricalFeatures, persisted, standard_scale_stats)
from scoreflow.operators.splits import assign_folds, assign_split
from scoreflow.session import written
from scoreflow.sources.tables import subjects, table_version

ID, LABEL = "subject_id", "label"
RAW_COLUMNS = ["tier", "sex", "age", "fare"]  # raw values that scored rows carry along
R = 6  # digits kept for compared doubles

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rnd(c, digits: int = R):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ---------------------------------------------------------------- building blocks

def split_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_split(subjects(spark, sf_dir), LABEL, ID, test_size=0.2, seed=42)


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_subjects(spark, sf_dir).where(~F.col("is_test"))


_FITTED: dict = {}


def fitted_features(spark: SparkSession, sf_dir: str, keep=(ID, LABEL, "is_test")):
    """Encoded-feature model fit on the training split only.

    The fitted model is a handful of statistics, remembered per application, data directory and
    write times of the tables; which columns it passes through is set on a copy.
    """
    split = split_subjects(spark, sf_dir)
    key = (spark.sparkContext.applicationId, table_version(spark, sf_dir))
    if key not in _FITTED:
        _FITTED[key] = EncodedFeatures(keepCols=[ID]).fit(split.where(~F.col("is_test")))
    model = _FITTED[key]
    return model.copy({model.keepCols: list(keep)}), split


def feature_rows(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    """Features of all subjects; scoring needs no split, so only ``split`` ranks the rows."""
    model, parts = fitted_features(spark, sf_dir)
    if split:
        return model.transform(parts)
    s = subjects(spark, sf_dir)
    return model.transform(s.select("*", *[F.col(c).alias(PASS_PREFIX + c) for c in RAW_COLUMNS]))


# ---------------------------------------------------------------- titles

@register("title_extract")
def q_title_extract(spark, sf_dir):
    s = subjects(spark, sf_dir)
    return s.select(ID, S.honorific("full_name").alias("honorific"),
                    S.title_group("full_name").alias("title"))


@register("title_group_counts")
def q_title_group_counts(spark, sf_dir):
    s = subjects(spark, sf_dir)
    return s.groupBy(S.title_group("full_name").alias("title")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(LABEL)).cast("long").alias("positives"))


# ---------------------------------------------------------------- fitted statistics

@register("age_median_by_title")
def q_age_median_by_title(spark, sf_dir):
    tr = train_rows(spark, sf_dir).select(S.title_group("full_name").alias("title"), "age")
    m = exact_quantiles(tr, "age", [0.5], ["median_age"], by=["title"])
    return m.select("title", rnd("median_age").alias("median_age"))


@register("port_mode")
def q_port_mode(spark, sf_dir):
    return mode_of(train_rows(spark, sf_dir), "port", "port_mode")


@register("global_medians")
def q_global_medians(spark, sf_dir):
    both = train_rows(spark, sf_dir).select(F.explode(F.create_map(
        F.lit("age"), F.col("age"), F.lit("fare"), F.col("fare"))).alias("k", "v"))
    m = exact_quantiles(both, "v", [0.5], ["m"], by=["k"])
    return m.agg(*[rnd(F.max(F.when(F.col("k") == c, F.col("m")))).alias(f"{c}_median") for c in ("age", "fare")])


@register("fare_bins")
def q_fare_bins(spark, sf_dir):
    model, _ = fitted_features(spark, sf_dir)
    tr = train_rows(spark, sf_dir)
    filled = tr.select(F.coalesce(F.col("fare"), F.lit(model.getOrDefault("fareMedian")))
                       .alias("f"))
    q = exact_quantiles(filled, "f", FARE_QUANTILES, [f"e{i}" for i in range(5)])
    edges = q.select(F.array_distinct(F.array(*[F.col(f"e{i}") for i in range(5)])).alias("e"))
    return edges.select(F.posexplode("e").alias("edge_index", "edge")).select(
        "edge_index", rnd("edge").alias("edge"))


# ---------------------------------------------------------------- feature transforms

@register("age_impute")
def q_age_impute(spark, sf_dir):
    f = feature_rows(spark, sf_dir)
    return f.select(ID, rnd("age").alias("age"))


@register("age_band")
def q_age_band(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(ID, "age_band")


@register("fare_category")
def q_fare_category(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(ID, rnd("fare").alias("fare"), "fare_cat")


@register("family_features")
def q_family_features(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(ID, "family_size", "alone")


@register("ordinal_encode")
def q_ordinal_encode(spark, sf_dir):
    return feature_rows(spark, sf_dir).select(ID, "sex", "port", "title")


@register("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    f = feature_rows(spark, sf_dir)
    return f.select(ID, LABEL, *[rnd(c).alias(c) if c in ("age", "fare") else F.col(c)
                                 for c in ENCODED_FEATURES])


@register("native_cat_features")
def q_native_cat_features(spark, sf_dir):
    split = split_subjects(spark, sf_dir)
    m = NativeCategoricalFeatures(keepCols=[ID]).fit(split.where(~F.col("is_test")))
    out = m.transform(split)
    return out.select(*[rnd(c).alias(c) if c in ("age", "fare") else F.col(c)
                        for c in out.columns])


@register("standard_scale")
def q_standard_scale(spark, sf_dir):
    model, split = fitted_features(spark, sf_dir)
    tr = model.transform(split.where(~F.col("is_test")))
    st = standard_scale_stats(tr, ENCODED_FEATURES)
    return st.select(*[rnd(c).alias(c) for c in st.columns])


# ---------------------------------------------------------------- splits

@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    s = split_subjects(spark, sf_dir)
    return s.select(ID, LABEL, "is_test")


@register("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    tr = train_rows(spark, sf_dir).drop("is_test")
    return assign_folds(tr, LABEL, ID, k=5, seed=42).select(ID, LABEL, "fold")


# ---------------------------------------------------------------- scoring (fixed coefficients)

# Parameters of the preset linear scorer used by the scoring queries: an
# exported logistic model applied as one Catalyst expression.
SCORER_INTERCEPT = -0.25
SCORER_WEIGHTS = {"tier": -0.45, "sex": 1.3, "age": -0.012, "fare": 2.0e-6,
                  "family_size": -0.15, "alone": -0.2, "title": 0.05}


def scored_rows(spark: SparkSession, sf_dir: str, split: bool = False) -> DataFrame:
    f = feature_rows(spark, sf_dir, split)
    m = S.linear_margin(SCORER_WEIGHTS, SCORER_INTERCEPT)
    return (f.withColumn("margin", m).withColumn("prob", S.logistic(F.col("margin")))
            .withColumn("pred", (F.col("prob") > 0.5).cast("int")))


@register("linear_score")
def q_linear_score(spark, sf_dir):
    s = scored_rows(spark, sf_dir)
    return s.select(ID, rnd("prob").alias("prob"), "pred")


@register("confidence_band")
def q_confidence_band(spark, sf_dir):
    s = scored_rows(spark, sf_dir)
    return s.select(ID, S.confidence("prob").alias("confidence"))


TITLE_NAMES = {v: k for k, v in S.TITLE_CODES.items()}


@register("title_score_summary")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title -> rows, predicted positives, mean probability, bands."""
    s = scored_rows(spark, sf_dir).withColumn("band", S.confidence("prob"))
    names = S.map_literal(TITLE_NAMES)[F.col("title")]
    return s.groupBy(names.alias("title")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pred").cast("long").alias("predicted_positive"),
        F.round(F.avg("prob") * 100, 2).alias("avg_prob_pct"),
        F.sum((F.col("band") == "High").cast("int")).cast("long").alias("n_high"),
        F.sum((F.col("band") == "Medium").cast("int")).cast("long").alias("n_medium"),
        F.sum((F.col("band") == "Low").cast("int")).cast("long").alias("n_low"))


# ---------------------------------------------------------------- metrics

from scoreflow.operators import metrics as M  # noqa: E402


def scored_test(spark, sf_dir):
    return scored_rows(spark, sf_dir, split=True).where(F.col("is_test"))


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    return M.binary_metrics(scored_test(spark, sf_dir), LABEL, "pred", "prob", score="margin")


@register("roc_auc")
def q_roc_auc(spark, sf_dir):
    a = M.roc_auc(scored_rows(spark, sf_dir), LABEL, "margin")
    return a.select(rnd("roc_auc").alias("roc_auc"))


@register("log_loss")
def q_log_loss(spark, sf_dir):
    ll = M.log_loss(scored_test(spark, sf_dir), LABEL, "prob")
    return ll.select(rnd("log_loss").alias("log_loss"))


@register("classification_report")
def q_classification_report(spark, sf_dir):
    return M.classification_report(scored_test(spark, sf_dir), LABEL, "pred",
                                   class_names=("Not Survived", "Survived"))


def fold_metrics(spark, sf_dir):
    tr = scored_rows(spark, sf_dir, split=True).where(~F.col("is_test"))
    folded = assign_folds(tr, LABEL, ID, k=5, seed=42)
    return M.binary_metrics(folded, LABEL, "pred", "prob", by=["fold"], score="margin")


@register("fold_metrics")
def q_fold_metrics(spark, sf_dir):
    return fold_metrics(spark, sf_dir)


@register("cv_summary")
def q_cv_summary(spark, sf_dir):
    return M.cv_summary(fold_metrics(spark, sf_dir), M.METRIC_NAMES)


# ---------------------------------------------------------------- batch scoring

from scoreflow.plans import batch as B  # noqa: E402

MODEL_NAME, MODEL_VERSION = "preset_linear", "1"


def prediction_rows(spark, sf_dir, with_time: bool = False):
    """Scored rows with the raw source columns they carried along."""
    scored = scored_rows(spark, sf_dir).select(
        ID, "prob", "pred", *[F.col(PASS_PREFIX + c).alias(c) for c in RAW_COLUMNS])
    return B.predictions_table(scored, ID, "pred", "prob", MODEL_NAME, MODEL_VERSION, with_time=with_time)


@register("predictions_table")
def q_predictions_table(spark, sf_dir):
    return prediction_rows(spark, sf_dir)


@register("prediction_summary")
def q_prediction_summary(spark, sf_dir):
    return B.prediction_summary(prediction_rows(spark, sf_dir))


@register("confidence_distribution")
def q_confidence_distribution(spark, sf_dir):
    return B.confidence_distribution(prediction_rows(spark, sf_dir))


@register("top10_predictions")
def q_top10_predictions(spark, sf_dir):
    return B.top_predictions(prediction_rows(spark, sf_dir), ID, k=10)


# ---------------------------------------------------------------- intake: conform / validate / JSON

from scoreflow.operators import quality as Q  # noqa: E402
from scoreflow.sources.tables import intake  # noqa: E402

REQUEST_SIZE = 5  # records per generated request


@register("conform_columns")
def q_conform_columns(spark, sf_dir):
    return Q.conform(intake(spark, sf_dir))


def validated_intake(spark, sf_dir):
    return Q.validate(Q.conform(intake(spark, sf_dir)))


@register("validate_records")
def q_validate_records(spark, sf_dir):
    v = validated_intake(spark, sf_dir)
    return v.select(ID, "sex", "port", F.size("violations").alias("n_violations"),
                    F.concat_ws(",", "violations").alias("violations"))


@register("reject_reasons")
def q_reject_reasons(spark, sf_dir):
    v = validated_intake(spark, sf_dir)
    return v.select(F.explode("violations").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


def intake_requests(spark, sf_dir):
    """Group intake records into JSON request bodies of REQUEST_SIZE records."""
    src = intake(spark, sf_dir)
    rec = F.struct(F.col(ID).alias("_order"), *[F.col(c) for c in
                   ("tier", "sex", "age", "sibsp", "parch", "fare", "port", "full_name")])
    grouped = src.groupBy((F.col(ID) / REQUEST_SIZE).cast("long").alias("request_id")).agg(
        F.array_sort(F.collect_list(rec)).alias("passengers"))
    return grouped.select("request_id", F.to_json(F.struct("passengers")).alias("body"))


def faulty_requests(spark, sf_dir):
    """The requests as clients send them: some with counts as words, with explicit nulls, or cut off."""
    body = F.col("body")
    faulty = F.when(F.col("request_id") % 13 == 5, F.regexp_replace(body, r'"sibsp":-?\d+', '"sibsp":"two"')) \
        .when(F.col("request_id") % 19 == 7, F.regexp_replace(body, r'"parch":-?\d+', '"parch":null')) \
        .when(F.col("request_id") % 17 == 3, F.expr("substr(body, 1, length(body) - 2)")).otherwise(body)
    return intake_requests(spark, sf_dir).withColumn("body", faulty)


@register("json_records")
def q_json_records(spark, sf_dir):
    recs = Q.explode_requests(intake_requests(spark, sf_dir))
    return Q.conform(recs, keep_extra=True, null_as_absent=True).select(
        "request_id", ID, "tier", "sex", "age", "sibsp", "parch", "fare", "port", "full_name",
        "ticket")


# ---------------------------------------------------------------- runs, registry, ensembles

from scoreflow.operators import ensemble as E  # noqa: E402
from scoreflow.plans import tracking as TR  # noqa: E402

# Parameters: preset linear scorers standing in for stage-1 (base) and
# stage-2 (tuned) runs: (stage, model) -> (intercept, weights).
PRESET_SCORERS = {
    ("stage1", "logistic_regression"): (SCORER_INTERCEPT, SCORER_WEIGHTS),
    ("stage1", "sex_tier"): (-0.6, {"sex": 1.6, "tier": -0.35}),
    ("stage1", "fare_only"): (-1.0, {"fare": 4.0e-6}),
    ("stage1", "family"): (0.2, {"family_size": -0.25, "alone": -0.4, "sex": 1.1}),
    ("stage1", "age_title"): (0.3, {"age": -0.02, "title": 0.2, "sex": 0.9}),
    ("stage1", "port_class"): (-0.1, {"port": 0.15, "tier": -0.3, "fare": 1.0e-6}),
    ("stage2", "logistic_regression"): (-0.3, {"tier": -0.5, "sex": 1.4, "age": -0.01,
                                               "fare": 2.5e-6, "family_size": -0.1}),
    ("stage2", "sex_tier"): (-0.7, {"sex": 1.8, "tier": -0.3}),
    ("stage2", "fare_only"): (-1.2, {"fare": 4.5e-6, "tier": -0.1}),
    ("stage2", "family"): (0.1, {"family_size": -0.2, "alone": -0.3, "sex": 1.3}),
    ("stage2", "age_title"): (0.2, {"age": -0.015, "title": 0.25, "sex": 1.0}),
    ("stage2", "bands"): (-0.5, {"age_band": -0.2, "fare_cat": 0.3, "sex": 1.2}),
}
VOTE_MEMBERS = ["logistic_regression", "sex_tier", "family", "age_title"]


def preset_long(spark, sf_dir, stage: str | None = None) -> DataFrame:
    """(subject_id, label, is_test, stage, model, margin, prob, pred) per preset."""
    f = feature_rows(spark, sf_dir, split=True)
    items = [(k, v) for k, v in PRESET_SCORERS.items() if stage is None or k[0] == stage]
    arr = F.array(*[F.struct(F.lit(st).alias("stage"), F.lit(md).alias("model"),
                             S.linear_margin(w, b).alias("margin"))
                    for (st, md), (b, w) in items])
    long = f.select(ID, LABEL, "is_test", F.explode(arr).alias("_p")).select(
        ID, LABEL, "is_test", "_p.*")
    return (long.withColumn("prob", S.logistic(F.col("margin")))
                .withColumn("pred", (F.col("prob") > 0.5).cast("int")))


def run_metrics(spark, sf_dir) -> DataFrame:
    test = preset_long(spark, sf_dir).where(F.col("is_test"))
    m = M.binary_metrics(test, LABEL, "pred", "prob", by=["stage", "model"], score="margin")
    return m.withColumn("run_id", TR.run_key(F.col("stage"), F.col("model")))


def runs_table(spark, sf_dir) -> DataFrame:
    m = run_metrics(spark, sf_dir)
    packed = M.metric_map(m, M.METRIC_NAMES, prefix="test_", keep=["run_id", "stage", "model"])
    return packed.select("run_id", "stage", "model", F.lit(None).cast("string").alias("parent_run_id"),
                         F.create_map().cast("map<string,string>").alias("params"), "metrics",
                         F.create_map(F.lit("stage"), F.col("stage")).alias("tags"),
                         F.lit(None).cast("double").alias("duration_sec"),
                         F.lit(None).cast("string").alias("model_path"))


@register("run_metrics")
def q_run_metrics(spark, sf_dir):
    return run_metrics(spark, sf_dir).select("run_id", "stage", "model", *M.METRIC_NAMES)


@register("best_run")
def q_best_run(spark, sf_dir):
    b = TR.best_run(runs_table(spark, sf_dir), "test_roc_auc")
    return b.select("run_id", "stage", "model",
                    F.col("metrics")["test_roc_auc"].alias("test_roc_auc"))


@register("stage_results_outer")
def q_stage_results_outer(spark, sf_dir):
    m = run_metrics(spark, sf_dir)
    s1 = m.where(F.col("stage") == "stage1")
    s2 = m.where(F.col("stage") == "stage2")
    return TR.stage_results(s1, s2, "roc_auc", "roc_auc")


REGISTRY_NAME = "best-model"


def registered_versions(spark, sf_dir) -> DataFrame:
    """Every run registered once, in run-id order; the previous latest is in
    Production, older ones archived, the newest not yet promoted.

    The windows run over the runs table -- one row per run, a bounded
    handful -- so the single window partition is intentional.
    """
    runs = runs_table(spark, sf_dir).select("run_id")
    v = F.row_number().over(Window.orderBy("run_id")).cast("long")
    n = F.count(F.lit(1)).over(Window.partitionBy())
    out = runs.select(F.lit(REGISTRY_NAME).alias("name"), v.alias("_v"), n.alias("_n"), "run_id")
    return out.select("name", F.col("_v").cast("string").alias("version"), "run_id",
                      F.when(F.col("_v") == F.col("_n"), "None")
                      .when(F.col("_v") == F.col("_n") - 1, "Production")
                      .otherwise("Archived").alias("stage"))


@register("latest_version")
def q_latest_version(spark, sf_dir):
    return TR.latest_versions(registered_versions(spark, sf_dir))


@register("promote_version")
def q_promote_version(spark, sf_dir):
    return TR.promote_latest(registered_versions(spark, sf_dir))


@register("soft_vote")
def q_soft_vote(spark, sf_dir):
    long = preset_long(spark, sf_dir, "stage2").withColumnRenamed("model", "member")
    v = E.soft_vote(long, ID, members=VOTE_MEMBERS)
    return v.select(ID, rnd("vote_prob").alias("vote_prob"), "vote_pred", "n_members")


# ---------------------------------------------------------------- learners (no SQL oracle)

from scoreflow.plans import training as TRN  # noqa: E402


def _fit_and_test(spark, sf_dir, name: str, params: dict | None = None) -> DataFrame:
    """Fit on the training split, evaluate on the test split.

    The split (a join and a two-level rank) feeds the count, the feature
    fit, the learner and the evaluation, so it is persisted for the
    duration (MEMORY_AND_DISK, recomputable) and released before returning
    the one metrics row.
    """
    from scoreflow.operators.features import persisted

    cfg = TRN.TrainConfig()
    with persisted(split_subjects(spark, sf_dir)) as split:
        train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
        model = TRN.fit_learner(name, params or {}, train, train.count(), cfg)
        s = TRN.positive_probability(model.transform(test))
        row = M.binary_metrics(s, LABEL, "pred", "prob").collect()[0]
    return spark.createDataFrame([(name, *row)], ["model", *row.__fields__])


@register("train_logistic_regression")
def q_train_logistic_regression(spark, sf_dir):
    """Stage-1 logistic regression (base parameters): test metrics."""
    return _fit_and_test(spark, sf_dir, "logistic_regression")


@register("train_adaboost")
def q_train_adaboost(spark, sf_dir):
    """SAMME boosting of decision stumps (base parameters): test metrics."""
    return _fit_and_test(spark, sf_dir, "adaboost")


AUC_FLOOR = 0.85  # far above chance; base parameters reach 0.94 on these tables


def _check(spark, sf_dir, name):
    """A learner fitted on all training rows with its base parameters and applied to all test rows: what must hold."""
    split = split_subjects(spark, sf_dir)
    with persisted(split) as rows:
        train, test = rows.where(~F.col("is_test")), rows.where(F.col("is_test"))
        model = TRN.fit_learner(name, {}, train, train.count(), TRN.TrainConfig())
        s = TRN.positive_probability(model.transform(test)).select(LABEL, "prob")
        out = written(s, f"check-{name}")
    auc = M.roc_auc(out, LABEL, "prob")
    facts = out.agg(F.count("*").alias("test_rows"), F.sum(LABEL).cast("long").alias("positives"),
                    F.min("prob").alias("low"), F.max("prob").alias("high"))
    return facts.select(F.lit(name).alias("model"), "test_rows", "positives",
                        ((F.col("low") >= 0) & (F.col("high") <= 1)).alias("probabilities_in_range"),
                        (auc.scalar() > AUC_FLOOR).alias("auc_above_floor"))


def _register_checks() -> None:
    for name in CHECKED_LEARNERS:
        REGISTRY[f"check_{name}"] = lambda spark, sf_dir, name=name: _check(spark, sf_dir, name)


CHECKED_LEARNERS = ["logistic_regression", "mlp"]  # the others take minutes with base parameters: see tests
_register_checks()


@register("adaboost_first_stump")
def q_adaboost_first_stump(spark, sf_dir):
    """The first round of AdaBoost over all features of the training rows: threshold, classes and impurity."""
    rows = feature_rows(spark, sf_dir, split=True).where(~F.col("is_test"))
    x = F.array(*[F.col(c).cast("double") for c in ENCODED_FEATURES])
    f, cut, left, right, alpha, gini = boost_stumps(rows.select(x.alias("x"), F.col(LABEL).alias("y")), len(ENCODED_FEATURES), 1, 1.0)[0]
    return spark.createDataFrame([(ENCODED_FEATURES[f], round(cut, R), left, right, round(alpha, R), round(gini, R))],
                                 "feature string, threshold double, left_class int, right_class int, alpha double, gini double")


from scoreflow.operators import boosted_trees as BT  # noqa: E402

FIRST_TREES = {
    "newton_first_tree": BT.Growth(mode="level", rounds=1, rate=0.1, max_depth=2, l2=1.0, l1=0.5, bins=32),
    "leafwise_first_tree": BT.Growth(mode="leaf", rounds=1, rate=0.1, max_depth=-1, num_leaves=5, l2=0.0, least_rows=20, bins=32),
}


def first_tree(spark, sf_dir, name: str) -> DataFrame:
    """Splits of the first boosted tree over the training rows; nodes are numbered 1, children 2n and 2n + 1."""
    rows = feature_rows(spark, sf_dir, split=True).where(~F.col("is_test"))
    x = F.array(*[F.col(c).cast("double") for c in ENCODED_FEATURES])
    g = FIRST_TREES[name]
    _, cuts, (tree,), (made,) = BT.boost(rows.select(x.alias("x"), F.col(LABEL).alias("y")), len(ENCODED_FEATURES), g)
    number, out = {0: 1}, []
    for node, f, b, gain, left, right in made:
        number[tree.left[node]], number[tree.right[node]] = 2 * number[node], 2 * number[node] + 1
        values = [float(round(-g.rate * BT.soft(s[0], g.l1) / (s[1] + g.l2), R)) for s in (left, right)]
        out.append((number[node], ENCODED_FEATURES[f], round(cuts[f][b], R), round(gain, R), int(left[2]), int(right[2]), *values))
    return spark.createDataFrame(out, "node int, feature string, threshold double, gain double, left_rows long, right_rows long, "
                                      "left_value double, right_value double")


for _name in FIRST_TREES:
    REGISTRY[_name] = lambda spark, sf_dir, name=_name: first_tree(spark, sf_dir, name)


@register("ordered_target_stats")
def q_ordered_target_stats(spark, sf_dir):
    """Native categoricals of the training rows as smoothed mean labels of the rows before, in a hashed order."""
    rows = train_rows(spark, sf_dir).select(ID, LABEL, *[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in ("sex", "port", "tier")])
    prior = float(rows.agg(F.avg(LABEL)).first()[0])
    rows = rows.withColumn("_order", F.concat(F.md5(F.col(ID).cast("string")), F.lpad(F.col(ID).cast("string"), 20, "0")))
    for c in ("sex", "port", "tier"):
        rows = BT.ordered_statistics(rows, c, LABEL, "_order", prior)
    return rows.select(ID, *[rnd(f"{c}_ts").alias(f"{c}_ts") for c in ("sex", "port", "tier")])


from scoreflow.operators.newton_logistic import newton  # noqa: E402

LOGISTIC_TERMS = ["sex", "age", "fare", "family_size"]


@register("logistic_coefficients")
def q_logistic_coefficients(spark, sf_dir):
    """Penalised logistic regression (C = 1) on four standardised features of the training rows, by Newton steps."""
    at = [ENCODED_FEATURES.index(c) for c in LOGISTIC_TERMS]
    rows = scaled_rows(spark, sf_dir).where(~F.col("is_test")).select(
        F.lit(1.0).alias("x0"), *[F.col("x")[i].alias(f"x{k + 1}") for k, i in enumerate(at)], F.col(LABEL).cast("double").alias("y"))
    with persisted(rows) as r:
        beta, _ = newton(r, len(at) + 1, 1.0)
    return spark.createDataFrame([(t, round(float(b), R)) for t, b in zip(["intercept", *LOGISTIC_TERMS], beta)], "term string, coefficient double")


def refit_folds(spark, sf_dir, k: int = 5) -> DataFrame:
    """Training rows scored per fold by the preset scorer on features that were fitted on the other folds."""
    with persisted(assign_folds(train_rows(spark, sf_dir).drop("is_test"), LABEL, ID, k=k, seed=42)) as folded:
        out = None
        for i in range(k):
            model = EncodedFeatures(keepCols=[ID, LABEL, "fold"]).fit(folded.where(F.col("fold") != i))
            part = model.transform(folded.where(F.col("fold") == i))
            margin = S.linear_margin(SCORER_WEIGHTS, SCORER_INTERCEPT)
            part = part.select(ID, LABEL, "fold", margin.alias("margin"), S.logistic(margin).alias("prob"))
            out = part if out is None else out.unionByName(part)
        return written(out.withColumn("pred", (F.col("prob") > 0.5).cast("int")), "refit-folds")


@register("refit_fold_metrics")
def q_refit_fold_metrics(spark, sf_dir):
    return M.binary_metrics(refit_folds(spark, sf_dir), LABEL, "pred", "prob", by=["fold"], score="margin")


@register("numeric_columns")
def q_numeric_columns(spark, sf_dir):
    """Listed columns dropped where present (one of them is not), then all remaining strings."""
    return Q.drop_string_columns(Q.drop_present(subjects(spark, sf_dir), ["full_name", "ticket", "sibsp"]))


@register("positive_share_text")
def q_positive_share_text(spark, sf_dir):
    return B.share_text(prediction_rows(spark, sf_dir))


# ---------------------------------------------------------------- k-NN (M7)

from scoreflow.operators import neighbors as KN  # noqa: E402

KNN_CONFIGS = {"uniform_p2": (5, "uniform", 2), "distance_p1": (7, "distance", 1)}


def scaled_rows(spark, sf_dir) -> DataFrame:
    """All subjects' features, standardised by the training rows and rounded, as the array ``x``."""
    model, split = fitted_features(spark, sf_dir)
    rows = model.transform(split)
    r = standard_scale_stats(rows.where(~F.col("is_test")), ENCODED_FEATURES).collect()[0]
    scaled = [F.round((F.col(c).cast("double") - F.lit(r[f"{c}__mean"])) / F.lit(r[f"{c}__std"] or 1.0), R) for c in ENCODED_FEATURES]
    return rows.select(ID, LABEL, "is_test", F.array(*scaled).alias("x"))


@register("knn_vote")
def q_knn_vote(spark, sf_dir):
    """Every test row's class by its nearest training rows, under two configurations."""
    with persisted(scaled_rows(spark, sf_dir)) as rows:
        blocks, boxes = KN.build_index(rows.where(~F.col("is_test")).select(F.col(ID).alias("id"), LABEL, "x"))
        queries = rows.where("is_test").select(F.col(ID).alias("qid"), "x")
        out = None
        for name, (k, weights, p) in KNN_CONFIGS.items():
            best = KN.nearest(blocks, boxes, queries, k, p)
            prob = KN.votes(F.col("best"), weights, p)
            mine = best.select(F.col("qid").alias(ID), F.lit(name).alias("config"), F.transform("best", lambda b: b["id"]).alias("_ids"),
                               rnd(prob).alias("prob"), (prob > 0.5).cast("int").alias("pred")) \
                .withColumn("neighbours", F.array_join("_ids", ",")).drop("_ids")
            out = mine if out is None else out.unionByName(mine)
    return out


@register("batch_scores")
def q_batch_scores(spark, sf_dir):
    """Batch scoring with a fitted pipeline: predictions table of all rows."""
    split = split_subjects(spark, sf_dir)
    train = split.where(~F.col("is_test"))
    cfg = TRN.TrainConfig()
    model = TRN.fit_learner("logistic_regression", {}, train, train.count(), cfg)
    raw = subjects(spark, sf_dir)
    s = TRN.positive_probability(model.transform(raw.withColumn("is_test", F.lit(True))))
    return B.predictions_table(s, ID, "pred", "prob", "logistic_regression", "1",
                               with_time=False)


# ---------------------------------------------------------------- streaming (X1)

import uuid  # noqa: E402

from scoreflow.session import shared_dir  # noqa: E402
from scoreflow.streaming import scoring as STR  # noqa: E402


def preset_stream_scorer(model):
    """Features (fit on the training split) + the preset linear scorer."""
    def score(records: DataFrame) -> DataFrame:
        f = model.transform(records)
        m = S.linear_margin(SCORER_WEIGHTS, SCORER_INTERCEPT)
        return f.select("request_id", (F.col(ID) - 1).alias("passenger_index"),
                        (S.logistic(m) > 0.5).cast("int").alias("pred"),
                        F.round(S.logistic(m), 6).alias("prob"),
                        S.confidence(S.logistic(m)).alias("confidence"))
    return score


@register("stream_scores")
def q_stream_scores(spark, sf_dir):
    """Intake requests written as JSON lines and scored by a streaming job;
    both sinks (accepted predictions, rejected records) read back."""
    base = shared_dir(spark, f"stream-{uuid.uuid4().hex[:12]}")
    faulty_requests(spark, sf_dir).select(F.concat(
        F.lit('{"request_id":'), F.col("request_id").cast("string"), F.lit(","),
        F.expr("substr(body, 2)")).alias("value")).write.text(f"{base}/in")
    model, _ = fitted_features(spark, sf_dir, keep=(ID, "request_id"))
    qs = STR.start_scoring(spark, f"{base}/in", preset_stream_scorer(model), f"{base}/out",
                           f"{base}/rejects", f"{base}/ckpt")
    STR.run_to_completion(qs)
    ok = spark.read.parquet(f"{base}/out").select(
        "request_id", "passenger_index", F.lit("accepted").alias("status"), "pred", "prob",
        "confidence", F.lit(None).cast("string").alias("violations"))
    bad = spark.read.parquet(f"{base}/rejects").select(
        "request_id", "passenger_index", F.lit("rejected").alias("status"),
        F.lit(None).cast("int").alias("pred"), F.lit(None).cast("double").alias("prob"),
        F.lit(None).cast("string").alias("confidence"),
        F.concat_ws(",", "violations").alias("violations"))
    return ok.unionByName(bad)


def request_batch(spark, sf_dir) -> DataFrame:
    """Batch form of the request path: parse, validate, score accepted."""
    recs = Q.validate_requests(Q.explode_requests(faulty_requests(spark, sf_dir)))
    model, _ = fitted_features(spark, sf_dir, keep=(ID, "request_id"))
    return preset_stream_scorer(model)(Q.accepted(recs))


@register("response_totals")
def q_response_totals(spark, sf_dir):
    return responses(spark, sf_dir).select("request_id", "total_passengers", "survived_count")


def responses(spark, sf_dir) -> DataFrame:
    return B.responses(request_batch(spark, sf_dir), "request_id", "passenger_index", "pred", "prob",
                       "preset_linear", "local_fallback")


@register("response_items")
def q_response_items(spark, sf_dir):
    """Every item of the JSON response bodies, parsed back: index, class, probability and band."""
    kind = ("predictions array<struct<passenger_index:bigint,survived:int,probability:double,confidence:string>>, "
            "total_passengers bigint, survived_count bigint, model_name string, model_source string")
    r = responses(spark, sf_dir).select("request_id", F.from_json("body", kind).alias("r"))
    return r.select("request_id", "r.model_name", "r.model_source", F.explode("r.predictions").alias("i")) \
        .select("request_id", "model_name", "model_source", "i.*")


# ---------------------------------------------------------------- files and tables (S1-S11)

from scoreflow.sources import files as FS  # noqa: E402
from scoreflow.sources.tables import SUBJECT_COLUMNS  # noqa: E402

SUBJECT_SCHEMA = T.StructType([
    T.StructField("subject_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("tier", T.IntegerType()), T.StructField("full_name", T.StringType()),
    T.StructField("sex", T.StringType()), T.StructField("age", T.DoubleType()),
    T.StructField("sibsp", T.IntegerType()), T.StructField("parch", T.IntegerType()),
    T.StructField("fare", T.DoubleType()), T.StructField("port", T.StringType())])
DEMO_DB = "scoreflow_demo"


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """Training split written as CSV with its label, read back with a schema."""
    path = shared_dir(spark, f"csv-{uuid.uuid4().hex[:12]}")
    FS.write_csv(train_rows(spark, sf_dir), path, SUBJECT_COLUMNS)
    return FS.read_labelled(spark, path, SUBJECT_SCHEMA, LABEL)


def refreshed_test_table(spark, sf_dir) -> tuple[str, int]:
    """Create/select the database and tables, full-refresh ``test_data``;
    the caller's current database is restored afterwards."""
    previous = spark.catalog.currentDatabase()
    try:
        FS.ensure_database(spark, DEMO_DB)
        FS.ensure_tables(spark, DEMO_DB)
        n = FS.full_refresh(spark, Q.conform(intake(spark, sf_dir)), f"{DEMO_DB}.test_data")
    finally:
        spark.catalog.setCurrentDatabase(previous)
    return f"{DEMO_DB}.test_data", n


@register("table_full_refresh")
def q_table_full_refresh(spark, sf_dir):
    table, _ = refreshed_test_table(spark, sf_dir)
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("test_data").alias("table_name"), "rows")


def refreshed_predictions(spark, sf_dir):
    """The ``predictions`` table fully refreshed with all scored rows."""
    previous = spark.catalog.currentDatabase()
    try:
        FS.ensure_database(spark, DEMO_DB)
        FS.ensure_tables(spark, DEMO_DB)
        FS.full_refresh(spark, prediction_rows(spark, sf_dir, with_time=True), f"{DEMO_DB}.predictions")
    finally:
        spark.catalog.setCurrentDatabase(previous)
    return spark.table(f"{DEMO_DB}.predictions")


@register("predictions_refresh")
def q_predictions_refresh(spark, sf_dir):
    """Rows of the refreshed table; every one has its write time."""
    return refreshed_predictions(spark, sf_dir).where("predicted_at is not null").drop("predicted_at")


@register("run_report")
def q_run_report(spark, sf_dir):
    """The run's summary row from the refreshed table (its run time is tested apart)."""
    return B.run_report(refreshed_predictions(spark, sf_dir), MODEL_NAME, MODEL_VERSION).drop("run_time")


@register("sample_rows")
def q_sample_rows(spark, sf_dir):
    table, _ = refreshed_test_table(spark, sf_dir)
    return FS.sample_rows(spark.table(table), ID, [ID, "tier", "full_name", "sex", "age"], 3)


@register("first_20_predictions")
def q_first_20_predictions(spark, sf_dir):
    return prediction_rows(spark, sf_dir).orderBy(ID).limit(20).select(ID, "pred", "prob")


# ---------------------------------------------------------------- the same operators on other tables

from scoreflow.sources.tables import read_table  # noqa: E402


@register("labels_split")
def q_labels_split(spark, sf_dir):
    """Exact stratified hold-out split of the labelled documents (by quality)."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return assign_split(lab, "quality", "doc_id").select("doc_id", "quality", "is_test")


@register("doc_length_auc")
def q_doc_length_auc(spark, sf_dir):
    """Exact ROC-AUC (ties half) of document length for quality, per language."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    a = M.roc_auc(docs.join(lab, "doc_id"), "quality", "n_chars", by=["lang"])
    return a.select("lang", rnd("roc_auc").alias("roc_auc"))


@register("lineitem_price_quantiles")
def q_lineitem_price_quantiles(spark, sf_dir):
    """Exact quartiles of the extended price per return flag (all line items)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    names = ["p_min", "p_q1", "p_median", "p_q3", "p_max"]
    q = exact_quantiles(li, "l_extendedprice", FARE_QUANTILES, names, by=["l_returnflag"])
    return q.select("l_returnflag", *[rnd(n).alias(n) for n in names])


@register("lineitem_quantity_mode")
def q_lineitem_quantity_mode(spark, sf_dir):
    """Most frequent quantity per line status (ties -> smallest)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_linestatus", "l_quantity")
    return mode_of(li, "l_quantity", "mode_quantity", by=["l_linestatus"])
