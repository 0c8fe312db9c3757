"""Learners on Spark ML, plus the ones Spark ML lacks, built as Spark jobs.

``build_stages(name, params, ...)`` turns a learner name and reference-style
parameters into ``pyspark.ml`` pipeline stages:

* random forest maps onto Spark ML's estimator; the MLP is Spark's model, its weights fitted on blocks of rows
  (``perceptron``);
* logistic regression takes Newton steps on one aggregate each (``newton_logistic``);
* the three boosters are Newton-boosted histogram trees (``boosted_trees``): level by level,
  leaf-wise, and oblivious over ordered target statistics of the raw categories;
* ``AdaBoostStumps`` (SAMME) tries every distinct value as a threshold, on presorted attribute
  lists (``attribute_lists``); scoring is one expression;
* ``PlattSVC``: linear SVM (Spark ``LinearSVC``) with Platt scaling fitted on
  out-of-fold margins; the RBF kernel is approximated by random Fourier
  features (Rahimi & Recht, 2007) computed as column expressions, the
  polynomial kernel uses its exact explicit feature map;
* ``PopulationScaler``: standardisation with the population std (zero std ->
  scale 1), which Spark's ``StandardScaler`` does not offer.

k-NN is in ``neighbors``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions import scalars as S
from scoreflow.operators.attribute_lists import boost_stumps
from scoreflow.operators.boosted_trees import BoostedTrees
from scoreflow.operators.features import (ENCODED_FEATURES, NATIVE_CATEGORICAL, NATIVE_FEATURES,
                                          EncodedFeatures, NativeCategoricalFeatures, persisted)
from scoreflow.operators.neighbors import KNearest, order_of
from scoreflow.operators.newton_logistic import NewtonLogistic
from scoreflow.operators.perceptron import Perceptron

# ---------------------------------------------------------------------------
# Base parameters of each learner (reference configuration).
BASE_PARAMS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000, "solver": "lbfgs", "random_state": 42},
    "random_forest": {"n_estimators": 200, "max_depth": 8, "min_samples_split": 5,
                      "min_samples_leaf": 2, "random_state": 42},
    "xgboost": {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8,
                "colsample_bytree": 0.8, "random_state": 42},
    "lightgbm": {"n_estimators": 200, "max_depth": -1, "learning_rate": 0.1, "num_leaves": 31,
                 "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42},
    "catboost": {"iterations": 200, "depth": 6, "learning_rate": 0.1, "random_seed": 42},
    "adaboost": {"n_estimators": 100, "learning_rate": 0.1, "random_state": 42},
    "knn": {"n_neighbors": 5, "weights": "uniform", "metric": "minkowski", "p": 2},
    "svm": {"C": 1.0, "kernel": "rbf", "gamma": "scale", "probability": True,
            "random_state": 42},
    "mlp": {"hidden_layer_sizes": [128, 64], "activation": "relu", "solver": "adam",
            "alpha": 0.001, "learning_rate_init": 0.001, "max_iter": 500, "random_state": 42},
}
NEEDS_SCALING = {"logistic_regression", "svm", "mlp", "knn"}
# Search spaces: name -> {param: (type, low, high, log) | ("categorical", choices)}.
SEARCH_SPACES = {
    "logistic_regression": {"C": ("float", 0.001, 100.0, True),
                            "solver": ("categorical", ["lbfgs", "saga", "liblinear"]),
                            "max_iter": ("int", 200, 2000, False)},
    "random_forest": {"n_estimators": ("int", 100, 600, False), "max_depth": ("int", 3, 20, False),
                      "min_samples_split": ("int", 2, 20, False),
                      "min_samples_leaf": ("int", 1, 10, False),
                      "max_features": ("categorical", ["sqrt", "log2", None])},
    "xgboost": {"n_estimators": ("int", 100, 600, False), "max_depth": ("int", 3, 12, False),
                "learning_rate": ("float", 0.005, 0.3, True), "subsample": ("float", 0.5, 1.0, False),
                "colsample_bytree": ("float", 0.4, 1.0, False),
                "reg_alpha": ("float", 1e-8, 10.0, True), "reg_lambda": ("float", 1e-8, 10.0, True),
                "min_child_weight": ("int", 1, 10, False)},
    "lightgbm": {"n_estimators": ("int", 100, 600, False), "num_leaves": ("int", 20, 150, False),
                 "learning_rate": ("float", 0.005, 0.3, True),
                 "subsample": ("float", 0.5, 1.0, False),
                 "colsample_bytree": ("float", 0.4, 1.0, False),
                 "reg_alpha": ("float", 1e-8, 10.0, True), "reg_lambda": ("float", 1e-8, 10.0, True),
                 "min_child_samples": ("int", 5, 100, False)},
    "catboost": {"iterations": ("int", 100, 600, False), "depth": ("int", 4, 10, False),
                 "learning_rate": ("float", 0.005, 0.3, True),
                 "l2_leaf_reg": ("float", 1.0, 10.0, False), "border_count": ("int", 32, 255, False),
                 "bagging_temperature": ("float", 0.0, 1.0, False)},
    "adaboost": {"n_estimators": ("int", 50, 500, False),
                 "learning_rate": ("float", 0.01, 2.0, True)},
    "knn": {"n_neighbors": ("int", 3, 30, False), "weights": ("categorical", ["uniform", "distance"]),
            "metric": ("categorical", ["minkowski", "euclidean", "manhattan"]), "p": ("int", 1, 3, False)},
    "svm": {"C": ("float", 0.01, 100.0, True),
            "kernel": ("categorical", ["rbf", "linear", "poly", "sigmoid"]),
            "gamma": ("categorical", ["scale", "auto"])},
    "mlp": {"hidden_layer_sizes": ("categorical", [[64], [128, 64], [256, 128, 64], [128, 64, 32]]),
            "activation": ("categorical", ["relu", "tanh"]),
            "alpha": ("float", 1e-5, 0.1, True), "learning_rate_init": ("float", 1e-4, 0.01, True)},
}
# ---------------------------------------------------------------------------

LEARNERS = list(BASE_PARAMS)

# Parameters that the Spark learners have no counterpart for: they are neither searched nor recorded
# with a run.
INERT = {
    "logistic_regression": {"solver"},
    "random_forest": {"min_samples_split"},
    "mlp": {"solver", "activation", "alpha", "learning_rate_init"},
}
UNSUPPORTED_KERNELS = {"sigmoid"}  # no positive definite kernel, so it has no feature map
MAX_TREE_DEPTH = 30


def acting_params(name: str, params: dict) -> dict:
    """``params`` without those that have no effect."""
    inert = set(INERT.get(name, ()))
    if name == "knn" and params.get("metric", "minkowski") in ("euclidean", "manhattan"):
        inert.add("p")
    return {k: v for k, v in params.items() if k not in inert}


def search_space(name: str) -> dict:
    """The part of the search space that acts."""
    space = acting_params(name, SEARCH_SPACES.get(name, {}))
    if "kernel" in space:
        space["kernel"] = ("categorical", [k for k in space["kernel"][1] if k not in UNSUPPORTED_KERNELS])
    return space


def _depth(value) -> int:
    if int(value) > MAX_TREE_DEPTH:
        raise ValueError(f"tree depth {value} is beyond Spark's {MAX_TREE_DEPTH}")
    return int(value)


class PopulationScaler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std per column; zero std -> scale 1."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to scale", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        cols = self.getOrDefault(self.inputCols)
        r = df.agg(*[a for c in cols for a in (F.avg(F.col(c).cast("double")),
                                               F.stddev_pop(F.col(c).cast("double")))]).collect()[0]
        means = [float(r[2 * i] or 0.0) for i in range(len(cols))]
        stds = [float(r[2 * i + 1] or 0.0) for i in range(len(cols))]
        m = PopulationScalerModel()
        m._set(inputCols=cols, means=means, scales=[s if s > 0 else 1.0 for s in stds])
        return m


class PopulationScalerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "columns to scale", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population stds", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.inputCols)
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        repl = {c: ((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c)
                for c, m, s in zip(cols, ms, ss)}
        return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


# ---------------------------------------------------------------- AdaBoost (SAMME)

class _BoostParams(Params):
    featureCols = Param(Params._dummy(), "featureCols", "numeric feature columns",
                        TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    nEstimators = Param(Params._dummy(), "nEstimators", "boosting rounds", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinkage", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", nEstimators=50, learningRate=1.0)


class AdaBoostStumps(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol=None, nEstimators=None, learningRate=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "AdaBoostStumpsModel":
        cols = self.getOrDefault(self.featureCols)
        # a null is NaN, which is on the right of every threshold here as in scoring
        x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
        found = boost_stumps(df.select(x.alias("x"), (F.col(self.getOrDefault(self.labelCol)) == 1).cast("int").alias("y")).na.fill(0, ["y"]),
                             len(cols), self.getOrDefault(self.nEstimators), self.getOrDefault(self.learningRate))
        m = AdaBoostStumpsModel()
        feats, thrs, lefts, rights, alphas = ([s[i] for s in found] for i in range(5))
        return m._set(featureCols=cols, stumpFeatures=feats, stumpThresholds=thrs, leftClass=lefts, rightClass=rights, alphas=alphas)


class AdaBoostStumpsModel(Model, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    stumpFeatures = Param(Params._dummy(), "stumpFeatures", "feature index per round",
                          TypeConverters.toListInt)
    stumpThresholds = Param(Params._dummy(), "stumpThresholds", "threshold per round",
                            TypeConverters.toListFloat)
    leftClass = Param(Params._dummy(), "leftClass", "class when x <= threshold",
                      TypeConverters.toListInt)
    rightClass = Param(Params._dummy(), "rightClass", "class when x > threshold",
                       TypeConverters.toListInt)
    alphas = Param(Params._dummy(), "alphas", "vote weight per round", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def decision(self):
        cols = self.getOrDefault(self.featureCols)
        alphas = self.getOrDefault(self.alphas)
        total = sum(alphas) or 1.0
        d = F.lit(0.0)
        for f, t, cl, cr, a in zip(self.getOrDefault(self.stumpFeatures),
                                   self.getOrDefault(self.stumpThresholds),
                                   self.getOrDefault(self.leftClass),
                                   self.getOrDefault(self.rightClass), alphas):
            side = F.when(F.col(cols[f]).cast("double") <= F.lit(t), F.lit(2 * cl - 1)).otherwise(
                F.lit(2 * cr - 1))
            d = d + F.lit(a / total) * side
        return d

    def _transform(self, df: DataFrame) -> DataFrame:
        p1 = S.logistic(self.decision())
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p1, p1))) \
                 .withColumn("prediction", (p1 > 0.5).cast("double"))


# ---------------------------------------------------------------- SVM with Platt scaling

def kernel_gamma(df: DataFrame, cols: Sequence[str], g) -> float:
    """'scale' = 1 / (d * variance of all matrix entries), 'auto' = 1/d, or a number."""
    d = len(cols)
    if g == "scale":
        r = df.agg(*[F.sum(F.col(c).cast("double")) for c in cols],
                   *[F.sum(F.col(c).cast("double") ** 2) for c in cols],
                   F.count(F.lit(1))).collect()[0]
        n = r[-1] * d
        s1, s2 = sum(r[:d]), sum(r[d:2 * d])
        var = (s2 / n - (s1 / n) ** 2) if n else 0.0
        return 1.0 / (d * var) if var > 0 else 1.0
    if g == "auto":
        return 1.0 / d
    return float(g)


class PolynomialKernelFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Exact feature map of the homogeneous polynomial kernel (gamma x.y)^degree:
    every monomial of the given degree weighted by sqrt(multinomial) *
    gamma^(degree/2), so a linear model on it is the kernel model in primal
    form."""

    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    degree = Param(Params._dummy(), "degree", "kernel degree", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, degree=None, gamma=None):
        super().__init__()
        self._setDefault(degree=3, gamma="scale")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        cols = self.getOrDefault(self.inputCols)
        m = PolynomialKernelFeaturesModel()
        m._set(inputCols=cols, degree=self.getOrDefault(self.degree),
               gammaValue=kernel_gamma(df, cols, self.getOrDefault(self.gamma)))
        return m


class PolynomialKernelFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    degree = Param(Params._dummy(), "degree", "kernel degree", TypeConverters.toInt)
    gammaValue = Param(Params._dummy(), "gammaValue", "fitted gamma", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()

    def terms(self):
        from collections import Counter
        from itertools import combinations_with_replacement

        deg = self.getOrDefault(self.degree)
        d = len(self.getOrDefault(self.inputCols))
        out = []
        for combo in combinations_with_replacement(range(d), deg):
            mult = math.factorial(deg)
            for c in Counter(combo).values():
                mult //= math.factorial(c)
            out.append((combo, math.sqrt(mult)))
        return out

    def output_cols(self):
        return [f"poly_{j}" for j in range(len(self.terms()))]

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.inputCols)
        scale = self.getOrDefault(self.gammaValue) ** (self.getOrDefault(self.degree) / 2.0)
        outs = []
        for j, (combo, w) in enumerate(self.terms()):
            e = F.lit(w * scale)
            for i in combo:
                e = e * F.col(cols[i]).cast("double")
            outs.append(e.alias(f"poly_{j}"))
        return df.select("*", *outs)


class RandomFourierFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """RBF kernel map z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma)."""

    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    numFeatures = Param(Params._dummy(), "numFeatures", "output dimension D", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, numFeatures=None, gamma=None, seed=None):
        super().__init__()
        self._setDefault(numFeatures=100, gamma="scale", seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        cols = self.getOrDefault(self.inputCols)
        d = len(cols)
        gamma = kernel_gamma(df, cols, self.getOrDefault(self.gamma))
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        D = self.getOrDefault(self.numFeatures)
        w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(D, d))
        b = rng.uniform(0.0, 2 * math.pi, size=D)
        m = RandomFourierFeaturesModel()
        m._set(inputCols=cols, weights=[float(x) for x in w.ravel()], offsets=[float(x) for x in b])
        return m


class RandomFourierFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "D x d projection, row-major", TypeConverters.toListFloat)
    offsets = Param(Params._dummy(), "offsets", "D phases", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    def output_cols(self):
        return [f"rff_{j}" for j in range(len(self.getOrDefault(self.offsets)))]

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.inputCols)
        w, b = self.getOrDefault(self.weights), self.getOrDefault(self.offsets)
        d, D = len(cols), len(b)
        scale = math.sqrt(2.0 / D)
        outs = []
        for j in range(D):
            z = F.lit(b[j])
            for i, c in enumerate(cols):
                z = z + F.lit(w[j * d + i]) * F.col(c).cast("double")
            outs.append((F.lit(scale) * F.cos(z)).alias(f"rff_{j}"))
        return df.select("*", *outs)


class PlattSVC(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """LinearSVC + Platt scaling fitted on k-fold out-of-fold margins."""

    featureCols = Param(Params._dummy(), "featureCols", "numeric columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    regParam = Param(Params._dummy(), "regParam", "L2 strength", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "folds for calibration", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol=None, regParam=None, maxIter=None, folds=None,
                 seed=None):
        super().__init__()
        self._setDefault(labelCol="label", regParam=0.0, maxIter=100, folds=3, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _svc(self, data):
        return LinearSVC(featuresCol="_x", labelCol="_y", regParam=self.getOrDefault(self.regParam),
                         maxIter=self.getOrDefault(self.maxIter), standardization=False,
                         tol=1e-4).fit(data)

    def _fit(self, df: DataFrame):
        cols = self.getOrDefault(self.featureCols)
        k = self.getOrDefault(self.folds)
        asm = VectorAssembler(inputCols=cols, outputCol="_x")
        base = df.select(*cols, F.col(self.getOrDefault(self.labelCol)).cast("double").alias("_y"))
        data = asm.transform(base).select("_x", "_y", (F.abs(F.xxhash64(*cols, "_y")) % k)
                                          .cast("int").alias("_fold"))
        with persisted(data) as d:
            oof = None
            for i in range(k):
                mdl = self._svc(d.where(F.col("_fold") != i))
                part = mdl.transform(d.where(F.col("_fold") == i)).select(
                    "_y", vector_to_array("rawPrediction")[1].alias("_m"))
                oof = part if oof is None else oof.unionByName(part)
            platt = LogisticRegression(featuresCol="_mv", labelCol="_y", regParam=0.0).fit(
                VectorAssembler(inputCols=["_m"], outputCol="_mv").transform(oof))
            full = self._svc(d)
        m = PlattSVCModel()
        m._set(featureCols=cols, coefficients=[float(x) for x in full.coefficients],
               intercept=float(full.intercept), plattA=float(platt.coefficients[0]),
               plattB=float(platt.intercept))
        return m


class PlattSVCModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    featureCols = Param(Params._dummy(), "featureCols", "numeric columns", TypeConverters.toListString)
    coefficients = Param(Params._dummy(), "coefficients", "SVM weights", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "SVM intercept", TypeConverters.toFloat)
    plattA = Param(Params._dummy(), "plattA", "Platt slope", TypeConverters.toFloat)
    plattB = Param(Params._dummy(), "plattB", "Platt intercept", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        w = dict(zip(self.getOrDefault(self.featureCols), self.getOrDefault(self.coefficients)))
        margin = S.linear_margin(w, self.getOrDefault(self.intercept))
        p1 = S.logistic(F.lit(self.getOrDefault(self.plattA)) * margin
                        + F.lit(self.getOrDefault(self.plattB)))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p1, p1))) \
                 .withColumn("prediction", (p1 > 0.5).cast("double"))


# ---------------------------------------------------------------- factory

def _max_features(v) -> str:
    if v in (None, "None", "auto"):
        return "all"
    if isinstance(v, float) and 0 < v <= 1:
        return str(v)
    return str(v)


def build_stages(name: str, params: dict | None = None, n_train: int = 1, id_col: str = "subject_id",
                 label: str = "label", seed: int = 42) -> list:
    """Pipeline stages (features -> [scaler] -> [kernel map] -> model)."""
    p = dict(BASE_PARAMS.get(name, {}))
    p.update(params or {})
    keep = [id_col, label, "fold", "is_test"]  # pass-through when present
    if name == "catboost":
        growth = {"mode": "oblivious", "rounds": int(p["iterations"]), "max_depth": _depth(p["depth"]), "rate": float(p["learning_rate"]),
                  "l2": float(p.get("l2_leaf_reg", 3.0)), "bins": int(p.get("border_count", 254)),
                  "bagging": float(p.get("bagging_temperature", 1.0)), "seed": seed}
        num = [c for c in NATIVE_FEATURES if c not in NATIVE_CATEGORICAL]
        return [NativeCategoricalFeatures(keepCols=keep),
                BoostedTrees(featureCols=num, categoryCols=NATIVE_CATEGORICAL, labelCol=label, growth=growth)]
    stages: list = [EncodedFeatures(keepCols=keep)]
    cols = list(ENCODED_FEATURES)
    if name in NEEDS_SCALING:
        stages.append(PopulationScaler(inputCols=cols))
    if name == "adaboost":
        stages.append(AdaBoostStumps(featureCols=cols, labelCol=label,
                                     nEstimators=int(p["n_estimators"]),
                                     learningRate=float(p["learning_rate"])))
        return stages
    if name == "knn":
        stages.append(KNearest(featureCols=cols, labelCol=label, k=int(p["n_neighbors"]), weights=p["weights"],
                               p=order_of(p["metric"], p["p"])))
        return stages
    if name == "svm":
        kernel = p.get("kernel", "rbf")
        feat_cols = cols
        if kernel in UNSUPPORTED_KERNELS or kernel not in ("rbf", "linear", "poly"):
            raise ValueError(f"kernel {kernel!r} is not supported")
        if kernel == "poly":
            degree = int(p.get("degree", 3))
            poly = PolynomialKernelFeatures(inputCols=cols, degree=degree,
                                            gamma=str(p.get("gamma", "scale")))
            stages.append(poly)
            n_terms = math.comb(len(cols) + degree - 1, degree)
            feat_cols = [f"poly_{j}" for j in range(n_terms)]
        elif kernel != "linear":
            # rbf: random Fourier features, n_components of them (100)
            rff = RandomFourierFeatures(inputCols=cols, numFeatures=int(p.get("n_components", 100)),
                                        gamma=str(p.get("gamma", "scale")), seed=seed)
            stages.append(rff)
            feat_cols = [f"rff_{j}" for j in range(int(p.get("n_components", 100)))]
        stages.append(PlattSVC(featureCols=feat_cols, labelCol=label,
                               regParam=1.0 / (float(p["C"]) * max(n_train, 1)), seed=seed))
        return stages
    if name == "logistic_regression":
        stages.append(NewtonLogistic(featureCols=cols, labelCol=label, C=float(p["C"]), maxIter=int(p["max_iter"])))
        return stages
    if name in ("xgboost", "lightgbm"):
        growth = {"rounds": int(p["n_estimators"]), "rate": float(p["learning_rate"]), "subsample": float(p.get("subsample", 1.0)),
                  "colsample": float(p.get("colsample_bytree", 1.0)), "l1": float(p.get("reg_alpha", 0.0)), "seed": seed}
        if name == "xgboost":
            growth |= {"mode": "level", "max_depth": _depth(p["max_depth"]), "l2": float(p.get("reg_lambda", 1.0)),
                       "least_hessian": float(p.get("min_child_weight", 1))}
        else:
            growth |= {"mode": "leaf", "max_depth": int(p["max_depth"]), "num_leaves": int(p["num_leaves"]), "l2": float(p.get("reg_lambda", 0.0)),
                       "least_rows": int(p.get("min_child_samples", 20)), "least_hessian": 1e-3, "bins": 255}
        stages.append(BoostedTrees(featureCols=cols, labelCol=label, growth=growth))
        return stages
    stages.append(VectorAssembler(inputCols=cols, outputCol="features"))
    if name == "random_forest":
        depth = p.get("max_depth")
        stages.append(RandomForestClassifier(
            labelCol=label, numTrees=int(p["n_estimators"]),
            maxDepth=_depth(depth) if depth else MAX_TREE_DEPTH,
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            featureSubsetStrategy=_max_features(p.get("max_features", "sqrt")), seed=seed))
    elif name == "mlp":
        hidden = [int(h) for h in p.get("hidden_layer_sizes", [128, 64])]
        stages.append(Perceptron(
            labelCol=label, layers=[len(cols), *hidden, 2], maxIter=int(p.get("max_iter", 100)), seed=seed))
    else:
        raise ValueError(f"unknown learner {name!r}")
    return stages


def positive_probability(scored: DataFrame, prob_col: str = "probability") -> DataFrame:
    """Adds ``prob`` (class-1 probability) and int ``pred``."""
    return scored.withColumn("prob", vector_to_array(F.col(prob_col))[1]) \
                 .withColumn("pred", F.col("prediction").cast("int"))


def indexed_native_stages(keep: Sequence[str] = ()) -> list:
    """Native categoricals as nominal positions of a feature vector, for learners that split on categories."""
    num = [c for c in NATIVE_FEATURES if c not in NATIVE_CATEGORICAL]
    return [NativeCategoricalFeatures(keepCols=list(keep)),
            *[StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in NATIVE_CATEGORICAL],
            VectorAssembler(inputCols=[f"{c}_idx" for c in NATIVE_CATEGORICAL] + num, outputCol="features")]


def categorical_indices(df: DataFrame, features_col: str = "features") -> dict[str, int]:
    """Positions of nominal (categorical) features inside an assembled vector,
    read from the ML attribute metadata that ``StringIndexer`` and
    ``VectorAssembler`` attach -- no data is scanned."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    nominal = meta.get("attrs", {}).get("nominal", [])
    return {a["name"]: int(a["idx"]) for a in nominal}
