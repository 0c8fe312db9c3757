"""L2-penalised logistic regression by Newton steps (iteratively reweighted least squares).

Minimises  sum(log loss) + |w|^2 / (2 C)  with a free intercept.  A step is one aggregate over the rows: the weighted Gram
matrix, the gradient and the loss, (d + 1)(d + 2) / 2 + d + 2 sums of built-in expressions, of which one row reaches the
driver.  Rows with a null or NaN feature or label take no part.  A step that raises the loss is halved; a singular matrix is
solved by least squares.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions import scalars as S
from scoreflow.operators.features import persisted


def gram(rows: DataFrame, d: int, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(X'WX, X'(y - p), log loss, rows) at ``beta``; ``rows``: x0 .. x<d-1> (x0 is 1), y."""
    margin = sum((F.lit(float(b)) * F.col(f"x{i}") for i, b in enumerate(beta)), F.lit(0.0))
    at = rows.withColumn("_m", margin).withColumn("_p", S.logistic(F.col("_m")))
    w, r = F.col("_p") * (1 - F.col("_p")), F.col("y") - F.col("_p")
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    # log(1 + exp(m)) - y m, safe for large m
    loss = F.greatest(F.col("_m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_m"))) - F.col("y") * F.col("_m")
    got = at.agg(*[F.sum(w * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs], *[F.sum(r * F.col(f"x{i}")) for i in range(d)],
                 F.sum(loss), F.count(F.lit(1))).first()
    h = np.zeros((d, d))
    for (i, j), v in zip(pairs, got):
        h[i, j] = h[j, i] = v or 0.0
    return h, np.array([v or 0.0 for v in got[len(pairs):-2]], float), float(got[-2] or 0.0), got[-1]


def newton(rows: DataFrame, d: int, penalty: float, max_iter: int = 100, tol: float = 1e-9) -> tuple[np.ndarray, int]:
    """Coefficients (the first is the intercept, not penalised) and the number of steps."""
    shrink = np.full(d, penalty)
    shrink[0] = 0.0
    beta = np.zeros(d)
    h, g, loss, n = gram(rows, d, beta)
    if not n:
        return beta, 0
    for step in range(1, max_iter + 1):
        a, b = h + np.diag(shrink), g - shrink * beta
        try:
            move = np.linalg.solve(a, b)
        except np.linalg.LinAlgError:
            move = np.linalg.lstsq(a, b, rcond=None)[0]
        for _ in range(30):
            new = beta + move
            h, g, after, _ = gram(rows, d, new)
            if after + 0.5 * (shrink * new ** 2).sum() <= loss + 0.5 * (shrink * beta ** 2).sum() + 1e-9 * (1 + abs(loss)):
                break
            move = move / 2
        beta, loss = new, after
        if np.abs(move).max() < tol:
            break
    return beta, step


class _Params(Params):
    featureCols = Param(Params._dummy(), "featureCols", "numeric feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "Newton steps", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", C=1.0, maxIter=100)


class NewtonLogistic(Estimator, _Params, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, featureCols=None, labelCol=None, C=None, maxIter=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        cols = self.getOrDefault(self.featureCols)
        rows = df.select(F.lit(1.0).alias("x0"), *[F.col(c).cast("double").alias(f"x{i + 1}") for i, c in enumerate(cols)],
                         F.col(self.getOrDefault(self.labelCol)).cast("double").alias("y"))
        for c in rows.columns[1:]:
            rows = rows.where(F.col(c).isNotNull() & ~F.isnan(c))
        with persisted(rows) as r:
            beta, _ = newton(r, len(cols) + 1, 1.0 / self.getOrDefault(self.C), self.getOrDefault(self.maxIter))
        m = NewtonLogisticModel()
        self._copyValues(m)
        return m._set(intercept=float(beta[0]), coefficients=[float(b) for b in beta[1:]])


class NewtonLogisticModel(Model, _Params, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = Param(Params._dummy(), "coefficients", "weights of the features", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        weights = dict(zip(self.getOrDefault(self.featureCols), self.getOrDefault(self.coefficients)))
        p1 = S.logistic(S.linear_margin(weights, self.getOrDefault(self.intercept)))
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p1, p1))).withColumn("prediction", (p1 > 0.5).cast("double"))
