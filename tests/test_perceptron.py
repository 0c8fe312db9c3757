import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.linalg import Vectors

from scoreflow.operators import perceptron as P


def data(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    return x, ((x[:, 0] * x[:, 1] + x[:, 2]) > 0).astype(int)


def test_gradient_is_the_slope_of_the_loss():
    x, y = data(50)
    layers = [4, 6, 3, 2]
    w = np.random.default_rng(2).normal(size=4 * 6 + 6 + 6 * 3 + 3 + 3 * 2 + 2)
    _, g = P.loss_and_gradient(x, y, w, layers)
    for i in range(0, len(w), 5):
        e = np.zeros(len(w))
        e[i] = 1e-6
        slope = (P.loss_and_gradient(x, y, w + e, layers)[0] - P.loss_and_gradient(x, y, w - e, layers)[0]) / 2e-6
        assert g[i] == pytest.approx(slope, abs=1e-4)


def test_all_rows_over_blocks_and_spark_scores_with_the_weights(spark, monkeypatch):
    """Blocks give the sums of the whole, the fit reaches a lower loss than Spark's start, and Spark's model has the same outputs."""
    monkeypatch.setattr(P, "BLOCK_ROWS", 64)
    x, y = data()
    layers = [4, 8, 2]
    df = spark.createDataFrame([(Vectors.dense(a), int(b)) for a, b in zip(x, y)], ["features", "label"])
    blocks = P.packed(spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int"))
    w = np.random.default_rng(3).normal(size=4 * 8 + 8 + 8 * 2 + 2)
    loss, grad = P.evaluate(blocks, w, layers)
    whole, slope = P.loss_and_gradient(x, y, w, layers)
    assert loss == pytest.approx(whole / len(y), rel=1e-5) and np.allclose(grad, slope / len(y), atol=1e-5)
    m = P.Perceptron(layers=layers, maxIter=60, seed=1).fit(df)
    assert isinstance(m, MultilayerPerceptronClassificationModel)
    fitted = np.array(m.weights.toArray())
    mine = P.loss_and_gradient(x, y, fitted, layers)[0] / len(y)
    p = np.array([r["probability"].toArray() for r in m.transform(df).select("probability").collect()])
    assert mine < 0.2 and -np.log(p[np.arange(len(y)), y]).mean() == pytest.approx(mine, rel=1e-6)


def plain(x, y, flat, layers):
    """Mean loss and gradient, written out as the formulas stand."""
    net = P.unpack(flat, layers)
    held = [x]
    for w, b in net[:-1]:
        held.append(1 / (1 + np.exp(-(held[-1] @ w + b))))
    z = held[-1] @ net[-1][0] + net[-1][1]
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    delta, parts = p - np.eye(p.shape[1])[y], []
    for i in range(len(net) - 1, -1, -1):
        parts = [(held[i].T @ delta).ravel(), delta.sum(0), *parts]
        if i:
            delta = (delta @ net[i][0].T) * held[i] * (1 - held[i])
    return -np.log(p[np.arange(len(y)), y]).mean(), np.concatenate(parts) / len(y)


@pytest.mark.parametrize("layers", [[4, 2], [4, 7, 2], [4, 9, 5, 3]])
def test_a_step_is_one_pass_with_a_task_per_core(spark, monkeypatch, layers):
    """Uneven blocks, any number of layers and classes; what a task returns depends on the weights alone."""
    monkeypatch.setattr(P, "PART_ROWS", 10)
    monkeypatch.setattr(P, "BLOCK_ROWS", 7)
    x, _ = data()
    y = np.arange(len(x)) % layers[-1]
    blocks = P.packed(spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int"))
    assert blocks.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sum(len(b) for _, b in blocks.collect()) == len(y) and max(len(b) for _, b in blocks.collect()) == 7
    w = np.random.default_rng(4).normal(size=sum(a * b + b for a, b in zip(layers, layers[1:])))
    (loss, grad), (want, slope) = P.evaluate(blocks, w, layers), plain(x, y, w, layers)
    assert loss == pytest.approx(want, rel=1e-5) and np.allclose(grad, slope, atol=1e-5)


def test_saturated_units_stay_finite():
    x, y = data(40)
    w = np.random.default_rng(6).normal(size=4 * 6 + 6 + 6 * 2 + 2) * 300
    loss, grad = P.loss_and_gradient(x.astype(np.float32), y, w, [4, 6, 2])
    assert np.isfinite(loss) and np.isfinite(grad).all()
