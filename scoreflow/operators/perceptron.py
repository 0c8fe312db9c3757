"""Multilayer perceptron: Spark's network (sigmoid layers, softmax, mean cross-entropy) and method (L-BFGS over all rows, ten
corrections), with losses and gradients of blocks of rows worked out by numpy inside the tasks.

Rows are packed once into blocks of ``BLOCK_ROWS`` (kept in memory and on disk).  Each evaluation is one narrow pass: a task streams its
blocks, holding a few at a time, and returns one sum of losses and gradients; there is a task per core, so what reaches the driver
depends on the weights and cores, not on the rows.  A pass over an RDD, which has no plan to be made: a step of a small table is mostly
what a job costs.  Blocks are single, sums double precision.  It stops like Spark's: after ``maxIter``
steps, or when the loss of the last steps changes by no more than ``tol`` of the first, or with the gradient at ``tol``.  The fitted
model is Spark's own, so scoring and saving are too.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 512  # their activations stay in the cache
PART_ROWS = 20_000  # fewer rows are not worth a task
CORRECTIONS = 10
MEMORY = 20  # steps over which the loss must have stopped changing


def unpack(flat: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights in x out, bias) per layer, in the order in which Spark keeps them."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


class Sums:
    """Summed cross-entropy and gradient of the blocks that were added, all at the same weights.

    A sigmoid is (1 + t) / 2 with t = tanh(z / 2): layers hold t, and halves and ones are moved into the weights of the layers around,
    so a block takes few passes over its activations, which lie in buffers used again for the next block."""

    def __init__(self, flat: np.ndarray, layers: list[int], dtype=np.float32):
        self.layers, self.dtype, last = layers, dtype, len(layers) - 2
        self.forth, self.back = [], []
        for i, (w, b) in enumerate(unpack(np.asarray(flat, float), layers)):
            w, b, half = (w / 2, b + w.sum(0) / 2, w / 4) if i else (w, b, None)
            scale = 1.0 if i == last else 0.5
            self.forth.append(((w * scale).astype(dtype), (b * scale).astype(dtype)))
            self.back.append(None if half is None else np.ascontiguousarray(half.T, dtype))
        self.n, self.loss = 0, 0.0
        self.held = [(np.zeros((a, b)), np.zeros(b)) for a, b in zip(layers, layers[1:])]
        self.buffers = []

    def _room(self, rows: int) -> None:
        if not self.buffers or len(self.buffers[0][0]) < rows:
            self.buffers = [tuple(np.empty((rows, m), self.dtype) for _ in range(3)) for m in self.layers[1:-1]]
            self.ones = np.ones(rows, self.dtype)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        n = len(y)
        self._room(n)
        acts = [x]
        for (w, b), (t, _, _) in zip(self.forth, self.buffers):
            t = t[:n]
            np.matmul(acts[-1], w, out=t)
            t += b
            acts.append(np.tanh(t, out=t))
        w, b = self.forth[-1]
        z = np.matmul(w.T, acts[-1].T)  # a row per class
        z += b[:, None]
        z -= z.max(0)
        delta = np.exp(z)
        total = delta.sum(0)
        rows = np.arange(n)
        self.n += n
        self.loss += float((np.log(total) - z[y, rows]).sum(dtype=float))
        delta /= total
        delta[y, rows] -= 1
        delta = delta.T
        for i in range(len(acts) - 1, -1, -1):
            weights, bias = self.held[i]
            weights += acts[i].T @ delta
            bias += self.ones[:n] @ delta
            if i:
                t, (_, u, slope) = acts[i], self.buffers[i - 1]
                u, slope = u[:n], slope[:n]
                np.matmul(delta, self.back[i], out=u)
                np.multiply(t, t, out=slope)
                np.subtract(1, slope, out=slope)
                delta = np.multiply(u, slope, out=u)

    def gradient(self) -> np.ndarray:
        return np.concatenate([part for i, (w, b) in enumerate(self.held) for part in (((w + b) / 2 if i else w).ravel(), b)])


def loss_and_gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows and its gradient, in the precision of ``x``."""
    sums = Sums(flat, layers, x.dtype)
    sums.add(x, y)
    return sums.loss, sums.gradient()


def packed(rows: DataFrame) -> RDD:
    """``rows``: x array<double>, y int, as blocks (single-precision matrix, classes), one part per core."""
    def pack(batches):
        for b in batches:
            y = b.column("y").to_numpy().astype(np.int32)
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1).astype(np.float32)
            for i in range(0, len(y), BLOCK_ROWS):
                s = slice(i, i + BLOCK_ROWS)
                yield pa.record_batch({"x": pa.array([x[s].tobytes()], pa.binary()), "y": pa.array([y[s].tobytes()], pa.binary())})

    def matrices(found):
        for r in found:
            y = np.frombuffer(r["y"], np.int32)
            yield np.frombuffer(r["x"], np.float32).reshape(len(y), -1), y

    most = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(most, -(-rows.count() // PART_ROWS)))
    return rows.repartition(parts).mapInArrow(pack, "x binary, y binary").rdd.mapPartitions(matrices)


def evaluate(blocks: RDD, flat: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """Mean loss over all rows and its gradient."""
    def run(found):
        sums = Sums(flat, layers)
        for x, y in found:
            sums.add(x, y)
        yield sums.n, sums.loss, sums.gradient()

    found = blocks.mapPartitions(run).collect()
    n = sum(r[0] for r in found)
    return sum(r[1] for r in found) / n, sum(r[2] for r in found) / n


def dot(a: np.ndarray, b: np.ndarray) -> float:
    """Without the linear algebra library, whose threads would wait for work on the cores that the next step needs."""
    return float((a * b).sum())


def minimise(f, w: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """L-BFGS; ``f`` gives value and gradient.  A step is halved until it lowers the value enough."""
    value, grad = f(w)
    first, seen, pairs = abs(value), deque([value], MEMORY), deque(maxlen=CORRECTIONS)
    for step in range(steps):
        norm = dot(grad, grad) ** 0.5
        if norm <= max(tol * value, 1e-8):
            break
        d, a = -grad, []
        for s, y, sy in reversed(pairs):
            a.append(dot(s, d) / sy)
            d = d - a[-1] * y
        if pairs:
            _, y, sy = pairs[-1]
            d = d * (sy / dot(y, y))
        for (s, y, sy), c in zip(pairs, reversed(a)):
            d = d + (c - dot(y, d) / sy) * s
        rate, slope = (1.0 if pairs else 1 / max(norm, 1.0)), dot(grad, d)
        for _ in range(20):
            new_value, new_grad = f(w + rate * d)
            if new_value <= value + 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = rate * d, new_grad - grad
        if dot(s, y) > 1e-12:
            pairs.append((s, y, dot(s, y)))
        w, value, grad = w + s, new_value, new_grad
        if abs(value - max(seen)) <= tol * first:
            break
        seen.append(value)
    return w


class Perceptron(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "classes, from 0", TypeConverters.toString)
    layers = Param(Params._dummy(), "layers", "sizes of the layers", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "steps", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "share of the first loss", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the first weights", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol=None, labelCol=None, layers=None, maxIter=None, tol=None, seed=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, tol=1e-6, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        features, label, layers = (self.getOrDefault(p) for p in (self.featuresCol, self.labelCol, self.layers))
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        # drawn as Spark draws them
        w = np.concatenate([(rng.random(a * b + b) * 4.8 - 2.4) / a for a, b in zip(layers, layers[1:])])
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
        blocks = packed(rows).persist(StorageLevel.MEMORY_AND_DISK_DESER)  # read in every step
        try:
            w = minimise(lambda at: evaluate(blocks, at, layers), w, self.getOrDefault(self.maxIter), self.getOrDefault(self.tol))
        finally:
            blocks.unpersist()
        # no step: the model is made from the weights
        return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers, maxIter=0,
                                              initialWeights=Vectors.dense(w)).fit(df)
