"""Second-order (Newton) boosting of log loss with histogram trees, as Spark jobs.

Rows are binned once (exact counts cut every feature into at most ``bins`` ranges), packed into blocks of numpy arrays, written
and kept in memory and on disk.  A histogram holds the sums of gradients, hessians and rows per (node, feature, bin); one job
gives those of all nodes that are wanted: each task adds up its blocks, a shuffle by node adds up the tasks, and only histograms
reach the driver, whose size doesn't depend on the rows.  Of two siblings only the one with fewer rows is counted, the other is
its parent minus that one.

Trees grow ``level`` by level to ``max_depth``; ``leaf``-wise, always splitting the leaf of the largest gain until
``num_leaves`` (a job counts the children of all open leaves ahead, so there are about as many jobs as levels, and the tree is the
same as with one job a split); or ``oblivious``, with one split per level for all of its nodes.

    gain = (T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2)) / 2,  leaf = -rate * T(G) / (H + l2),
    T(G) = G less ``l1`` towards 0

Row samples and weights come from a hash of the row and the tree, column samples from a seeded draw, so a lost task gives the
same histogram again.  A null or NaN lies in the last bin, right of every split.  Gains are rounded to 10 digits; ties go to the
smallest node, feature and cut.

``OrderedStatistics`` replaces a categorical value by the smoothed mean label of the rows with this value that come before the row
in a hashed order (its own label and later ones are never used); scoring takes all rows' means.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions.ranges import running_totals
from scoreflow.session import written

RENEW = 10  # trees after which the margins so far are stored with the rows
BLOCKS = "bins binary, y binary, key binary, margin binary"
LEAST_GAIN = 1e-9


@dataclass
class Growth:
    """How trees are grown."""
    mode: str = "level"
    rounds: int = 100
    rate: float = 0.1
    max_depth: int = 6  # -1: no limit (leaf mode)
    num_leaves: int = 31
    l1: float = 0.0
    l2: float = 1.0
    least_hessian: float = 0.0
    least_rows: int = 1
    subsample: float = 1.0
    colsample: float = 1.0
    bagging: float = 0.0  # exponent of Bayesian bootstrap weights
    bins: int = 256
    seed: int = 42


@dataclass
class Tree:
    """Node arrays; ``bin < 0`` is a leaf, else bins up to ``bin`` go left."""
    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self) -> int:
        for held, x in ((self.feature, 0), (self.bin, -1), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            held.append(x)
        return len(self.bin) - 1

    def split(self, node: int, feature: int, bin_: int) -> tuple[int, int]:
        self.feature[node], self.bin[node] = feature, bin_
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left, right = (np.array(a) for a in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins), int)
        rows = np.arange(len(bins))
        while len(rows):
            rows = rows[cut[at[rows]] >= 0]
            n = at[rows]
            at[rows] = np.where(bins[rows, feature[n]] <= cut[n], left[n], right[n])
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(bins)]


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per key and salt (splitmix64)."""
    x = keys.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53) + 2.0 ** -54


# ---------------------------------------------------------------- bins
def cuts_of(rows: DataFrame, n_features: int, bins: int) -> list[list[float]]:
    """Upper ends of each feature's bins: a value whose rows before it are a share s of all lies in bin floor(s * bins)."""
    cells = rows.select(F.posexplode("x").alias("f", "v")).where(F.col("v").isNotNull() & ~F.isnan("v")) \
        .groupBy("f", "v").agg(F.count(F.lit(1)).alias("c"))
    at = running_totals(cells, ["f"], "v", ["c"])
    ends = at.groupBy("f", F.expr(f"c_before * {bins} div c_total").alias("b")).agg(F.max("v").alias("v")).collect()
    out: list[list[float]] = [[] for _ in range(n_features)]
    for r in ends:
        out[r["f"]].append(r["v"])
    return [sorted(c) for c in out]


def binned(x: np.ndarray, cuts) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1).astype(np.uint16)


def row_blocks(rows: DataFrame, cuts, base: float) -> DataFrame:
    def pack(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float)
            cells = (binned(x, cuts), b.column("y").to_numpy().astype(np.int8), b.column("key").to_numpy(), np.full(b.num_rows, base))
            yield pa.record_batch({n: pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for n, c in zip(("bins", "y", "key", "margin"), cells)})

    keyed = rows.select("x", "y", F.xxhash64("x", "y", F.monotonically_increasing_id()).alias("key"))
    return written(keyed.mapInArrow(pack, BLOCKS), "boost-rows")


def _opened(batch, n_features: int, trees):
    for bins, y, key, margin in zip(*(batch.column(c) for c in ("bins", "y", "key", "margin"))):
        bins = np.frombuffer(bins.as_buffer(), np.uint16).reshape(-1, n_features)
        m = np.frombuffer(margin.as_buffer(), float)
        for t in trees:
            m = m + t.margins(bins)
        yield bins, np.frombuffer(y.as_buffer(), np.int8), np.frombuffer(key.as_buffer(), np.int64), m


# ---------------------------------------------------------------- growing
class Grower:
    """Grows one tree after the other over persisted blocks."""

    def __init__(self, blocks: DataFrame, widths: list[int], g: Growth):
        self.blocks, self.widths, self.g = blocks, widths, g
        self.n = len(widths)
        self.offset = np.concatenate([[0], np.cumsum([w + 1 for w in widths])])  # one more bin for what lies beyond the last cut

    def histograms(self, tree: Tree, nodes: list[int], recent, round_: int) -> dict[int, np.ndarray]:
        """Sums of (gradient, hessian, rows) per bin of all features, for each of the nodes, which are leaves so far."""
        offset, n, g = self.offset, self.n, self.g
        size = int(offset[-1])

        def count(batches):
            total = np.zeros((len(nodes), 3, size))
            slot_of = np.full(len(tree.bin), -1)
            slot_of[nodes] = np.arange(len(nodes))
            for b in batches:
                for bins, y, key, margin in _opened(b, n, recent):
                    slot = slot_of[tree.nodes_of(bins)]
                    keep = slot >= 0
                    if g.subsample < 1:
                        keep &= uniform(key, g.seed + 2 * round_) < g.subsample
                    bins, y, margin, slot, key = bins[keep], y[keep], margin[keep], slot[keep], key[keep]
                    p = 1 / (1 + np.exp(-margin))
                    grad, hess = p - y, p * (1 - p)
                    if g.bagging > 0:
                        w = (-np.log(uniform(key, g.seed + 2 * round_ + 1))) ** g.bagging
                        grad, hess = grad * w, hess * w
                    for j in range(n):
                        at = slot * size + offset[j] + bins[:, j]
                        for k, w in enumerate((grad, hess, None)):
                            total[:, k] += np.bincount(at, w, len(nodes) * size).reshape(len(nodes), size)
            yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "h": pa.array([t.tobytes() for t in total], pa.binary())})

        def add(batches):
            sums = {}
            for b in batches:
                for node, h in zip(b.column("node").to_pylist(), b.column("h")):
                    h = np.frombuffer(h.as_buffer(), float)
                    sums[node] = sums[node] + h if node in sums else h
            yield pa.record_batch({"node": pa.array(list(sums), pa.int64()), "h": pa.array([s.tobytes() for s in sums.values()], pa.binary())})

        kind = "node long, h binary"
        got = self.blocks.mapInArrow(count, kind).repartition(min(len(nodes), 64), "node").mapInArrow(add, kind).toArrow()
        return {k: np.frombuffer(h.as_buffer(), float).reshape(3, size) for k, h in
                zip(got.column("node").to_pylist(), got.column("h"))}

    def gains(self, h: np.ndarray, features) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per feature: (feature, gain of every cut, sums left of it); a cut that is not allowed has gain -inf."""
        g, out = self.g, []
        for j in features:
            part = h[:, self.offset[j]:self.offset[j + 1]]
            left = part.cumsum(1)[:, :-1]
            whole = part.sum(1, keepdims=True)
            right = whole - left
            gain = 0.5 * (score(left, g) + score(right, g) - score(whole, g))
            low = (np.minimum(left[1], right[1]) < g.least_hessian) | (np.minimum(left[2], right[2]) < max(g.least_rows, 1))
            out.append((j, np.where(low, -np.inf, np.round(gain, 10)), left))
        return out

    def best(self, h: np.ndarray, features):
        """(gain, feature, bin, sums left) of the best split, or None."""
        found = None
        for j, gain, left in self.gains(h, features):
            if gain.size and (k := int(gain.argmax())) >= 0 and gain[k] > LEAST_GAIN and (found is None or gain[k] > found[0]):
                found = (float(gain[k]), j, k, left[:, k])
        return found

    def leaf(self, sums: np.ndarray) -> float:
        return -self.g.rate * float(soft(sums[0], self.g.l1)) / (float(sums[1]) + self.g.l2) if sums[1] + self.g.l2 > 0 else 0.0

    def children(self, tree: Tree, parents: list[tuple[int, tuple, np.ndarray]], recent, round_: int) -> dict[int, np.ndarray]:
        """Histograms of both children of every (node, split, histogram), of which the smaller ones are counted."""
        small = {}
        for node, split, h in parents:
            rows = h[2, self.offset[0]:self.offset[1]].sum()
            small[node] = tree.left[node] if split[3][2] * 2 <= rows else tree.right[node]
        counted = self.histograms(tree, sorted(small.values()), recent, round_)
        out = {}
        for node, _, h in parents:
            a, b = tree.left[node], tree.right[node]
            mine = counted[small[node]]
            out[a], out[b] = (mine, h - mine) if small[node] == a else (h - mine, mine)
        return out

    def grow(self, recent, round_: int) -> tuple[Tree, list[tuple]]:
        """A tree and its splits in the order made: (node, feature, bin, gain, sums left, sums right)."""
        g, tree = self.g, Tree()
        root = tree.add()
        k = max(1, round(g.colsample * self.n)) if g.colsample < 1 else self.n
        features = sorted(np.random.default_rng([g.seed, round_]).permutation(self.n)[:k].tolist())
        hist = {root: self.histograms(tree, [root], recent, round_)[root]}
        sums = {root: hist[root][:, self.offset[0]:self.offset[1]].sum(1)}
        grow = {"level": self._levels, "oblivious": self._levels, "leaf": self._leaves}[g.mode]
        made = grow(tree, features, hist, sums, recent, round_)
        for node in range(len(tree.bin)):
            if tree.bin[node] < 0 and node in sums:
                tree.value[node] = self.leaf(sums[node])
        return tree, made

    def _made(self, tree, sums, node, split):
        gain, f, b, left = split
        a, c = (tree.left[node], tree.right[node]) if tree.bin[node] >= 0 else tree.split(node, f, b)
        sums[a], sums[c] = left, sums[node] - left
        return (node, f, b, gain, left, sums[c])

    def _levels(self, tree, features, hist, sums, recent, round_):
        made, front = [], [0]
        for depth in range(self.g.max_depth):
            if self.g.mode == "level":
                splits = {n: s for n in front if (s := self.best(hist[n], features))}
            else:
                splits = self._one_split(hist, front, features)
            if not splits:
                break
            for n, s in splits.items():
                made.append(self._made(tree, sums, n, s))
            if depth + 1 < self.g.max_depth:  # the last level's sums are known
                hist = self.children(tree, [(n, s, hist[n]) for n, s in splits.items()], recent, round_)
            front = [c for n in splits for c in (tree.left[n], tree.right[n])]
        return made

    def _one_split(self, hist, front, features):
        """The cut of the largest total gain over all nodes, made in every node."""
        total = None
        per = {n: self.gains(hist[n], features) for n in front}
        for i, j in enumerate(features):
            gain = sum(np.where(np.isfinite(per[n][i][1]), per[n][i][1], 0.0) for n in front)
            if gain.size and gain.max() > LEAST_GAIN and (total is None or round(gain.max(), 10) > total[0]):
                total = (round(float(gain.max()), 10), i, j, int(gain.argmax()))
        if total is None:
            return {}
        _, i, j, k = total
        return {n: (float(per[n][i][1][k]), j, k, per[n][i][2][:, k]) for n in front}

    def _leaves(self, tree, features, hist, sums, recent, round_):
        g, made, depth = self.g, [], {0: 0}
        ready: dict[int, np.ndarray] = dict(hist)
        open_: list[tuple] = []
        splits: dict[int, tuple] = {}

        def consider(node):
            if (g.max_depth < 0 or depth[node] < g.max_depth) and (s := self.best(ready[node], features)):
                splits[node] = s
                heapq.heappush(open_, (-s[0], node))

        consider(0)
        ahead: dict[int, tuple[int, int]] = {}
        while open_ and len(made) + 1 < g.num_leaves:
            node = heapq.heappop(open_)[1]
            s = splits[node]
            if len(made) + 2 >= g.num_leaves:  # the last split: its children's sums are known
                made.append(self._made(tree, sums, node, s))
                break
            if node not in ahead:
                # children of all open leaves at once; a leaf that is not split in the end becomes one again
                todo = [node, *sorted(n for _, n in open_ if n not in ahead)][:g.num_leaves]
                for n in todo:
                    ahead[n] = tree.split(n, splits[n][1], splits[n][2])
                ready.update(self.children(tree, [(n, splits[n], ready[n]) for n in todo], recent, round_))
            made.append(self._made(tree, sums, node, s))
            for c in ahead[node]:
                depth[c] = depth[node] + 1
                consider(c)
        done = {m[0] for m in made}
        for n in ahead:
            if n not in done:
                tree.bin[n] = -1
        return made


def soft(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def score(sums, g: Growth):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(sums[1] + g.l2 > 0, soft(sums[0], g.l1) ** 2 / (sums[1] + g.l2), 0.0)


def boost(rows: DataFrame, n_features: int, g: Growth):
    """``rows``: x array<double>, y int.  Returns (base margin, cuts, trees, splits of each tree)."""
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    p = ((ones or 0) + 1e-9) / (n + 2e-9) if n else 0.5
    base = math.log(p / (1 - p))
    cuts = cuts_of(rows, n_features, g.bins)
    blocks = row_blocks(rows, cuts, base).persist(StorageLevel.MEMORY_AND_DISK)
    trees, recent, splits = [], [], []
    try:
        for t in range(g.rounds if n else 0):
            tree, made = Grower(blocks, [len(c) for c in cuts], g).grow(list(recent), t)
            trees.append(tree)
            splits.append(made)
            recent.append(tree)
            if len(recent) == RENEW and t + 1 < g.rounds:
                renewed = _renewed(blocks, n_features, list(recent)).persist(StorageLevel.MEMORY_AND_DISK)
                renewed.count()
                blocks.unpersist()
                blocks, recent = renewed, []
    finally:
        blocks.unpersist()
    return base, cuts, trees, splits


def _renewed(blocks: DataFrame, n_features: int, trees) -> DataFrame:
    def run(batches):
        for b in batches:
            margins = [m.tobytes() for _, _, _, m in _opened(b, n_features, trees)]
            yield pa.record_batch({**{c: b.column(c) for c in ("bins", "y", "key")}, "margin": pa.array(margins, pa.binary())})
    return blocks.mapInArrow(run, BLOCKS)


# ---------------------------------------------------------------- ordered target statistics
def ordered_statistics(rows: DataFrame, cat: str, label: str, order: str, prior: float, strength: float = 1.0) -> DataFrame:
    """``rows`` with ``<cat>_ts``: (labels before + strength * prior) / (rows before + strength), before: the rows of the same
    category with a smaller ``order`` (distinct).  A category of any size is summed range by range."""
    sums = running_totals(rows.select("*", F.col(label).cast("long").alias("_ts_y"), F.lit(1).cast("long").alias("_ts_n")), [cat], order, ["_ts_y", "_ts_n"])
    stat = (F.col("_ts_y_before") + F.lit(strength * prior)) / (F.col("_ts_n_before") + F.lit(strength))
    return sums.select(*rows.columns, stat.alias(f"{cat}_ts"))


def category_means(rows: DataFrame, cat: str, label: str, prior: float, strength: float = 1.0) -> DataFrame:
    """One row per category: its smoothed mean label over all rows."""
    return rows.groupBy(cat).agg(((F.sum(label) + F.lit(strength * prior)) / (F.count(F.lit(1)) + F.lit(strength))).alias(f"{cat}_ts"))


# ---------------------------------------------------------------- pipeline stages
class _Params(Params):
    featureCols = Param(Params._dummy(), "featureCols", "numeric feature columns", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "categorical columns, replaced by ordered target statistics", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    growth = Param(Params._dummy(), "growth", "fields of Growth", TypeConverters.identity)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", categoryCols=[], growth={})


MOST_CATEGORIES = 100_000  # categories whose means a model keeps; more raise an error


class BoostedTrees(Estimator, _Params, DefaultParamsReadable, DefaultParamsWritable):
    """Newton-boosted trees over ``categoryCols`` (by ordered target statistics) and ``featureCols``."""

    @keyword_only
    def __init__(self, *, featureCols=None, categoryCols=None, labelCol=None, growth=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        cols, cats, label = (self.getOrDefault(p) for p in (self.featureCols, self.categoryCols, self.labelCol))
        g = Growth(**self.getOrDefault(self.growth))
        rows = df.select(*cols, *[F.col(c).cast("string").alias(c) for c in cats], (F.col(label) == 1).cast("int").alias("_y")).na.fill(0, ["_y"])
        prior, means = 0.5, {}
        if cats:
            rows = written(rows.withColumn("_order", F.struct(F.xxhash64(*cols, *cats, F.lit(g.seed)), F.monotonically_increasing_id())), "boost-input")
            prior = float(rows.agg(F.avg("_y")).first()[0] or 0.0)
            for c in cats:
                found = category_means(rows, c, "_y", prior).limit(MOST_CATEGORIES + 1).collect()
                if len(found) > MOST_CATEGORIES:
                    raise ValueError(f"{c} has more than {MOST_CATEGORIES} categories")
                means[c] = {r[c]: float(r[f"{c}_ts"]) for r in found}
                rows = ordered_statistics(rows, c, "_y", "_order", prior)
        x = F.array(*[F.col(f"{c}_ts") for c in cats], *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
        base, cuts, trees, _ = boost(rows.select(x.alias("x"), F.col("_y").alias("y")), len(cats) + len(cols), g)
        m = BoostedTreesModel()
        self._copyValues(m)
        return m._set(state={"base": base, "prior": prior, "cuts": cuts, "trees": [vars(t) for t in trees],
                             "means": {c: [[k, v] for k, v in mine.items()] for c, mine in means.items()}})


class BoostedTreesModel(Model, _Params, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "base margin, cuts, trees and category means", TypeConverters.identity)

    def __init__(self):
        super().__init__()

    def margin(self) -> F.Column:
        state = self.getOrDefault(self.state)
        cols, cats = self.getOrDefault(self.featureCols), self.getOrDefault(self.categoryCols)
        trees, cuts, base = [Tree(**t) for t in state["trees"]], state["cuts"], state["base"]
        means = {c: dict(map(tuple, mine)) for c, mine in state["means"].items()}
        prior, n_cats = state["prior"], len(cats)

        @F.pandas_udf("double")
        def score_(*columns: pd.Series) -> pd.Series:
            x = [s.map(lambda v, m=means[c]: m.get(v, prior)) for s, c in zip(columns[:n_cats], cats)] + list(columns[n_cats:])
            bins = binned(np.stack([np.asarray(c, float) for c in x], 1), cuts)
            return pd.Series(base + sum((t.margins(bins) for t in trees), np.zeros(len(bins))))

        return score_(*[F.col(c).cast("string") for c in cats], *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])

    def _transform(self, df: DataFrame) -> DataFrame:
        p1 = 1.0 / (1.0 + F.exp(-F.col("_margin")))
        return df.withColumn("_margin", self.margin()).withColumn("probability", array_to_vector(F.array(1.0 - p1, p1))) \
            .withColumn("prediction", (F.col("_margin") > 0).cast("double")).drop("_margin")
