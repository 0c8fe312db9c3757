"""AdaBoost (SAMME) with decision stumps on presorted attribute lists.

Equal rows (same features and label) are collapsed to one with a count.  A feature with few distinct values (``MOST_CODES``) is narrow:
its value is kept as a code, and a sum of weights per (code, class) holds all that a stump on it needs.  Every other feature is wide
and has a list of the rows, sorted by its value: range-partitioned by (value, hash), so that one value that holds most rows
spreads over several parts too, and packed into blocks of numpy arrays, written once and kept in memory and on disk.  The first list
serves the narrow features as well (without wide features the rows lie in any order).  An entry carries its row's codes and
wide values, so its weight is worked out in place: nothing is shuffled in a round.

A round is two narrow passes over the lists.  The first sums the weights of either class per part and list, and per code (a few
numbers per part; codes are added up before they reach the driver), which become running offsets; in the second, for wide features only,
every part tries all of its distinct values as thresholds, exactly, and returns its best.  Best: least weighted Gini impurity, rounded to
12 digits so that ties go by feature and value.  Every ``RENEW`` rounds the weights so far are stored with the lists.

A null is NaN, which sorts last and lies right of every threshold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.session import written

PART_ROWS = 250_000  # entries that one part of a list should hold
BLOCK_ROWS = 16_384
RENEW = 16
MOST_CODES = 4_096  # distinct values of a narrow feature; codes are short integers
LISTS = "part long, seq long, f int, y binary, w binary, codes binary, wide binary"


class Layout:
    """Which features are narrow (with their sorted values; NaN has the code behind them) and which have a list."""

    def __init__(self, values: dict[int, np.ndarray], n_features: int):
        self.values = values
        self.narrow = sorted(values)
        self.wide = [f for f in range(n_features) if f not in values]
        self.column = {f: i for i, f in enumerate(self.narrow)} | {f: i for i, f in enumerate(self.wide)}

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, wide values) of a matrix of rows, one feature per line."""
        codes = np.empty((len(self.narrow), len(x)), np.int16)
        for i, f in enumerate(self.narrow):
            codes[i] = np.searchsorted(self.values[f], x[:, f])  # NaN is beyond all values
        return codes, np.ascontiguousarray(x[:, self.wide].T)

    def left(self, codes: np.ndarray, wide: np.ndarray, f: int, cut: float) -> np.ndarray:
        """Whether x[f] <= cut, per row."""
        at = self.column[f]
        return codes[at] < np.searchsorted(self.values[f], cut, "right") if f in self.values else wide[at] <= cut


def layout_of(cells: DataFrame, n_features: int) -> Layout:
    """Features by their number of distinct values; only values of narrow ones reach the driver."""
    x = [F.coalesce(F.col("x")[i], F.lit(float("nan"))) for i in range(n_features)]
    guess = cells.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(n_features) if guess[i] <= MOST_CODES]
    found = cells.agg(*[F.collect_set(x[i]).alias(f"v{i}") for i in few]).first() if few else []
    values = {i: np.unique(np.array([v for v in held if v == v], float)) for i, held in zip(few, found)}
    return Layout({i: v for i, v in values.items() if len(v) < np.iinfo(np.int16).max}, n_features)


def attribute_lists(rows: DataFrame, n_features: int) -> tuple[DataFrame, float, Layout]:
    """``rows``: x array<double>, y int.  Returns the blocks of all lists, with weights that sum to 1 over the rows."""
    cells = written(rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")), "cells")
    r = cells.agg(F.count(F.lit(1)).alias("m"), F.sum("c").alias("n")).first()
    layout = layout_of(cells, n_features)
    spark = rows.sparkSession
    total = float(r["n"] or 0)
    parts = max(spark.sparkContext.defaultParallelism, -(-r["m"] * max(1, len(layout.wide)) // PART_ROWS))
    at = layout.wide or [-1]
    long = cells.select(F.explode(F.lit(at)).alias("f"), "x", "y", "c") \
        .withColumn("v", F.when(F.col("f") >= 0, F.coalesce(F.get("x", F.col("f")), F.lit(float("nan")))))
    dealt = long.repartitionByRange(parts, "f", "v", F.xxhash64("x", "y")).sortWithinPartitions("f", "v") \
        .withColumn("part", F.spark_partition_id().cast("long"))

    def pack(batches):
        seq = 0
        for b in batches:
            f, part = b.column("f").to_numpy(), b.column("part").to_numpy()
            y, w = b.column("y").to_numpy().astype(np.int8), b.column("c").to_numpy() / total
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(f), -1)
            edges = np.flatnonzero(np.diff(f)) + 1
            for i, j in zip([0, *edges], [*edges, len(f)]):
                for k in range(i, j, BLOCK_ROWS):
                    s = slice(k, min(j, k + BLOCK_ROWS))
                    codes, wide = layout.split(x[s])
                    yield pa.record_batch({
                        "part": pa.array([part[k]]), "seq": pa.array([seq], pa.int64()), "f": pa.array([f[k]], pa.int32()),
                        **{name: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary())
                           for name, a in (("y", y[s]), ("w", w[s]), ("codes", codes), ("wide", wide))}})
                    seq += 1

    return written(dealt.select("part", "f", "x", "y", "c").mapInArrow(pack, LISTS), "lists"), total, layout


def _blocks(batch, layout: Layout):
    """(part, seq, f, labels, weights, codes, wide values) of the blocks of a batch."""
    for part, seq, f, *cells in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "f")),
                                    *(batch.column(c) for c in ("y", "w", "codes", "wide"))):
        y, w, codes, wide = (np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, (np.int8, float, np.int16, float)))
        yield part, seq, f, y, w, codes.reshape(len(layout.narrow), len(y)), wide.reshape(len(layout.wide), len(y))


def _runs(batches, layout: Layout, stumps):
    """(part, first block, f, values, labels, weights) of every stretch of one list; the blocks of a file come in order, but a
    task may read several files, or a part of one."""
    held, at, after = [], None, None

    def made():
        v, y, w = (np.concatenate(c) for c in zip(*held))
        return (*at, v, y, w)

    for b in batches:
        for part, seq, f, y, w, codes, wide in _blocks(b, layout):
            if (part, seq, f) != after:
                if held:
                    yield made()
                held, at = [], (part, seq, f)
            after = (part, seq + 1, f)
            held.append((wide[layout.column[f]], y, _weighted(w, y, codes, wide, layout, stumps)))
    if held:
        yield made()


def _weighted(w, y, codes, wide, layout: Layout, stumps):
    for f, cut, left, right, alpha, z in stumps:
        # a class is 0 or 1: weights by (side, label), looked up
        up = math.exp(alpha)
        gain = np.array([[up if c != k else 1.0 for k in (0, 1)] for c in (right, left)]) / z
        w = w * gain.ravel()[2 * layout.left(codes, wide, f, cut) + y]
    return w


def boost_stumps(rows: DataFrame, n_features: int, rounds: int, rate: float) -> list[tuple[int, float, int, int, float, float]]:
    """(feature, threshold, class left, class right, vote weight, impurity) per round."""
    lists, total, layout = attribute_lists(rows, n_features)
    if not total:
        return []
    ordered = lists.persist(StorageLevel.MEMORY_AND_DISK)
    out: list[tuple] = []
    recent: list[tuple] = []  # stumps whose effect is not yet stored in the lists
    try:
        for t in range(rounds):
            best = _round(ordered, layout, list(recent))
            f, cut, left, right, err, whole, gini = best
            if err >= 0.5:
                break
            alpha = rate * (math.log((1.0 - err) / err) if err > 0 else 1.0)
            out.append((f, cut, left, right, alpha, gini))
            if err <= 0:
                break
            # so that the weights sum to 1 after the update
            recent.append((f, cut, left, right, alpha, whole * ((1.0 - err) + err * math.exp(alpha))))
            if len(recent) == RENEW and t + 1 < rounds:
                renewed = _renewed(ordered, layout, list(recent)).persist(StorageLevel.MEMORY_AND_DISK)
                renewed.count()
                ordered.unpersist()
                ordered, recent = renewed, []
    finally:
        ordered.unpersist()
    return out


def _renewed(lists: DataFrame, layout: Layout, stumps) -> DataFrame:
    def run(batches):
        for b in batches:
            new = [_weighted(w, y, codes, wide, layout, stumps).tobytes() for _, _, _, y, w, codes, wide in _blocks(b, layout)]
            yield pa.record_batch({**{c: b.column(c) for c in b.schema.names}, "w": pa.array(new, pa.binary())})
    return lists.mapInArrow(run, LISTS)


def _sums(lists: DataFrame, layout: Layout, stumps):
    """Weights per class: of every stretch of a list, and of every code of the narrow features (over the first list)."""
    first = layout.wide[0] if layout.wide else -1
    codes_of = [len(layout.values[f]) + 1 for f in layout.narrow]

    def totals(batches):
        tables = [np.zeros(2 * n) for n in codes_of]
        at, after, low, sums = None, None, None, np.zeros(2)

        def stretch():
            return pa.record_batch({"f": pa.array([at[2]], pa.int32()), "part": pa.array([at[0]], pa.int64()), "seq": pa.array([at[1]], pa.int64()),
                                    "low": pa.array([low]), "w0": pa.array([sums[0]]), "w1": pa.array([sums[1]])})

        for b in batches:
            for part, seq, f, y, w, codes, wide in _blocks(b, layout):
                w = _weighted(w, y, codes, wide, layout, stumps)
                if f >= 0:
                    if (part, seq, f) != after:
                        if at is not None:
                            yield stretch()
                        at, low, sums = (part, seq, f), float(wide[layout.column[f]][0]), np.zeros(2)
                    after = (part, seq + 1, f)
                    sums = sums + np.bincount(y, w, 2)
                if f == first:
                    for table, c in zip(tables, codes):
                        table += np.bincount(2 * c.astype(np.int32) + y, w, len(table))
        if at is not None:
            yield stretch()
        for f, table in zip(layout.narrow, tables):
            used = np.flatnonzero(table.reshape(-1, 2).sum(1))
            yield pa.record_batch({"f": pa.array(np.full(len(used), f, np.int32)), "part": pa.array(np.full(len(used), -1)),
                                   "seq": pa.array(used.astype(np.int64)), "low": pa.array(np.full(len(used), np.nan)),
                                   "w0": pa.array(table[2 * used]), "w1": pa.array(table[2 * used + 1])})

    found = lists.mapInArrow(totals, "f int, part long, seq long, low double, w0 double, w1 double") \
        .groupBy("f", "part", "seq").agg(F.first("low").alias("low"), F.sum("w0").alias("w0"), F.sum("w1").alias("w1")) \
        .coalesce(1).collect()
    found = sorted((tuple(r) for r in found), key=lambda r: r[:3])
    stretches = [r for r in found if r[1] >= 0]
    tables = {f: np.zeros((n, 2)) for f, n in zip(layout.narrow, codes_of)}
    for f, part, code, _, w0, w1 in found:
        if part < 0:
            tables[f][code] = w0, w1
    return stretches, tables


def _tried(l0, l1, w0, w1):
    """Impurities of the cuts with l0, l1 on their left; infinite where a side has no weight."""
    r0, r1 = w0 - l0, w1 - l1
    nl, nr = l0 + l1, r0 + r1
    with np.errstate(divide="ignore", invalid="ignore"):
        gini = np.round((2 * l0 * l1 / nl + 2 * r0 * r1 / nr) / (w0 + w1), 12)
    gini[~((nl > 0) & (nr > 0))] = np.inf
    return gini


def _round(lists: DataFrame, layout: Layout, stumps):
    """The best stump under the present weights: feature, threshold, left class, right class, error, total weight, impurity."""
    stretches, tables = _sums(lists, layout, stumps)
    offsets, whole, found = {}, {}, []
    for f in layout.wide:
        mine = [r for r in stretches if r[0] == f]
        run0 = run1 = 0.0
        for i, (_, part, seq, _, w0, w1) in enumerate(mine):
            offsets[part, seq, f] = (run0, run1, mine[i + 1][3] if i + 1 < len(mine) else None)
            run0, run1 = run0 + w0, run1 + w1
        whole[f] = (run0, run1)
    for f, table in tables.items():
        whole[f] = tuple(table.sum(0))
        values = layout.values[f]
        sums = table.cumsum(0)[:len(values)]
        # a code is a threshold if it has rows and something follows it
        at = np.flatnonzero((table[:-1].sum(1) > 0) & (table[::-1].sum(1).cumsum()[::-1][1:] > 0))
        if len(at):
            l0, l1 = sums[at, 0], sums[at, 1]
            gini = _tried(l0, l1, *whole[f])
            k = int(gini.argmin())
            if np.isfinite(gini[k]):
                found.append((gini[k], f, values[at[k]], l0[k], l1[k], whole[f][0] - l0[k], whole[f][1] - l1[k]))

    def candidates(batches):
        for part, seq, f, v, y, w in _runs(batches, layout, stumps):
            before0, before1, after = offsets[part, seq, f]
            w0, w1 = whole[f]
            one = y == 1
            l0, l1 = before0 + np.cumsum(np.where(one, 0.0, w)), before1 + np.cumsum(np.where(one, w, 0.0))
            follows = np.append(v[1:], np.nan if after is None else after)
            last = (v != follows) & ~np.isnan(v)
            if after is None:
                last[-1] = False
            at = np.flatnonzero(last)
            if not len(at):
                continue
            l0, l1 = l0[at], l1[at]
            gini = _tried(l0, l1, w0, w1)
            k = int(gini.argmin())
            if np.isfinite(gini[k]):
                yield pa.record_batch({c: pa.array([x]) for c, x in zip(("gini", "f", "v", "l0", "l1", "r0", "r1"),
                                       (gini[k], np.int32(f), v[at[k]], l0[k], l1[k], w0 - l0[k], w1 - l1[k]))})

    if layout.wide:
        found += map(tuple, lists.mapInArrow(candidates, "gini double, f int, v double, l0 double, l1 double, r0 double, r1 double").collect())
    if not found:
        w0, w1 = whole[0]
        c = int(w1 > w0)
        return 0, float("inf"), c, c, min(w0, w1) / (w0 + w1), w0 + w1, 2 * w0 * w1 / (w0 + w1) ** 2
    gini, f, v, l0, l1, r0, r1 = (x.item() if isinstance(x, np.generic) else x for x in min(found))
    left, right = int(l1 > l0), int(r1 > r0)
    err = max(0.0, (l1 if left == 0 else l0) + (r1 if right == 0 else r0)) / (l0 + l1 + r0 + r1)
    # what the subtraction leaves of a pure side is no error
    return f, v, left, right, 0.0 if err < 1e-13 else err, l0 + l1 + r0 + r1, gini
