"""Exact k-nearest-neighbour votes through a distributed kd-tree.

Fit: a kd-tree is cut on a hash sample of ``SAMPLE_ROWS`` training rows (widest dimension, median); the sample only
decides where space is cut.  All rows descend to their leaf; a leaf that holds more than its share (many equal
points) is dealt over several buckets by a hash.  Each bucket's rows are packed into blocks (one table row, at most
``4 * leaf_rows`` points) with the box around them; inside a block points lie in the order of a smaller kd-tree, in runs
of at most ``RUN`` rows that are close together, each with a narrow box of its own.

Search: a query first visits its home, the bucket with the nearest box, found in a hierarchy of boxes (``FAN`` neighbouring boxes under one).
Inside a bucket it measures the distance to the boxes of the runs, takes a bound from the nearest run and looks only at runs no farther.
Then only buckets no farther than its k-th neighbour so far count, found by following only near boxes down.  Round by round a query visits its next 3, 6, 12, ... nearest of them; visits meet the blocks by an equi-join
on the bucket (blocks stream first, visits after them, so a task holds one block and a batch of visits).  A bucket with
many visits is copied to several tasks.  A query that no box is near enough for is finished and leaves the rounds, so the
result is exact and most (query, row) and (query, bucket) pairs are never formed.

Neighbours are ordered by distance, then by id.  Distances are Minkowski sums |dx|**p, added dimension by dimension.  Votes: ``uniform``
is the mean label; ``distance`` weighs by 1 / distance, and neighbours at distance 0, if any, are the only ones that count.
A null or NaN coordinate counts as 0, fewer than k rows all vote, without training rows the probability is 0.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.session import shared_dir, written

SAMPLE_ROWS = 50_000  # expected size of the sample that the tree is cut on
LEAF_ROWS = 8192
RUN = 64
MOST_LEAVES = 32_768  # boxes are sent to every task; beyond it leaves grow
VISITS = 20_000  # visits of one bucket that one task takes
TASK_VISITS = 40_000  # of all buckets; fewer where cores would be idle
TASK_BUCKETS = 32  # whose blocks may meet in one batch
CELLS = 2_000_000  # distances held at once inside a task
CACHED = 65_536  # numbers that stay in a core's cache
FAN = 8
BEST = "array<struct<d:double,id:bigint,label:int>>"


# ---------------------------------------------------------------- tree
class KdTree:
    """Cuts of space: ``x[dim] <= cut`` goes left; leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.n_leaves = 0
        self._grow(points, max(1, len(points) // max(leaves, 1)))

    def _grow(self, points: np.ndarray, least: int) -> int:
        me = len(self.dim)
        for held in (self.dim, self.cut, self.left, self.right, self.leaf):
            held.append(-1)
        spread = points.max(0) - points.min(0) if len(points) else np.zeros(1)
        d = int(spread.argmax())
        if len(points) < 2 * least or spread[d] <= 0:
            self.leaf[me] = self.n_leaves
            self.n_leaves += 1
            return me
        x = points[:, d]
        at = float(np.quantile(x, 0.5, method="lower"))
        if at == x.max():  # so that something goes right
            at = float(x[x < at].max())
        self.dim[me], self.cut[me] = d, at
        self.left[me] = self._grow(points[x <= at], least)
        self.right[me] = self._grow(points[x > at], least)
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        dim, cut, left, right, leaf = (np.array(a) for a in (self.dim, self.cut, self.left, self.right, self.leaf))
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        while (open_ := leaf[at] < 0).any():
            i = rows[open_]
            n = at[i]
            at[i] = np.where(x[i, dim[n]] <= cut[n], left[n], right[n])
        return leaf[at]


def _matrix(column) -> np.ndarray:
    flat = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    return flat[offsets[0]:offsets[-1]].reshape(len(column), -1).astype(float)


def _sums(gaps, p: int) -> np.ndarray:
    """Sum of |gap|**p, one dimension after the other: the same digits as a SQL sum written out.  The gaps are overwritten."""
    total = None
    for g in gaps:
        t = np.abs(g, out=g)
        if p > 1:
            t = g * g
            for _ in range(p - 2):
                t *= g
        total = t if total is None else np.add(total, t, out=total)
    return total


def _outside(low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How far x lies outside of [low, high]; never more than its distance to a number in there, digits included."""
    gap = low - x
    np.maximum(gap, x - high, out=gap)
    return np.maximum(gap, 0.0, out=gap)


def kd_order(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows in which runs of at most ``RUN`` are close together, and where the runs end.  The widest dimension is
    cut at the value nearest to its median, so that equal values stay on one side and few runs overlap."""
    order, todo, ends = np.arange(len(x)), [(0, len(x))], []
    while todo:
        a, b = todo.pop()
        if b - a <= RUN:
            ends.append(b)
            continue
        part = x[order[a:b]]
        spread = part.max(0) - part.min(0)
        d = int(spread.argmax())
        if not spread[d] > 0:
            ends += [*range(a + RUN, b, RUN), b]
            continue
        v = part[:, d]
        middle = np.partition(v, (b - a) // 2)[(b - a) // 2]
        below, upto = v < middle, v <= middle
        n, m = int(below.sum()), int(upto.sum())
        left, n = (below, n) if n and (m == b - a or abs(2 * n - (b - a)) <= abs(2 * m - (b - a))) else (upto, m)
        order[a:b] = np.concatenate([order[a:b][left], order[a:b][~left]])
        todo += [(a, a + n), (a + n, b)]
    return order, np.array(sorted(ends), np.int32)


# ---------------------------------------------------------------- index
def build_index(rows: DataFrame, leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS):
    """``rows``: id long, label int, x array<double>.  Returns (blocks, boxes): blocks is a written table, boxes the
    (low, high) corners of the buckets, in order."""
    rows = written(rows, "knn-rows")
    n = rows.count()
    if not n:
        return None, None
    share = min(1.0, sample_rows / n)
    sample = rows.where(F.pmod(F.xxhash64("id", "x"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).select("x") \
        .orderBy(F.xxhash64("x")).toArrow().column("x").combine_chunks()
    tree = KdTree(_matrix(sample) if len(sample) else np.zeros((0, 1)), min(MOST_LEAVES, -(-n // leaf_rows)))

    def descend(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.leaf_of(_matrix(b.column("x"))), pa.int64())],
                                             names=["id", "label", "x", "leaf"])

    dealt = written(rows.mapInArrow(descend, "id long, label int, x array<double>, leaf long"), "knn-leaves")
    sizes = dealt.groupBy("leaf").agg(F.count("*").alias("n")).orderBy("leaf").collect()
    buckets, first = [], 0
    for r in sizes:
        parts = -(-r["n"] // (2 * leaf_rows))
        buckets.append((r["leaf"], first, parts))
        first += parts
    known = F.broadcast(rows.sparkSession.createDataFrame(buckets, "leaf long, first long, parts long"))
    dealt = dealt.join(known, "leaf").select((F.col("first") + F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), "parts")).alias("bucket"), "id", "label", "x")

    def pack(batches):
        held, at, n = [], None, 0

        def block():
            ids, labels, x = (np.concatenate(c) for c in zip(*held))
            near, runs = kd_order(x)
            ids, labels, x = ids[near], labels[near], x[near]
            return pa.record_batch({"bucket": pa.array([at], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                                    "labels": pa.array([labels.tobytes()], pa.binary()), "points": pa.array([x.tobytes()], pa.binary()), "runs": pa.array([runs.tobytes()], pa.binary()),
                                    "low": pa.array([x.min(0)], pa.list_(pa.float64())), "high": pa.array([x.max(0)], pa.list_(pa.float64()))})

        for b in batches:
            bucket, ids = b.column("bucket").to_numpy(), b.column("id").to_numpy()
            labels, x = b.column("label").to_numpy().astype(np.int32), _matrix(b.column("x"))
            edges = np.flatnonzero(np.diff(bucket)) + 1
            for i, j in zip([0, *edges], [*edges, len(bucket)]):
                if held and (bucket[i] != at or n >= 2 * leaf_rows):
                    yield block()
                    held, n = [], 0
                at = bucket[i]
                for k in range(i, j, 2 * leaf_rows):
                    if n >= 2 * leaf_rows:
                        yield block()
                        held, n = [], 0
                    end = min(j, k + 2 * leaf_rows)
                    held.append((ids[k:end], labels[k:end], x[k:end]))
                    n += end - k
        if held:
            yield block()

    ordered = dealt.repartition(max(1, min(first, -(-n // 50_000))), "bucket").sortWithinPartitions("bucket")
    blocks = written(ordered.mapInArrow(
        pack, "bucket long, ids binary, labels binary, points binary, runs binary, low array<double>, high array<double>"), "knn-blocks")
    return blocks, boxes_of(blocks)


def boxes_of(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Corners of the buckets' boxes; a bucket may have several blocks."""
    d = blocks.select(F.size("low")).first()[0]
    got = blocks.groupBy("bucket").agg(*[F.min(F.col("low")[i]).alias(f"l{i}") for i in range(d)],
                                       *[F.max(F.col("high")[i]).alias(f"h{i}") for i in range(d)]).orderBy("bucket").toArrow()
    table = np.stack([got.column(c).to_numpy() for c in got.column_names[1:]], 1)
    low, high = np.full((int(got.column("bucket").to_numpy().max()) + 1, d), np.inf), None
    high = np.full_like(low, np.inf)  # a bucket without rows is infinitely far
    at = got.column("bucket").to_numpy()
    low[at], high[at] = table[:, :d], table[:, d:]
    return low, high


# ---------------------------------------------------------------- search
class Hierarchy:
    """Boxes of the buckets (level 0) and, level by level, the boxes around ``FAN`` neighbours; buckets are numbered as their leaves
    lie in the tree, so neighbours are near each other."""

    def __init__(self, boxes):
        self.levels = [boxes]
        while len(self.levels[-1][0]) > FAN:
            at = np.arange(0, len(self.levels[-1][0]), FAN)
            low, high = self.levels[-1]
            empty = ~np.isfinite(low)  # a bucket without rows widens no box
            self.levels.append((np.fmin.reduceat(low, at), np.fmax.reduceat(np.where(empty, -np.inf, high), at)))
        self.columns = [(low.T.copy(), high.T.copy()) for low, high in self.levels]

    def _under(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``node``, child) of all children."""
        child = node[:, None] * FAN + np.arange(FAN)
        place, j = np.nonzero(child < len(self.levels[level][0]))
        return place, child[place, j]

    def _far(self, level: int, x: np.ndarray, node: np.ndarray, p: int) -> np.ndarray:
        low, high = self.columns[level]
        return _sums((_outside(low[j].take(node), high[j].take(node), x[:, j]) for j in range(x.shape[1])), p)

    def home(self, x: np.ndarray, p: int) -> np.ndarray:
        """The nearest bucket per query; -1 for a query without a place.  Most queries lie in a box; others get a limit from a walk down."""
        out = np.full(len(x), -1)
        self._nearest(x, np.arange(len(x)), np.zeros(len(x)), p, out)
        rest = np.flatnonzero(out < 0)
        reached = self._walk(x[rest], p)
        has = np.isfinite(reached)
        self._nearest(x, rest[has], reached[has], p, out)
        return out

    def _nearest(self, x: np.ndarray, rows: np.ndarray, limit: np.ndarray, p: int, out: np.ndarray) -> None:
        q, node, far = self.within(x[rows], limit, p)
        order = np.lexsort((node, far, q))
        q, first = np.unique(q[order], return_index=True)
        out[rows[q]] = node[order[first]]

    def _walk(self, x: np.ndarray, p: int) -> np.ndarray:
        """Distance to a near box: the nearest of the children of the ``FAN`` nearest nodes, level by level."""
        best, rows = np.zeros((len(x), 1), int), np.arange(len(x))[:, None]
        for level in range(len(self.levels) - 1, -1, -1):
            n = len(self.levels[level][0])
            child = (best[:, :, None] * FAN + np.arange(FAN)).reshape(len(x), best.shape[1] * FAN)
            low, high = self.columns[level]
            at = np.minimum(child, n - 1)
            far = _sums((_outside(low[j].take(at), high[j].take(at), x[:, j:j + 1]) for j in range(x.shape[1])), p)
            far[np.isnan(far) | (child >= n)] = np.inf
            first = np.argsort(far, axis=1)[:, :FAN]
            best, reached = child[rows, first], far[rows, first]
        return reached[:, 0]

    def within(self, x: np.ndarray, limit: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, bucket, distance) of all boxes no farther than the query's limit."""
        top = len(self.levels) - 1
        q, node = (a.ravel() for a in np.meshgrid(np.arange(len(x)), np.arange(len(self.levels[top][0])), indexing="ij"))
        for level in range(top, -1, -1):
            if len(q) > CELLS // FAN and len(x) > 1:  # little is ruled out: fewer queries at a time
                half = len(x) // 2
                a, b = self.within(x[:half], limit[:half], p), self.within(x[half:], limit[half:], p)
                return tuple(np.concatenate(c) for c in ((a[0], b[0] + half), (a[1], b[1]), (a[2], b[2])))
            far = self._far(level, x[q], node, p)
            near = far <= limit[q]
            q, node, far = q[near], node[near], far[near]
            if level:
                place, node = self._under(level - 1, node)
                q = q[place]
        return q, node, far


class Rows:
    """The rows of a bucket as runs of up to ``RUN`` with boxes, one array per dimension."""

    def __init__(self, held):
        self.ids, self.labels, points = (np.concatenate(c) for c in list(zip(*held))[:3])
        first = np.cumsum([0, *(len(h[0]) for h in held)])
        ends = np.concatenate([a + h[3] for a, h in zip(first, held)])
        self.at = np.concatenate([[0], ends[:-1]])
        self.low, self.high = np.minimum.reduceat(points, self.at).T.copy(), np.maximum.reduceat(points, self.at).T.copy()
        place = self.at[:, None] + np.arange((ends - self.at).max())
        gone = place >= ends[:, None]
        place[gone] = 0
        self.runs = points.T[:, place]  # (dimension, run, row); rows that are not there are at no distance
        self.runs[:, gone] = np.nan
        self.typical = max(1, len(points) // len(ends))

    def _measured(self, x: np.ndarray, q: np.ndarray, run: np.ndarray, p: int) -> np.ndarray:
        return _sums((self.runs[j].take(run, axis=0) - x[q, j][:, None] for j in range(x.shape[1])), p)

    def nearest(self, x: np.ndarray, limit: np.ndarray, k: int, p: int):
        """(query, distance, id, label) of the k nearest rows of each query that are no farther than its limit, in order."""
        out, size = [], max(1, CACHED // max(len(self.at), RUN))
        some = min(len(self.at), -(-2 * k // self.typical))  # so many runs should hold k rows
        for i in range(0, len(x), size):
            part, most = x[i:i + size], limit[i:i + size].copy()
            far = _sums((_outside(self.low[j], self.high[j], part[:, j:j + 1]) for j in range(x.shape[1])), p)
            far[np.isnan(far)] = 0.0
            near = np.flatnonzero(far.min(1) <= most)
            if k <= some * self.runs.shape[2] and len(near):
                close = far[near].argmin(1)[:, None] if some == 1 else np.argsort(far[near], axis=1)[:, :some]
                d = self._measured(part, np.repeat(near, some), close.ravel(), p).reshape(len(near), -1)
                most[near] = np.fmin(most[near], np.partition(d, k - 1, axis=1)[:, k - 1])  # nan: fewer rows than k
            q, run = np.nonzero(far <= most[:, None])
            held = []
            for j in range(0, len(q), CACHED // RUN):
                mine, here = q[j:j + CACHED // RUN], run[j:j + CACHED // RUN]
                d = self._measured(part, mine, here, p)
                row, col = np.nonzero(d <= most[mine][:, None])
                at = self.at[here[row]] + col
                found = (mine[row] + i, d[row, col], self.ids[at], self.labels[at])
                held.append(_first(found, k) if len(row) > CACHED // 8 else found)
            if held:
                out.append(_first(tuple(np.concatenate(c) for c in zip(*held)), k))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else NONE


NONE = tuple(np.zeros(0, t) for t in (int, float, int, np.int32))


def _first(found, k: int):
    """The first k per query, in the order of (distance, id, label)."""
    q, d, ids, labels = found
    order = np.lexsort((labels, ids, d, q))
    q = q[order]
    keep = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
    return tuple(a[keep] for a in found)


STATE = f"qid long, row long, x array<double>, kth double, best {BEST}, home long, todo array<long>"
BEST_ARROW = pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64()), ("label", pa.int32())]))


def nearest(blocks: DataFrame, boxes, queries: DataFrame, k: int, p: int = 2, stats: dict | None = None) -> DataFrame:
    """``queries``: qid long, x array<double>.  Returns qid and best (``BEST``) per query: the k nearest rows in order of
    (sum |dx|**p, id).  Queries with the same qid share what they find: each gets the k nearest of all their (query, row) pairs.  A query
    without a qid gets none.  ``stats`` gets the number of visits and of buckets, for the curious."""
    tree = Hierarchy(boxes)
    n_buckets = len(boxes[0])

    def lists(owner: np.ndarray, buckets: np.ndarray, n: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(buckets, pa.int64()))

    def following(home: np.ndarray, q, bucket, far, first: int, step: int) -> pa.Array:
        """The boxes from place ``first`` on, by distance, at most ``step``; home was visited before."""
        new = bucket != home[q]
        q, bucket, far = q[new], bucket[new], far[new]
        order = np.lexsort((bucket, far, q))
        q, bucket = q[order], bucket[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        take = (rank >= first) & (rank < first + step)
        return lists(q[take], bucket[take], len(home))

    def start(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("qid", "row", "x")), pa.array(tree.home(_matrix(part.column("x")), p), pa.int64())],
                                                 names=["qid", "row", "x", "bucket"])

    def plan(first: int, step: int):
        def run(batches):
            for b in batches:
                for i in range(0, b.num_rows, 1024):
                    part = b.slice(i, 1024)
                    home = part.column("home").to_numpy()
                    found = tree.within(_matrix(part.column("x")), part.column("kth").to_numpy(), p)
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("qid", "row", "x", "kth", "best", "home")),
                                                      following(home, *found, first, step)], names=["qid", "row", "x", "kth", "best", "home", "todo"])
        return run

    def compared(batches):
        """(bucket, its visits, their points, what the bucket has for them), batch by batch."""
        at, held, rows = None, [], None
        for b in batches:
            bucket, chunk, kind = (b.column(c).to_numpy() for c in ("bucket", "chunk", "kind"))
            key = bucket * (1 << 20) + chunk
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *edges], [*edges, len(key)]):
                if key[i] != at:
                    at, held, rows = key[i], [], None
                if kind[i] == 0:
                    for r in range(i, j):
                        ids = np.frombuffer(b.column("ids")[r].as_buffer(), np.int64)
                        runs = b.column("runs")[r]  # an index that was saved without them is read in runs of its order
                        held.append((ids, np.frombuffer(b.column("labels")[r].as_buffer(), np.int32),
                                     np.frombuffer(b.column("points")[r].as_buffer(), float).reshape(len(ids), -1),
                                     np.frombuffer(runs.as_buffer(), np.int32) if runs.is_valid else np.array([*range(RUN, len(ids), RUN), len(ids)])))
                    continue
                if held:  # a bucket may be without rows
                    rows, held = Rows(held), []
                for r in range(i, j, 1024):
                    mine = b.slice(r, min(1024, j - r))
                    x, kth = _matrix(mine.column("x")), mine.column("kth").to_numpy()
                    yield bucket[i], mine, x, rows.nearest(x, kth, k, p) if rows else NONE

    def best_lists(q, d, ids, labels, n: int) -> pa.Array:
        values = pa.StructArray.from_arrays([pa.array(d), pa.array(ids, pa.int64()), pa.array(labels, pa.int32())], fields=list(BEST_ARROW.value_type))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(q, np.arange(n + 1)), pa.int32()), values).cast(BEST_ARROW)

    def at_home(batches):
        for bucket, mine, x, (q, d, ids, labels) in compared(batches):
            n = len(x)
            last = np.searchsorted(q, np.arange(n), side="right") - 1
            full = np.bincount(q, minlength=n) >= k
            kth = np.where(full, d[last] if len(d) else np.inf, np.inf)
            home = np.full(n, bucket)
            yield pa.RecordBatch.from_arrays(
                [*(mine.column(c) for c in ("qid", "row", "x")), pa.array(kth), best_lists(q, d, ids, labels, n), pa.array(home, pa.int64()),
                 following(home, *tree.within(x, kth, p), 0, 3)], names=["qid", "row", "x", "kth", "best", "home", "todo"])

    def match(batches):
        for _, mine, x, found in compared(batches):
            yield pa.RecordBatch.from_arrays([mine.column("row"), best_lists(*found, len(x))], names=["row", "found"])

    def meeting(visits: DataFrame) -> DataFrame | None:
        """Visits (qid, row, x, kth, bucket) behind the blocks of their buckets; None if there is no visit."""
        counts = [(r["bucket"], r["n"], -(-r["n"] // VISITS)) for r in visits.groupBy("bucket").agg(F.count("*").alias("n")).collect()]
        if not counts:
            return None
        n = sum(c[1] for c in counts)
        if stats is not None:
            stats["visits"] = stats.get("visits", 0) + n
            stats["buckets"] = n_buckets
        spark = visits.sparkSession
        chunks = F.broadcast(spark.createDataFrame(counts, "bucket long, _n long, _chunks long"))
        none = {"qid": "long", "row": "long", "x": "array<double>", "kth": "double", "ids": "binary", "labels": "binary", "points": "binary", "runs": "binary"}

        def column(c, here):
            return F.col(c) if c in here else F.lit(None).cast(none[c]).alias(c)

        left = visits.join(chunks, "bucket").select("bucket", F.pmod(F.xxhash64("row"), "_chunks").alias("chunk"), F.lit(1).alias("kind"),
                                                    *[column(c, ("qid", "row", "x", "kth")) for c in none])
        right = blocks.join(chunks, "bucket").select("*", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk")) \
            .select("bucket", F.col("chunk").cast("long"), F.lit(0).alias("kind"), *[column(c, blocks.columns) for c in none])
        dealt = sum(c[2] for c in counts)
        wide = max(-(-n // TASK_VISITS), -(-dealt // TASK_BUCKETS), min(2 * spark.sparkContext.defaultParallelism, -(-n // 2000)))
        tasks = max(1, min(dealt, wide))
        return left.unionByName(right).repartition(tasks, "bucket", "chunk").sortWithinPartitions("bucket", "chunk", "kind")

    begun = written(queries.select("qid", F.monotonically_increasing_id().alias("row"), "x")
                    .mapInArrow(start, "qid long, row long, x array<double>, bucket long"), "knn-homes")  # numbers settle as they are written
    nothing = F.expr(f"cast(array() as {BEST})")
    placed = F.col("qid").isNotNull() & (F.col("bucket") >= 0)
    done = [begun.where(~placed).select("qid", nothing.alias("best"))]
    met = meeting(begun.where(placed).select("qid", "row", "x", F.lit(float("inf")).alias("kth"), "bucket"))
    first, step = 3, 6
    while met is not None:
        if len(done) == 1:
            state = written(met.mapInArrow(at_home, STATE), "knn-state")
        else:
            found = met.mapInArrow(match, f"row long, found {BEST}").groupBy("row").agg(F.flatten(F.collect_list("found")).alias("found"))
            state = state.join(found, "row", "left").select(
                "qid", "row", "x", F.slice(F.sort_array(F.concat("best", F.coalesce("found", nothing))), 1, k).alias("best"), "home")
            limit = F.when(F.size("best") >= k, F.element_at("best", -1)["d"]).otherwise(F.lit(float("inf")))
            state = written(state.select("qid", "row", "x", limit.alias("kth"), "best", "home").mapInArrow(plan(first, step), STATE), "knn-state")
            first, step = first + step, step * 2
        done.append(state.where(F.size("todo") == 0).select("qid", "best"))
        state = state.where(F.size("todo") > 0)
        met = meeting(state.select("qid", "row", "x", "kth", F.explode("todo").alias("bucket")))
    out = reduce(DataFrame.unionByName, done)
    again = begun.where("qid is not null").groupBy("qid").agg(F.count("*").alias("_n")).where("_n > 1").select("qid")
    if again.isEmpty():
        return out
    shared = out.join(again, "qid", "left_semi").groupBy("qid").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("_shared"))
    return out.join(shared, "qid", "left").select("qid", F.coalesce("_shared", "best").alias("best"))


def votes(best, weights: str = "uniform", p: int = 2):
    """Probability of class 1 from a ``best`` column."""
    def share(a, weight):
        total = F.aggregate(a, F.lit(0.0), lambda s, x: s + weight(x))
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + weight(x) * x["label"]) / total

    if weights == "uniform":
        p1 = share(best, lambda x: F.lit(1.0))
    elif weights == "distance":
        root = {1: lambda d: d, 2: F.sqrt}.get(p, lambda d: F.pow(d, F.lit(1.0 / p)))
        here = F.filter(best, lambda x: x["d"] == 0)
        p1 = F.when(F.size(here) > 0, share(here, lambda x: F.lit(1.0))).otherwise(share(best, lambda x: 1.0 / root(x["d"])))
    else:
        raise ValueError(f"weights {weights!r} is not supported")
    return F.when(F.size(best) > 0, p1).otherwise(F.lit(0.0))


def order_of(metric: str, p: int) -> int:
    """The p of a metric; Minkowski alone has one of its own."""
    known = {"minkowski": int(p), "euclidean": 2, "manhattan": 1}
    if metric not in known or known[metric] < 1:
        raise ValueError(f"metric {metric!r} with p = {p} is not supported")
    return known[metric]


def point(cols) -> F.Column:
    return F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cols])


# ---------------------------------------------------------------- pipeline stage
class _Params(Params):
    featureCols = Param(Params._dummy(), "featureCols", "numeric feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    p = Param(Params._dummy(), "p", "Minkowski exponent", TypeConverters.toInt)
    leafRows = Param(Params._dummy(), "leafRows", "rows a leaf should hold", TypeConverters.toInt)
    folder = Param(Params._dummy(), "folder", "where the index is kept; the application's shared folder by default", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", k=5, weights="uniform", p=2, leafRows=LEAF_ROWS)


class KNearest(Estimator, _Params, DefaultParamsReadable, DefaultParamsWritable):
    """k-NN classifier.  Ties in distance go to the row that comes first in the order of a hash of its features and label."""

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol=None, k=None, weights=None, p=None, leafRows=None, folder=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        import uuid

        cols = self.getOrDefault(self.featureCols)
        label = F.col(self.getOrDefault(self.labelCol)).cast("int")
        x = point(cols)
        blocks, _ = build_index(df.where(label.isNotNull()).select(F.xxhash64(x, label).alias("id"), label.alias("label"), x.alias("x")),
                                self.getOrDefault(self.leafRows))
        m = KNearestModel()
        self._copyValues(m)
        folder = self.getOrDefault(self.folder) if self.isDefined(self.folder) else shared_dir(df.sparkSession, "knn")
        path = f"{folder}/index-{uuid.uuid4().hex}"
        if blocks is not None:
            blocks.write.parquet(path)
        return m._set(indexPath=path if blocks is not None else "")


class KNearestModel(Model, _Params, DefaultParamsReadable, DefaultParamsWritable):
    """Scores rows by rounds of jobs; the index is read from the folder that it was written to."""

    indexPath = Param(Params._dummy(), "indexPath", "folder of the index", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        spark, path = df.sparkSession, self.getOrDefault(self.indexPath)
        rows = written(df.select("*", F.monotonically_increasing_id().alias("_qid")), "knn-queries")  # ids settle as they are written
        if not path:
            p1 = F.lit(0.0)
            return rows.drop("_qid").withColumn("probability", array_to_vector(F.array(1.0 - p1, p1))).withColumn("prediction", F.lit(0.0))
        blocks = spark.read.parquet(path)
        best = nearest(blocks, boxes_of(blocks), rows.select(F.col("_qid").alias("qid"), point(self.getOrDefault(self.featureCols)).alias("x")),
                       self.getOrDefault(self.k), self.getOrDefault(self.p))
        p1 = votes(F.col("best"), self.getOrDefault(self.weights), self.getOrDefault(self.p))
        scored = rows.join(best, rows["_qid"] == best["qid"]).withColumn("_p1", p1)
        return scored.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p1"), F.col("_p1")))) \
            .withColumn("prediction", (F.col("_p1") > 0.5).cast("double")).drop("_qid", "qid", "best", "_p1")
