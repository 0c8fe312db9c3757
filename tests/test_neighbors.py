import math
import random

import pytest
from pyspark.sql import functions as F

from scoreflow.operators import neighbors as KN
from scoreflow.plans import catalog as C
from scoreflow.plans import training as TRN
from tests.conftest import SF_SMALL


def brute(train, queries, k, p):
    out = {}
    for q, x in queries:
        found = []
        for i, label, y in train:
            d = 0.0
            for a, b in zip(x, y):
                g = abs(a - b)
                t = g
                for _ in range(p - 1):
                    t *= g
                d += t
            found.append((d, i, label))
        out[q] = sorted(found)[:k]
    return out


def run(spark, train, queries, k, p, leaf_rows, stats=None):
    rows = spark.createDataFrame([(i, label, list(x)) for i, label, x in train], "id long, label int, x array<double>")
    blocks, boxes = KN.build_index(rows, leaf_rows)
    q = spark.createDataFrame([(i, list(x)) for i, x in queries], "qid long, x array<double>")
    return {r["qid"]: [tuple(b) for b in r["best"]] for r in KN.nearest(blocks, boxes, q, k, p, stats).collect()}


@pytest.mark.parametrize("k,p", [(5, 2), (3, 1), (8, 3)])
def test_equals_brute_force(spark, k, p):
    rng = random.Random(k)
    train = [(i, rng.randint(0, 1), [round(rng.gauss(rng.choice([0, 4, 9]), 1), 2), float(rng.randint(0, 3)), rng.random()]) for i in range(1500)]
    queries = [(i, [rng.uniform(-3, 12), float(rng.randint(0, 3)), rng.random()]) for i in range(150)]
    stats = {}
    assert run(spark, train, queries, k, p, 40, stats) == brute(train, queries, k, p)
    # a fraction of the query x bucket pairs is visited
    assert stats["visits"] < 0.3 * len(queries) * stats["buckets"]


def test_hot_points_and_ties(spark, monkeypatch):
    """A third of all rows are one point, queries in the same place; ties go by id; visits of one bucket are dealt out."""
    monkeypatch.setattr(KN, "VISITS", 7)
    train = [(i, i % 2, [1.0, 1.0]) for i in range(300)] + [(300 + i, i % 2, [float(i % 20), float(i // 20)]) for i in range(600)]
    queries = [(i, [1.0, 1.0]) for i in range(40)] + [(100 + i, [i / 3, 7.5]) for i in range(30)]
    assert run(spark, train, queries, 6, 2, 50) == brute(train, queries, 6, 2)


def test_few_boxes_are_looked_at_per_query():
    """The search looks at some branches of the box hierarchy, however many buckets there are, and finds just what all boxes give."""
    import numpy as np
    rng = np.random.default_rng(5)
    centre = np.stack([np.repeat(np.arange(64), 64), np.tile(np.arange(64), 64)], 1).astype(float)
    z = np.array([int("".join(a + b for a, b in zip(f"{int(i):06b}", f"{int(j):06b}")), 2) for i, j in centre])
    centre = centre[np.argsort(z)]  # numbered as leaves of a tree
    low, high = centre, centre + 0.9
    low[17], high[17] = np.inf, np.inf  # a bucket without rows
    x = rng.uniform(0, 64, (200, 2))
    limit = np.full(200, 2.0)
    tree = KN.Hierarchy((low, high))
    looked = []
    far = tree._far
    tree._far = lambda level, points, node, p: (looked.append(len(node)), far(level, points, node, p))[1]
    q, bucket, _ = tree.within(x, limit, 2)
    all_far = KN._sums((np.maximum(np.maximum(low[:, j] - x[:, j:j + 1], x[:, j:j + 1] - high[:, j]), 0.0) for j in range(2)), 2)
    assert sorted(zip(q.tolist(), bucket.tolist())) == sorted(map(tuple, np.argwhere(all_far <= 2.0).tolist()))
    assert sum(looked) < 0.1 * 200 * 4096
    home = tree.home(x, 2)
    assert (all_far[np.arange(200), home] <= 2.0).mean() > 0.9


def test_few_rows(spark):
    train = [(1, 1, [0.0]), (2, 0, [5.0])]
    assert run(spark, train, [(7, [1.0])], 5, 2, 10) == brute(train, [(7, [1.0])], 5, 2)
    empty = spark.createDataFrame([], "id long, label int, x array<double>")
    assert KN.build_index(empty) == (None, None)


def test_votes(spark):
    df = spark.createDataFrame([([(0.0, 1, 1), (0.0, 2, 0), (4.0, 3, 1)],), ([(1.0, 1, 1), (4.0, 2, 0)],), ([],)], f"best {KN.BEST}")
    got = df.select(KN.votes(F.col("best")).alias("u"), KN.votes(F.col("best"), "distance", 2).alias("d")).collect()
    assert [tuple(r) for r in got] == [(pytest.approx(2 / 3), 0.5), (0.5, pytest.approx(1 / 1.5)), (0.0, 0.0)]


@pytest.mark.parametrize("params", [{}, {"n_neighbors": 9, "weights": "distance", "metric": "manhattan", "p": 3}])
def test_learner(spark, params, tmp_path):
    from pyspark.ml import PipelineModel
    from scoreflow.operators.learners import acting_params, positive_probability
    split = C.split_subjects(spark, SF_SMALL)
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    m = TRN.fit_learner("knn", params, train, train.count(), TRN.TrainConfig())
    m.write().overwrite().save(str(tmp_path / "knn"))
    s = positive_probability(PipelineModel.load(str(tmp_path / "knn")).transform(test))
    assert s.count() == test.count() and s.where("prob < 0 or prob > 1").count() == 0
    assert TRN.test_metrics(m, test, TRN.TrainConfig())["roc_auc"] > 0.7
    assert "p" not in acting_params("knn", {"metric": "manhattan", "p": 3}) and math.isclose(KN.order_of("minkowski", 3), 3)


def test_plan_has_no_cross_join(spark):
    rows = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(100)], "id long, label int, x array<double>")
    blocks, boxes = KN.build_index(rows, 10)
    best = KN.nearest(blocks, boxes, rows.select(F.col("id").alias("qid"), "x"), 3)
    plan = best._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def mixed(n, seed):
    """Few-valued columns beside two wide ones, as features of subjects are."""
    rng = random.Random(seed)
    return [[float(rng.randint(0, 2)), float(rng.randint(0, 1)), float(rng.randint(0, 3)), round(rng.gauss(0, 1), 3), round(rng.uniform(0, 4), 3)] for _ in range(n)]


def test_a_visit_measures_few_rows_of_its_bucket():
    import numpy as np
    x, q = np.array(mixed(8000, 1)), np.array(mixed(300, 2))
    order, ends = KN.kd_order(x)
    assert sorted(order) == list(range(8000)) and ends[-1] == 8000 and np.diff([0, *ends]).min() > 0 and np.diff([0, *ends]).max() <= KN.RUN
    rows = KN.Rows([(np.arange(8000)[order], np.zeros(8000, np.int32), x[order], ends)])
    measured, measure = [], rows._measured
    rows._measured = lambda part, at, run, p: (measured.append(len(run)), measure(part, at, run, p))[1]
    at, d, ids, _ = rows.nearest(q, np.full(300, np.inf), 5, 2)
    every = KN._sums((q[:, j:j + 1] - x[:, j] for j in range(5)), 2)
    assert ids.reshape(300, 5).tolist() == [np.lexsort((np.arange(8000), e))[:5].tolist() for e in every]
    assert (at.reshape(300, 5).T == np.arange(300)).all() and (d.reshape(300, 5) == np.sort(every, 1)[:, :5]).all()
    assert sum(measured) * KN.RUN < 0.1 * 300 * 8000  # all of them before


def test_home_is_the_nearest_box_and_few_are_looked_at():
    import numpy as np
    x = np.array(mixed(20000, 3))
    tree = KN.KdTree(x, 1000)
    leaf = tree.leaf_of(x)
    low, high = (np.array([f(x[leaf == i], axis=0) for i in range(tree.n_leaves)]) for f in (np.min, np.max))
    q = np.array(mixed(200, 4) + [[9.0, 9.0, 9.0, 9.0, float(i)] for i in range(20)] + [[float("nan")] * 5])
    h = KN.Hierarchy((low, high))
    far = h._far
    looked = []
    h._far = lambda level, points, node, p: (looked.append(len(node)), far(level, points, node, p))[1]
    home = h.home(q, 2)
    every = KN._sums((KN._outside(low[:, j], high[:, j], q[:-1, j:j + 1]) for j in range(5)), 2)
    assert home[-1] == -1 and home[:-1].tolist() == every.argmin(1).tolist()
    assert sum(looked) < 0.3 * len(q) * tree.n_leaves


@pytest.mark.parametrize("k,p,leaf_rows", [(5, 2, 60), (100, 1, 400), (3, 2, 10_000)])
def test_mixed_columns_ties_and_a_k_beyond_a_run(spark, k, p, leaf_rows):
    points = mixed(900, 5)
    train = [(i, i % 2, x) for i, x in enumerate(points + points[:100] + [points[0]] * 200)]
    queries = list(enumerate(mixed(60, 6) + points[:20]))
    stats = {}
    assert run(spark, train, queries, k, p, leaf_rows, stats) == brute(train, queries, k, p)


def test_an_index_saved_without_runs_is_read(spark):
    train = [(i, i % 2, x) for i, x in enumerate(mixed(500, 7))]
    queries = list(enumerate(mixed(30, 8)))
    blocks, boxes = KN.build_index(spark.createDataFrame(train, "id long, label int, x array<double>"), 50)
    q = spark.createDataFrame(queries, "qid long, x array<double>")
    got = {r["qid"]: [tuple(b) for b in r["best"]] for r in KN.nearest(blocks.drop("runs"), boxes, q, 5).collect()}
    assert got == brute(train, queries, 5, 2)


def test_most_queries_visit_one_bucket(spark):
    """A few rounds of jobs over all buckets would visit several a query."""
    train = [(i, i % 2, x) for i, x in enumerate(mixed(6000, 9))]
    queries = list(enumerate(mixed(400, 10)))
    stats = {}
    assert run(spark, train, queries, 3, 2, 600, stats) == brute(train, queries, 3, 2)
    assert stats["visits"] < 2 * len(queries)


def test_a_bucket_without_rows_gives_no_neighbours(spark):
    """Visits of it don't meet the rows of the bucket before, and a home with few rows still leads to all others."""
    train = [(i, i % 2, x) for i, x in enumerate(mixed(300, 11))]
    queries = list(enumerate(mixed(20, 12)))
    blocks, (low, high) = KN.build_index(spark.createDataFrame(train, "id long, label int, x array<double>"), 30)
    low[3], high[3] = float("inf"), float("inf")
    gone = {i for r in blocks.where("bucket = 3").collect() for i in memoryview(r["ids"]).cast("q")}
    assert gone
    q = spark.createDataFrame(queries, "qid long, x array<double>")
    got = {r["qid"]: [tuple(b) for b in r["best"]] for r in KN.nearest(blocks.where("bucket <> 3"), (low, high), q, 290).collect()}
    assert got == brute([t for t in train if t[0] not in gone], queries, 290, 2)


def test_repeated_and_missing_query_ids(spark):
    """Queries of one id share their pairs, as the SQL's partition by id does; a query without an id finds nothing."""
    train = [(i, i % 2, x) for i, x in enumerate(mixed(400, 13))]
    q = mixed(12, 14)
    blocks, boxes = KN.build_index(spark.createDataFrame(train, "id long, label int, x array<double>"), 40)
    rows = [(1, q[0]), (1, q[0]), (2, q[1]), (2, q[2]), (3, q[3]), (None, q[4])]
    got = KN.nearest(blocks, boxes, spark.createDataFrame(rows, "qid long, x array<double>"), 5).collect()
    want = {i: sorted(sum((brute(train, [(0, x)], 5, 2)[0] for j, x in rows if j == i), []))[:5] for i in (1, 2, 3)}
    assert sorted((r["qid"] or 0, [tuple(b) for b in r["best"]]) for r in got) == sorted((i or 0, want.get(i, [])) for i, _ in rows)
