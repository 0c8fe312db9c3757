import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow.operators import boosted_trees as BT


def data(n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 5, n), rng.normal(size=n).round(2), np.where(rng.random(n) < 0.6, 0, rng.integers(0, 9, n))], 1).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + x[:, 2] / 3 + rng.normal(size=n) > 3).astype(int)
    return x, y


def plain(x, y, g: BT.Growth, cuts):
    """Boosting in plain numpy, one split after the other."""
    p = y.mean()
    f = np.full(len(y), math.log(p / (1 - p)))
    bins = BT.binned(x, cuts)
    out = []

    def soft(a):
        return math.copysign(max(abs(a) - g.l1, 0.0), a)

    def sc(a, b):
        return soft(a) ** 2 / (b + g.l2) if b + g.l2 > 0 else 0.0

    for _ in range(g.rounds):
        q = 1 / (1 + np.exp(-f))
        gr, he = q - y, q * (1 - q)
        leaves, made, depth = {0: np.arange(len(y))}, [], {0: 0}

        def cut(rows):
            best = None
            for j in range(x.shape[1]):
                for b in range(len(cuts[j])):
                    left = bins[rows, j] <= b
                    a, c = rows[left], rows[~left]
                    if min(len(a), len(c)) < max(g.least_rows, 1) or min(he[a].sum(), he[c].sum()) < g.least_hessian:
                        continue
                    gain = round(0.5 * (sc(gr[a].sum(), he[a].sum()) + sc(gr[c].sum(), he[c].sum()) - sc(gr[rows].sum(), he[rows].sum())), 10)
                    if gain > 1e-9 and (best is None or gain > best[0]):
                        best = (gain, j, b, a, c)
            return best

        if g.mode == "level":
            front = [(0, np.arange(len(y)))]
            for _ in range(g.max_depth):
                after = []
                for name, rows in front:
                    if s := cut(rows):
                        made.append((s[1], s[2], len(s[3]), len(s[4])))
                        leaves.pop(name)
                        for i, part in enumerate(s[3:]):
                            leaves[len(made) * 2 + i] = part
                            after.append((len(made) * 2 + i, part))
                front = after
        else:
            while len(leaves) < g.num_leaves:
                options = [(s, name) for name, rows in leaves.items() if (s := cut(rows))]
                if not options:
                    break
                s, name = max(options, key=lambda o: (o[0][0], -o[1]))
                leaves.pop(name)
                made.append((s[1], s[2], len(s[3]), len(s[4])))
                for i, part in enumerate(s[3:]):
                    leaves[len(made) * 2 + i] = part
        for rows in leaves.values():
            f[rows] -= g.rate * soft(gr[rows].sum()) / (he[rows].sum() + g.l2)
        out.append(made)
    return f, out


@pytest.mark.parametrize("g", [
    BT.Growth(mode="level", rounds=4, rate=0.3, max_depth=3, l2=1.0, l1=0.2, least_hessian=1.0, bins=16),
    BT.Growth(mode="leaf", rounds=4, rate=0.3, max_depth=-1, num_leaves=7, l2=0.1, least_rows=8, bins=64),
])
def test_equals_plain_boosting(spark, g, monkeypatch):
    monkeypatch.setattr(BT, "RENEW", 2)
    x, y = data()
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(4)
    base, cuts, trees, made = BT.boost(df, 3, g)
    margins, want = plain(x, y, g, cuts)
    assert [[(f, b, int(left[2]), int(right[2])) for _, f, b, _, left, right in m] for m in made] == want
    got = base + sum(t.margins(BT.binned(x, cuts)) for t in trees)
    assert got == pytest.approx(margins)


def test_oblivious_trees_have_one_split_a_level(spark):
    x, y = data(400, 2)
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int")
    _, cuts, trees, made = BT.boost(df, 3, BT.Growth(mode="oblivious", rounds=2, max_depth=3, bagging=1.0))
    for m in made:
        assert [len({(f, b) for _, f, b, *_ in m[i:j]}) for i, j in ((0, 1), (1, 3), (3, 7))] == [1, 1, 1]
    auc = sum(t.margins(BT.binned(x, cuts)) for t in trees)
    assert auc[y == 1].mean() > auc[y == 0].mean()


def test_samples_are_hashed_and_act(spark):
    x, y = data()
    df = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int").repartition(3).persist()
    made = {}
    for name, change in {"all": {}, "rows": {"subsample": 0.5}, "again": {"subsample": 0.5}, "columns": {"colsample": 0.34}, "l1": {"l1": 8.0},
                         "l2": {"l2": 50.0}, "hessian": {"least_hessian": 30.0}}.items():
        made[name] = [[(f, b, round(gain, 6), left[2]) for _, f, b, gain, left, _ in m] for m in BT.boost(df, 3, BT.Growth(rounds=1, max_depth=3, **change))[3]]
    assert made["rows"] == made["again"] and len({str(m) for m in made.values()}) == 6
    assert len({f for m in made["columns"] for f, *_ in m}) == 1


def test_cuts(spark):
    df = spark.createDataFrame([([float(i % 10), 0.0 if i < 90 else float(i), None if i % 2 else math.nan],) for i in range(100)], "x array<double>")
    cuts = BT.cuts_of(df, 3, 5)
    assert cuts[0] == [1.0, 3.0, 5.0, 7.0, 9.0] and cuts[1][-1] == 99.0 and cuts[1][0] == 0.0 and cuts[2] == []
    assert BT.binned(np.array([[2.0, 0.0, math.nan]]), cuts).tolist() == [[1, 0, 0]]


def test_ordered_statistics_use_earlier_rows_only(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 2}", (i * 7) % 5 // 3) for i in range(200)] + [(500, None, 1), (501, None, 0)]
    df = spark.createDataFrame(rows, "i long, c string, y int")
    got = {r["i"]: r["c_ts"] for r in BT.ordered_statistics(df, "c", "y", "i", 0.5).collect()}
    for i, c, _ in rows:
        before = [y for j, d, y in rows if d == c and j < i]
        assert got[i] == pytest.approx((sum(before) + 0.5) / (len(before) + 1))
    flipped = df.withColumn("y", F.when(F.col("i") == 100, 1 - F.col("y")).otherwise(F.col("y")))
    other = {r["i"]: r["c_ts"] for r in BT.ordered_statistics(flipped, "c", "y", "i", 0.5).collect()}
    assert all(got[i] == other[i] for i, *_ in rows if i <= 100)


def test_model_with_categories(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, str(rng.choice(["a", "b", "c"])), float(rng.normal())) for i in range(400)]
    df = spark.createDataFrame([(i, c, v, int((c == "a") ^ (rng.random() < 0.1))) for i, c, v in rows] + [(900, None, None, None)],
                               "id long, c string, v double, label int")
    m = BT.BoostedTrees(featureCols=["v"], categoryCols=["c"], growth={"mode": "oblivious", "rounds": 5, "max_depth": 2, "rate": 0.5}).fit(df)
    m.write().overwrite().save(str(tmp_path / "m"))
    back = BT.BoostedTreesModel.load(str(tmp_path / "m"))
    new = df.unionByName(spark.createDataFrame([(901, "unseen", 0.0, 0)], df.schema))
    a, b = (sorted((r["id"], r["probability"][1], r["prediction"]) for r in x.transform(new).collect()) for x in (m, back))
    assert a == b and len(a) == 402
    right = sum(int(p) == y for (i, _, p), (_, _, _, y) in zip(a, sorted(map(tuple, df.where("id < 900").collect()))))
    assert right >= 0.85 * 400
