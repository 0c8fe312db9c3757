import numpy as np
import pandas as pd

from scoreflow.functions import exact_quantiles, mode_of


def test_exact_quantiles_hot_group_and_ties(spark):
    rng = np.random.default_rng(7)
    n = 30000
    g = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.normal(100, 30, n), 1)
    v[rng.random(n) < 0.2] = 50.0  # a heavily tied value
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    for key, part in pdf.groupby("g"):
        exp = np.quantile(part["v"].dropna().to_numpy(), probs)
        assert np.allclose(got[key], exp, rtol=0, atol=1e-9), key
    glob = exact_quantiles(df, "v", [0.5]).collect()[0][0]
    assert abs(glob - np.quantile(pdf["v"].dropna(), 0.5)) < 1e-9


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("Q",), ("S",), ("Q",), ("S",), (None,), ("C",)], "p string")
    assert mode_of(df, "p").collect()[0][0] == "Q"


def test_small_groups_and_edge_ranks(spark):
    import itertools
    rng = np.random.default_rng(3)
    rows = []
    for g, n in enumerate([1, 2, 3, 5, 6, 7, 11, 60, 61]):
        rows += [(g, float(x)) for x in rng.integers(0, 9, n)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))]
           for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    for g, grp in itertools.groupby(rows, key=lambda r: r[0]):
        vals = [v for _, v in grp]
        assert np.allclose(got[g], np.quantile(vals, probs), atol=1e-9), g


def test_null_group_stays(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, v double")
    got = {r["g"]: r["q0"] for r in exact_quantiles(df, "v", [0.5], by=["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}
