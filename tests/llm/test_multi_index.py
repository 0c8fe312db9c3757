import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreflow.llm import multi_index as M

from .conftest import SF, same_rows

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, v string"


def integers(x):
    return [max(-M.LIMIT, min(M.LIMIT, math.floor(256 * float(np.float32(a))))) for a in x]


def brute(rows):
    sound = {(i, label, tuple(integers(x))) for i, x, label in rows if i is not None and label is not None and x is not None
             and all(a is not None and math.isfinite(a) for a in x)}
    out = []
    for i, label, x in sound:
        if i % 100:
            continue
        score = {r: sum(a * b for a, b in zip(x, r[2])) for r in sound if r != (i, label, x)}
        order = sorted(score, key=lambda r: (-score[r], r[0]))
        for p in [r for r in order if r[1] == label][:5]:
            ps = score[p]
            hard = [r for r in order if r[1] != label and 30 * ps <= 100 * score[r] <= 90 * ps][:10]
            out += [(i, p[0], k + 1, r[0], ps, score[r]) for k, r in enumerate(hard)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, label, "r", "v") for i, x, label in rows], SCHEMA)
    return sorted(map(tuple, M.mine(M.prepared(df), F.col("vec_id") % 100 == 0, **kw).collect()))


def vectors(n, dim, seed, spread=0.3, centres=12):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, dim))
    return [(i, (at[i % centres] + spread * rng.normal(size=dim)).tolist(), int(rng.integers(4))) for i in range(n)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    same_rows(M.op12_multi_index(spark, SF), con, M.ORACLE)


@pytest.mark.parametrize("kw", [{}, {"anchor_block": 3, "page_rows": 50, "shard_rows": 60, "cell_rows": 4, "codebook_rows": 40}])
def test_equals_brute_force(spark, kw):
    rows = vectors(900, 7, 1)
    assert run(spark, rows, **kw) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(230, 4, 2) + [(500, None, 1), (600, [1.0, None], 1), (700, [float("nan")], 1), (800, [float("inf"), 1.0], 1), (None, [1.0], 1),
                                 (900, [1.0, 2.0], None), (1000, [], 1), (1100, [1e30, -1e30], 2), (1200, [0.5], 0), (0, [1.0] * 4, 0), (0, [1.0] * 4, 0),
                                 (0, [1.0] * 4, 1), (1300, [0.0] * 6, 3)]
    assert run(spark, rows, page_rows=40, cell_rows=8) == brute(rows)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 0.5, -0.25], i % 2) for i in range(400)] + [(i, [0.6, 0.3, -0.15], i % 3) for i in range(400, 700)]
    assert run(spark, rows, page_rows=100, shard_rows=90) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(100, [1.0], 0)], [(100, [1.0], 0), (2, [1.0], 0)]])
def test_empty_and_tiny(spark, rows):
    assert run(spark, rows) == []


def test_certified_lists_leave_cells_unread():
    rows = vectors(6000, 16, 3, spread=0.02, centres=40)
    v = np.array([integers(x) for _, x, _ in rows])
    books = (M.codebook(v[:, :8], 40), M.codebook(v[:, 8:], 40))
    page = M.Page(np.arange(6000), np.array([r[2] for r in rows]), v, M.nearest(v[:, :8], books[0]), M.nearest(v[:, 8:], books[1]), books)
    own = (np.array([0, 100]), page.labels[[0, 1]], v[[0, 100]], True)
    lists = M.Lists(5)
    assert M.find_positives(page, own, lists) < 6000  # of 2 x 6000 rows
    assert len(lists.held[0, 0][0]) == 5


def test_cell_bounds_hold():
    rows = vectors(500, 10, 4)
    v = np.array([integers(x) for _, x, _ in rows])
    books = (M.codebook(v[:60, :5], 6), M.codebook(v[:60, 5:], 6))
    page = M.Page(np.arange(500), np.zeros(500), v, M.nearest(v[:, :5], books[0]), M.nearest(v[:, 5:], books[1]), books)
    got = np.concatenate(list(page.walk(v[3], np.inf, lambda: -np.inf)))
    assert sorted(got) == list(range(500))
    cut = int(np.sort(page.v @ v[3])[-20])
    got = np.concatenate(list(page.walk(v[3], np.inf, lambda: cut)))
    assert set(np.flatnonzero(page.v @ v[3] >= cut)) <= set(got.tolist())
