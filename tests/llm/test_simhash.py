import itertools
import re

import numpy as np
import xxhash

from scoreflow.llm import simhash as S
from scoreflow.llm.graph import components
from tests.llm.conftest import SF


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items, linked):
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(items)), 2):
        if linked(items[i], items[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def near(a, b):
    return (a ^ b).bit_count() <= S.RADIUS


def test_query_against_brute_force(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    d = sorted(d, key=lambda r: r["doc_id"])
    fps = [brute_fingerprint(r["text"]) for r in d]
    comp = brute_components(fps, near)
    got = {r["doc_id"]: r for r in S.op3_simhash(spark, SF).collect()}
    assert len(got) == len(d)
    for i, r in enumerate(d):
        assert got[r["doc_id"]]["fingerprint"] == f"{fps[i]:016x}"
        assert got[r["doc_id"]]["component_id"] == d[comp[i]]["doc_id"]


def test_bit_sliced_comparison_against_brute_force():
    rng = np.random.default_rng(0)
    fp, group = [], []
    for i, b in enumerate(rng.integers(0, 2**63, 40)):
        for _ in range(rng.integers(1, 30)):
            x = int(b)
            for _ in range(rng.integers(0, 5)):
                x ^= 1 << int(rng.integers(0, 64))
            fp.append(x)
            group.append(i // 3)
    pairs = sorted(set(zip(group, fp)))
    group, fp = np.array([g for g, _ in pairs]), np.array([x for _, x in pairs], np.uint64)
    u, v = S.merged(fp, group)
    label = {p: i for i, p in enumerate(pairs)}
    edges = {(label[g, int(a)], label[g, int(b)]) for a, b in zip(u, v) for g in set(group) if (g, int(a)) in label and (g, int(b)) in label}
    want = brute_components(pairs, lambda x, y: x[0] == y[0] and near(x[1], y[1]))
    have = brute_components(range(len(pairs)), lambda i, j: (i, j) in edges or (j, i) in edges)
    assert want == have
    d = 3
    planes = S._planes(fp)
    live = np.packbits(np.ones(planes.shape[1] * 64, bool), bitorder="little").view("<u8")
    close = np.unpackbits(S.close_lanes(planes, S._moved(planes, d), live).view(np.uint8), bitorder="little")[:len(fp) - d]
    assert close.tolist() == [int(near(int(a), int(b))) for a, b in zip(fp, fp[d:])]


def test_large_buckets_are_dealt_again_without_loss(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    fps = {base}
    for _ in range(300):  # all share the upper half: one bucket of the first level
        x = base
        for _ in range(int(rng.integers(1, 7))):
            x ^= 1 << int(rng.integers(0, 32))
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    comp = brute_components(fps, near)
    for bucket in (8, 10_000):
        roots = {r["node"]: r["root"] for r in components(S.links(df, bucket=bucket)).collect()}
        assert [roots.get(x, x) for x in fps] == [fps[c] for c in comp]


def test_components_of_a_long_chain(spark):
    n = 300
    order = np.random.default_rng(5).permutation(n)
    edges = [(int(order[i]), int(order[i + 1])) for i in range(n - 1)] + [(1000, 1001), (1001, 1001)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(n)} == {0} and got[1001] == got[1000] == 1000
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_defined_cases(spark, documents):
    long = "alpha beta gamma " * 30_000
    rows = [(5, None), (6, ""), (7, " \t\n"), (1, "One two"), (2, "ONE   two"), (3, "x y z w"), (3, "x y z w"), (None, "x y z w"), (9, long)]
    df = documents(rows)
    got = S.near_duplicates(df).collect()
    assert len(got) == len(rows)
    comp = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    by = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by[5] == by[6] == by[7] == 5 and by[2] == 1 and by[3] == 3
    assert [c for (i, _), c in comp.items() if i is None] == [3]
    assert {r["fp"] for r in got if r["doc_id"] in (5, 6, 7)} == {0}
    assert S.near_duplicates(df.limit(0)).count() == 0
    kept = sorted((r["doc_id"] for r in S.first_of_each(df).collect()))
    assert kept == sorted(set(by.values()))
    assert S.first_of_each(documents([(None, "a b c"), (None, "a b c"), (None, "d e f")])).count() == 2
