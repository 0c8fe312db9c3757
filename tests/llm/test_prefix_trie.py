import hashlib
import zlib

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from scoreflow.llm import prefix_trie as P

from .conftest import SF, same_rows

SCHEMA = "conv_id long, turn long, role string, text string, slots string, path string, part long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The contract, read plainly."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, P_md5(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append((c, d == len(path)))
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        out.append((min(c for c, _ in members), len(path), min(c for c, _ in nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in under),
                    sum(not any(q[:-1] == p for q in nodes if q) for p in under),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p),
                    hashlib.sha256(",".join(map(str, sorted(c for c, end in members if end))).encode()).hexdigest()))
    return sorted(out, key=repr)


def P_md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def run(spark, rows, shard_turns):
    df = spark.createDataFrame([(*r, "s", "p", 7) for r in rows], SCHEMA)
    return sorted(map(tuple, P.trie(P.spliced(P.paths(df)), shard_turns).select(*COLUMNS).collect()), key=repr)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    same_rows(P.op11_prefix_trie(spark, SF), con, P.ORACLE)


ODD = [(0, None, None, "first"), (0, 1, "user", None), (0, 1, "user", None), (0, 2, "user", "é𝄞x"), (1, 0, "user", "a"),
       (5, 3, "a", "b"), (5, 3, "a", "a"), (5, 1, None, None), (None, 1, "x", "lost"), (150, 0, "user", "hello"), (-3, 0, "u", "t"),
       (-3, 1, "u", "t"), (101, 0, "user", "é𝄞x"), *[(7, i, "user", f"turn {i}") for i in range(40)],
       *[(8, i, "user", f"turn {i}") for i in range(40)]]


@pytest.mark.parametrize("shard_turns", [3, 1000])
def test_odd_rows(spark, shard_turns):
    assert run(spark, ODD, shard_turns) == brute(ODD)


@pytest.mark.parametrize("shard_turns", [20, 10_000])
def test_copies_spread_over_shards(spark, shard_turns):
    rows = [(c, t, "user", f"same {t}") for c in range(60) for t in range(3)] + [(c, 0, "user", f"own {c}") for c in range(200, 230)]
    rows += [(c, t, "user", "x" * t + str(c // 4)) for c in range(300, 340) for t in range(9)]
    assert run(spark, rows, shard_turns) == brute(rows)


def test_long_texts_and_long_paths(spark):
    rows = [(200, 0, "user", "word " * 400_000), (207, 0, "user", "word " * 400_000)]
    rows += [(c, t, "user", str(t)) for c in (400, 401, 402) for t in range(300)]
    assert run(spark, rows, 250) == brute(rows)


def test_empty_table(spark):
    assert run(spark, [], 5) == []


def test_pieces_of_ends(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_BYTES", 8)
    rows = [(c, 0, "user", "one") for c in range(1000, 1300)]
    assert run(spark, rows, 50) == brute(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 320), st.integers(0, 4), st.sampled_from("ab"), st.sampled_from(["", "x", "yy"])), min_size=1, max_size=60),
       st.integers(1, 40))
def test_any_rows(spark, rows, shard_turns):
    assert run(spark, rows, shard_turns) == brute(rows)
