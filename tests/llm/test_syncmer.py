import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from scoreflow.llm import syncmer as S
from tests.llm.conftest import SF


def h64(*parts):
    """Spark's chained xxhash64 of strings or longs (seed 42)."""
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_anchors(text, k=S.K, s=S.S):
    pieces = re.findall(r"[^ \t\n\x0b\f\r]", text)
    g = [h64("".join(pieces[i:i + s])) for i in range(len(pieces) - s + 1)]
    w = k - s + 1
    out = []
    for i in range(len(g) - w + 1):
        low = min(g[i:i + w])
        if low in (g[i], g[i + w - 1]):
            steps = sorted({*range(0, w, s), w - 1})
            out.append((i, h64(*[g[i + j] for j in steps]) & 0xFFFFFFFF))
    return out


def brute_sketch(text):
    found = {h for _, h in brute_anchors(text)}
    if not found and text:
        found = {h64(text) & 0xFFFFFFFF}
    return sorted(found)[:S.SKETCH]


def likeness(a, b):
    joint = sorted({*a, *b})[:S.SKETCH]
    return len([x for x in joint if x in a and x in b]) / len(joint) if joint else 1.0


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, e, n = brute_sketch(text), brute_sketch(edited), brute_sketch(after)
        hexed = lambda x: "".join(f"{v:08x}" for v in x)
        g = got[key]
        assert g["n_chars"] == len(text) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert g["fingerprint"] == hexed(a) and g["edited_fingerprint"] == hexed(e)
        assert abs(g["near_edited"] - likeness(a, e)) < 1e-12 and abs(g["near_next"] - likeness(a, n)) < 1e-12


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in S.op9_syncmer(spark, SF).collect()}
    assert len(got) == len(rows)
    check(rows, got)
    long = [r for r in got.values() if r["n_chars"] > 300]
    assert all(r["near_edited"] > r["near_next"] for r in long)


@pytest.mark.parametrize("k,s", [(4, 1), (5, 2), (7, 3), (3, 1), (12, 5)])
def test_anchors_against_brute_force(spark, k, s):
    rng = random.Random(k)
    texts = ["", "one", "a b c d", " ".join(rng.choice(["aa", "b", "cccccccccccccccc", "é😀x"]) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in S.add_anchors(df, "text", "a", k, s).collect():
        assert [(x["pos"], x["hash"]) for x in r["a"]] == brute_anchors(r["text"], k, s)


def test_anchors_are_context_free():
    passage = " ".join(f"word{i * 7919 % 1000}" for i in range(60))
    alone = {h for _, h in brute_anchors(passage)}
    inside = {h for _, h in brute_anchors("some other words before it " + passage + " and after it")}
    assert alone <= inside


def test_passages_without_spaces_keep_their_anchors(spark):
    """Moved by any offset, or behind an inserted character."""
    rng = random.Random(4)
    for signs in ("的一是不了人我在有他这中大来上国日本語ですます", "0123456789abcdefABCDEF+/"):
        passage = "".join(rng.choice(signs) for _ in range(300))
        texts = [passage] + ["x" * i + passage + "y" for i in range(1, 9)] + [passage[:9] + "x" + passage[9:]]
        df = S.with_sketch(S.add_anchors(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", "a"), "text", "s")
        got = {r["doc_id"]: ({x["hash"] for x in r["a"]}, r["s"]) for r in df.collect()}
        assert all(got[0][0] <= got[i][0] for i in range(1, 9)) and len(got[0][0]) > 20
        assert min(likeness(got[0][1], got[i][1]) for i in range(1, 10)) > 0.7
    short = S.add_anchors(spark.createDataFrame([("one two three",)], "text string"), "text", "a").first()
    assert [x["hash"] for x in short["a"]] == [h for _, h in brute_anchors("one two three")]


def test_edited_texts_against_brute_force(spark, tmp_path):
    """White space and short texts about the seam."""
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["a", "b", "é😀", " ", "  \n", "語"]) for _ in range(rng.choice([0, 1, 2, 5, 11, 12, 13, 24, 25, 60])))) for i in range(150)]
    rows += [(200, None), (201, " " * 40), (202, "a" + " " * 60), (203, " " * 60 + "b"), (204, "ab" * 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check(rows, {r["doc_id"]: r for r in S.op9_syncmer(spark, str(tmp_path)).collect()})


def test_next_document_over_odd_ids(spark, monkeypatch):
    """Ids in clumps, far apart and null; small buckets so that most neighbours lie in other buckets."""
    monkeypatch.setattr(S, "RANGE_ROWS", 3)
    rng = random.Random(8)
    ids = list(range(40)) + [10**6 + i * 1000 for i in range(20)] + [-5, -10**12, 10**15, 7 * 10**15]
    rows = [(i, f"text {rng.random()} of {i} " * rng.randint(1, 9)) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in S.with_next(df, ["text"]).collect()}
    order = sorted(rows, reverse=True)
    assert got == {k: order[(i + 1) % len(order)][1] for i, (k, _) in enumerate(order)}
    null = S.with_next(df.unionByName(spark.createDataFrame([(None, "last")], df.schema)), ["text"]).collect()
    by = {r["doc_id"]: r["next_text"] for r in null}
    assert by[-10**12] == "last" and by[None] == order[0][1]


def test_one_id_with_many_texts_is_cut(spark, monkeypatch):
    """A third of all rows under one id, others without any: their order goes by the hash of the text, over many ranges."""
    monkeypatch.setattr(S, "RANGE_ROWS", 20)
    rows = [(i, f"own {i}") for i in range(200)] + [(77, f"hot {i}") for i in range(150)] + [(None, f"none {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["text"]: r["next_text"] for r in S.with_next(df, ["text"]).collect()}
    order = [t for _, _, _, t in sorted((i is None, -(i or 0), h64(t), t) for i, t in rows)]
    assert got == {t: order[(i + 1) % len(order)] for i, t in enumerate(order)}
    dealt = S.with_next(df.withColumn("at", F.lit(1)), ["text"]).withColumn("p", F.spark_partition_id())
    assert dealt.where("doc_id = 77").select("p").distinct().count() > 3


def test_defined_cases(spark, documents):
    def run(rows):
        d = documents(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        return S.with_next(S.with_sketch(d, "text", "sketch"), ["text", "sketch"]).collect()

    one = run([(3, "only one document here")])
    assert one[0]["next_text"] == one[0]["text"]
    assert run([]) == []
    same = run([(1, None), (2, ""), (4, "x"), (4, "x"), (4, "y"), (9, "long " * 40_000)])
    assert len(same) == 6 and [r["sketch"] for r in same if r["doc_id"] < 3] == [[], []]
    fours = [r for r in same if r["doc_id"] == 4]
    assert sorted(r["next_text"] for r in fours)[0] == "" and len({tuple(r["sketch"]) for r in fours if r["text"] == "x"}) == 1
    df = spark.createDataFrame([([], []), ([1], []), ([1, 2], [2, 3])], "a array<bigint>, b array<bigint>")
    assert [r["l"] for r in S.likeness(df, "a", "b", "l").collect()] == [1.0, 0.0, 1 / 3]
