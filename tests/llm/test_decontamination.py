import re

from scoreflow.llm import decontamination as D
from tests.llm.conftest import SF, same_rows


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(w, k=5):
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for i, t in items:
        w = words(t)
        q = shingles(w, min(5, len(w))) if w else set()
        for d, text in docs:
            dw = words(text)
            m = len(q & shingles(dw, min(5, len(w)))) if q else 0
            if m and m / len(q) >= D.THRESHOLD:
                out.add((d, i, m, len(q)))
    return out


def test_query_equals_sql(spark, duck):
    same_rows(D.op4_decontamination(spark, SF), duck, D.ORACLE)


def test_short_items_in_long_documents(spark, documents):
    rng = __import__("random").Random(4)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    sizes = [1, 2, 3, 4, 5, 6, 8, 9, 13, 20, 37, 64, 150]
    items = [(i, text(n)) for i, n in enumerate(sizes)]
    docs = []
    for i, (item, t) in enumerate(items):
        docs.append((i, f"{text(300)} {t.upper()}! {text(3000)}"))
        w = t.split()
        if len(w) > 30:  # one word changed: still above the threshold
            w[3] = "changed"
            docs.append((100 + i, f"{text(50)} {' '.join(w)} {text(700)}"))
        docs.append((200 + i, f"{' '.join(t.split()[: len(w) // 2])} {text(40)}"))
    docs += [(300, None), (301, ""), (302, "..."), (303, items[6][1]), (303, items[6][1]), (None, items[7][1])]
    bench = spark.createDataFrame(items + [(90, None), (91, ""), (92, "!!")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["matched"], r["shingles"]) for r in D.contained_items(documents(docs), bench).collect()}
    want = brute([d for d in docs], items)
    assert got == want
    assert {(i, i) for i in range(len(items))} <= {(d, i) for d, i, *_ in got}


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contained_items(documents([]), bench).count() == 0
    assert D.contained_items(documents([(1, "a b c d e f")]), bench.limit(0)).count() == 0
    assert D.contained_items(documents([(1, "A b c, d e f")]), bench).count() == 1


def test_word_hashes_depend_on_the_word_only():
    a, b = D.Words(["the cat the", "über the"]), D.Words(["xx the"])
    assert a.hash[0] == a.hash[2] == a.hash[4] == b.hash[1] and len(set(a.hash.tolist())) == 3
    assert a.count.tolist() == [3, 2] and a.string(0, 3) == "the cat the"
