import hashlib
import itertools
import re

import numpy as np
import pytest

from scoreflow.llm import pii as P
from scoreflow.llm.bilstm_crf import BiLstmCrf
from tests.llm.conftest import SF

BASE = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_base(text):
    def ok(k, s):
        d = re.sub("[^0-9]", "", s)
        return [True, k == 1 and all(int(x) <= 255 for x in s.split(".")), 16 <= len(d) <= 19 and P.luhn(d), 8 <= len(d) <= 15][k]

    return [(k, m.start(), m.end()) for k, r in enumerate(BASE) for m in r.finditer(text or "") if ok(k, m.group())]


def listed(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in spans)


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet(f"{SF[:-4]}0.1/documents.parquet"))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in P.op10_pii(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        base, g = brute_base(r["text"]), got[r["doc_id"]]
        assert g["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert [g[f"n_{k}"] for k in P.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        spans = [s for s in g["spans"].split(",") if s]
        assert set(listed(base).split(",")) - {""} <= set(spans)
        parts = [(P.KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in spans)]
        assert parts == sorted(parts)


@pytest.mark.parametrize("text", [
    None, "", "a@b", "a@b.c", "a@b.c@d.e", "a@b.c.d@e.f x@y", "a@b.c%x@d.e", "@a.b", "x@@y.z", "a@b.c-d.e-f@g.h", "1.2.3.4.5.6.7.8",
    "1.2.3.256", "999999999999999999.1.1.1", "01.002.3.4", "4539 1488 0343 6467", "4539-1488-0343-6467 4539148803436468", "1  2", "+1 (337) 555-7349",
    "+1", "+1-2-3", "++1 23456789 +49 (0)30 1234567890123", "é+12345678😀 a@é.b.c", "0" * 2000, "a" * 3000 + "@", "1." * 999, "@" * 500])
def test_base_rules(text):
    assert P.base_spans(text or "") == brute_base(text)


def test_gradient_against_differences():
    m = BiLstmCrf.new(7, 5, 3, 4)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 7, (3, 6)), rng.integers(0, 5, (3, 6))
    _, g = m.loss(x, y)
    for k in m.p:
        for _ in range(6):
            i = tuple(rng.integers(0, n) for n in m.p[k].shape)
            v = m.p[k][i]
            m.p[k][i] = v + 1e-5
            up = m.loss(x, y)[0]
            m.p[k][i] = v - 1e-5
            down = m.loss(x, y)[0]
            m.p[k][i] = v
            assert abs((up - down) / 2e-5 - g[k][i]) < 1e-6


def test_viterbi_and_probabilities_against_all_sequences():
    m = BiLstmCrf.new(7, 3, 3, 4)
    x = np.random.default_rng(2).integers(0, 7, (2, 5))
    tags, chance = m.decode(x)
    e = m.emissions(x)
    for r in range(2):
        total, share, best = 0.0, np.zeros((5, 3)), (-1e9, None)
        for q in itertools.product(range(3), repeat=5):
            s = m.p["first"][q[0]] + m.p["last"][q[-1]] + sum(e[i, r, t] for i, t in enumerate(q))
            s += sum(m.p["move"][a, b] for a, b in zip(q, q[1:]))
            best = max(best, (s, q))
            total += np.exp(s)
            for i, t in enumerate(q):
                share[i, t] += np.exp(s)
        assert tuple(tags[r]) == best[1]
        assert np.allclose(chance[r], [share[i, t] / total for i, t in enumerate(best[1])])


def test_held_out_spans(spark, model, duck):
    """Windows of documents that the sample left out: the tagger alone finds nearly all labelled spans."""
    texts = [r[0] for r in duck.sql("select text from documents").fetchall()]
    truth = found = made = 0
    for t in texts:
        windows = [(p, tags) for p, tags in P.training_windows(t)]
        if not windows:
            continue
        tags, chance = model.decode(np.stack([P.window_ids(p, 0) for p, _ in windows]))
        for (p, want), a, c in zip(windows, tags, chance):
            gold = {(k, x, y) for k, x, y, _ in P.tag_spans(np.array(list(want), int), np.ones(len(want)))}
            mine = {(k, x, min(y, len(p))) for k, x, y, _ in P.tag_spans(a, c)}
            truth, found, made = truth + len(gold), found + len(gold & mine), made + len(mine)
    assert truth > 50 and found / truth > 0.9 and found / made > 0.85


def test_added_spans(spark, model, documents):
    rows = [(1, "of the 1-337-555-7349 and thnd or hean"), (2, "the 4539.1488.0343.6467 in on re"), (3, "x" * 200 + " +1 (337) 555-7349 " + "y" * 90),
            (4, "the 4539.1488.0343.6468 in on re"), (5, None), (6, ""), (7, "plain words only"), (8, "re 12 thnd 7 of 2024 the"),
            (9, "of the 1-337-555-7349 and thnd or hean")]
    got = {r["doc_id"]: r for r in P.find(documents(rows), model, ["doc_id"]).collect()}
    spans = {i: [(P.KINDS[s["kind"]], s["start"], s["end"]) for s in r["spans"]] for i, r in got.items()}
    assert spans[1] == spans[9] == [("phone", 7, 21)] and spans[2] == [("card", 4, 23)]
    assert spans[3] == [("phone", 201, 218)] and not any(spans[i] for i in (4, 5, 6, 7, 8))  # 4: a wrong check digit
    assert P.find(documents([]), model, ["doc_id"]).count() == 0
    assert [r["spans"] for r in P.find(documents([(1, "no model 1-337-555-7349")]), None, ["doc_id"]).collect()] == [[]]


SPELLINGS = {
    "email a @ b.com": ("email", lambda d: f"{d['w']}{d['n'][:2]} @ {d['v']}.com"), "email a @ b . com": ("email", lambda d: f"{d['w']} @ {d['v']} . com"),
    "ip spaced": ("ip", lambda d: " . ".join(d["o"])), "card dots": ("card", lambda d: ".".join(d["c"])), "card underscores": ("card", lambda d: "_".join(d["c"])),
    "phone ddd-ddd-dddd": ("phone", lambda d: f"{d['a']}-{d['b']}-{d['n']}"), "phone 1-": ("phone", lambda d: f"1-{d['a']}-{d['b']}-{d['n']}"),
    "phone (ddd)": ("phone", lambda d: f"({d['a']}) {d['b']}-{d['n']}"), "phone dots": ("phone", lambda d: f"{d['a']}.{d['b']}.{d['n']}"),
    "phone 00": ("phone", lambda d: f"0044 {d['a']} {d['b']}{d['n']}"),
}


def test_recall_of_each_spelling(spark, duck):
    """Trained as the query trains; planted once per text among words of the corpus, found by place at the product's own score."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    model = P.train(docs)
    rng = np.random.default_rng(9)
    words = [w for r in duck.sql("select text from documents where lang = 'en' limit 60").fetchall() for w in r[0].split() if w.isalpha()]
    recall, made, right = {}, 0, 0
    for name, (kind, spell) in SPELLINGS.items():
        texts, want = [], []
        for _ in range(60):
            digits = "".join(rng.choice(list("0123456789"), 15))
            check = next(x for x in "0123456789" if P.luhn(digits + x))
            card = digits + check
            d = {"w": rng.choice(words).lower(), "v": rng.choice(words).lower(), "n": "".join(rng.choice(list("0123456789"), 4)),
                 "a": str(rng.integers(201, 999)), "b": str(rng.integers(201, 999)), "o": [str(rng.integers(0, 256)) for _ in range(4)],
                 "c": [card[i:i + 4] for i in range(0, 16, 4)]}
            left, right_ = " ".join(rng.choice(words, rng.integers(3, 30))), " ".join(rng.choice(words, rng.integers(3, 30)))
            span = spell(d)
            texts.append(f"{left} {span} {right_}")
            want.append((kind, len(left) + 1, len(left) + 1 + len(span)))
        base = [P.base_spans(t) for t in texts]
        got = [[(P.KINDS[k], a, b) for k, a, b in sorted(x + y)] for x, y in zip(base, P.added_spans(texts, base, model))]
        recall[name] = sum(w in g for w, g in zip(want, got)) / len(texts)
        made += sum(map(len, got))
        right += sum(w in g for w, g in zip(want, got))
    print(recall, right / made)
    assert min(recall.values()) >= 0.9, recall
    assert right / made >= 0.9
    plain = [r[0] or "" for r in duck.sql("select text from documents").fetchall()]
    base = [P.base_spans(t) for t in plain]
    assert sum(map(len, P.added_spans(plain, base, model))) <= 0.05 * sum(map(len, base))  # little beyond the rules in the corpus itself


def test_added_spans_touch_no_base_span(monkeypatch):
    """Many short base spans inside a long one: the long one's end counts."""
    text = "a1.1.1.1_b2.2.2.2_c3.3.3.3_d4.4.4.4_1-337-555-7349@x.com"
    base = [P.base_spans(text)]
    at = text.index("1-337")

    class Stub:
        def decode(self, ids):
            tags, chance = np.zeros(ids.shape, int), np.ones(ids.shape)
            for r in range(len(ids)):
                if len(ids) and at + 14 <= P.WINDOW:
                    tags[r, at], tags[r, at + 1:at + 14] = 7, 8
            return tags, chance

    assert P.added_spans([text], base, Stub()) == [[]]


def test_reconcile_joins_cut_pieces_and_picks_the_best_set():
    cut = [(0, 10, 40, 0.9, False, True), (0, 30, 70, 0.8, True, False)]
    assert P.reconcile(cut) == [(0, 10, 70, 0.9)]
    # one long span against two shorter ones that add up to more
    clash = [(0, 0, 10, 0.9, False, False), (1, 5, 15, 0.95, False, False), (2, 12, 22, 0.9, False, False)]
    assert [s[0] for s in P.reconcile(clash)] == [0, 2]
    assert P.reconcile([]) == [] and P.reconcile([(1, 2, 5, 0.9, False, False)] * 2) == [(1, 2, 5, 0.9)]


def test_windows_cover_every_hot_character():
    text = "".join("7" if i % 89 == 0 else "a" for i in range(2000))
    starts = P.window_starts(text)
    for i in range(0, 2000, 89):
        assert sum(s <= i < s + P.WINDOW for s in starts) >= (2 if i >= P.STRIDE else 1)
    assert P.window_starts("none") == []


def test_training_without_labels(spark, documents):
    assert P.train(documents([(1, "no labels here"), (2, None)])) is None
