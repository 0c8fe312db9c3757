import hashlib
import math
import random
import re
import string

from pyspark.sql import functions as F

from scoreflow.llm import secret_scan as S
from tests.llm.conftest import SF

KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api"))
ASSIGN = re.compile("((?:" + KEY.replace("[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]") + r"""))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def listed(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in S.op7_secret_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        base, g = brute_base(r["text"]), got[r["doc_id"]]
        assert g["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert [g["n_assign"], g["n_access"], g["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, listed(base).split(","))) <= set(g["spans"].split(","))


CASES = [None, "", "secret=token:abcdefgh", 'My "API_KEY" : "abc.def-123"', "TOKEN==abcdef passwd: short",
         "AKIAAKIA" + "A1" * 8, "AKIA123", "x" + "ab12" * 7 + "g", "é😀 secret = a/b+c_d=é secret:zzzzzz", "password:" + "a" * 5000,
         "token=abc123 " * 3000, "d41d8cd98f00b204e9800998ecf8427e password='d41d8cd98f00b204e9800998ecf8427e'"]


def test_spans_of_odd_texts(spark, documents):
    df = documents(list(enumerate(CASES)))
    got = {r["doc_id"]: [(x["start"], x["kind"], x["end"]) for x in r["base"]] for r in S.analyse(df, ["doc_id"]).collect()}
    assert got == {i: brute_base(t) for i, t in enumerate(CASES)}
    assert S.analyse(df.limit(0), ["doc_id"]).count() == 0


def test_random_tokens_are_found_and_words_are_not(spark, documents):
    rng = random.Random(2)
    token = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    planted = [token(40, string.ascii_letters + string.digits) for _ in range(40)]
    plain = ["Donaudampfschifffahrtsgesellschaftskapitaen", "z" * 60, "abcdefghijklmnopqrstuvwxyzabcdefghij", "ghij0123456789" * 4,
             "internationalization-and-localization", "example/com/path/to/some/page/of/words", "UPPERCASEWORDSRUNTOGETHERINALINE"]
    rows = [(i, f"see {t} here") for i, t in enumerate(planted)] + [(100 + i, f"see {t} here") for i, t in enumerate(plain)]
    found = S.analyse(documents(rows), ["doc_id"]).cache()
    spans = {r["doc_id"]: r["s"] for r in found.select("doc_id", S.listed(S.all_spans(S.thresholds(found))).alias("s")).collect()}
    assert sum(spans[i] == "random:4:44" for i in range(40)) >= 38
    assert not any(spans[100 + i] for i in range(len(plain)))


def test_secrets_behind_names_and_in_paths(spark, documents):
    rng = random.Random(5)
    token = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    b62 = string.ascii_letters + string.digits

    def mixed(n, signs):  # every sign is in it
        return token(n // 2, b62) + signs + token(n - n // 2 - len(signs), b62 + signs)

    rows, want = [], {}
    for i in range(20):
        for before, value, after in (("sig=", token(40, b62), ""), ("AccountKey=", mixed(44, "+/"), "=="), ("auth=", token(64, "0123456789ABCDEF"), ""),
                                     ("/reset/", mixed(43, "-_"), ""), ("build-tools_x=", mixed(44, "+/"), ""), ("-my_key-", mixed(60, "+/"), ""),
                                     ("=", token(40, b62), ""), ("", "".join(token(9, b62) + c for c in "-+_/-+") + token(9, b62), "")):
            j = len(rows)
            rows.append((j, f"é see {before}{value}{after} here"))
            want[j] = f"random:{6 + len(before)}:{6 + len(before + value + after)}"
    plain = ["name=internationalization-and-localization", "/docs/user-guide/getting_started/first-steps", "key=value=other=value=thing",
             "path=/usr/share/some-package/default_settings", "====================", "_-/+_-/+_-/+_-/+_-/+_-/+"]
    rows += [(1000 + i, f"see {t} here") for i, t in enumerate(plain)]
    found = S.analyse(documents(rows), ["doc_id", "text"]).cache()
    spans = S.all_spans(S.thresholds(found))
    got = {r["doc_id"]: r for r in found.select("doc_id", S.listed(spans).alias("s"), S.redacted(F.col("text"), spans).alias("t")).collect()}
    for kind in range(8):
        assert sum(got[j]["s"] == want[j] for j in range(kind, 160, 8)) >= 18, kind
    found_first = next(j for j in range(0, 160, 8) if got[j]["s"] == want[j])
    assert got[found_first]["t"] == "é see sig=[SECRET] here"
    assert not any(got[1000 + i]["s"] for i in range(len(plain)))


def test_battery_against_python(spark):
    a = S.DIGITS + S.LOWER[:6]
    rng = random.Random(1)
    tokens = ["".join(rng.choice(a) for _ in range(n)) for n in (20, 33, 64)] + ["0f" * 20, "0" * 30, "00112233445566778899aabbccddeeff"]

    def p(t):
        n, k = len(t), len(a)
        x = [a.index(c) + 1 - (k + 1) / 2 for c in t]
        chi = (k / n * sum(t.count(c) ** 2 for c in a) - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
        high = sum(v > 0 for v in x)
        two = 2 * high * (n - high)
        runs = 1 + sum((u > 0) != (v > 0) for u, v in zip(x, x[1:]))
        run = (runs - 1 - two / n) / math.sqrt(max(two * (two - n) / (n * n * (n - 1)), 1e-9))
        serial = sum(u * v for u, v in zip(x, x[1:])) / ((k * k - 1) / 12) / math.sqrt(n - 1)
        half = -sum(math.log(max(math.erfc(abs(z) / math.sqrt(2)), 1e-300)) for z in (chi, run, serial))
        return math.exp(-half) * (1 + half + half * half / 2)

    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    rows = F.array(F.struct(F.col("t").alias("token"), F.lit(a).alias("alphabet")))
    got = [r[0] for r in df.select(S.battery(rows)[0]["p"]).collect()]
    assert all(abs(x - p(t)) < 1e-3 for x, t in zip(got, tokens))
    assert min(got[:3]) > S.RANDOM_P > max(got[3:])


def test_false_discovery_threshold(spark):
    # 1000 tokens of no evidence and 20 of 20 bits: 2 ** -20 * 1020 <= 0.01 * 20
    tok = "struct<start:int,kind:int,end:int,stratum:int,bits:int,p:double>"
    df = spark.createDataFrame([([(0, 3, 9, 1, 0, 1.0)],)] * 1000 + [([(0, 3, 9, 1, 20, 1.0)],)] * 20 + [([(0, 3, 9, 2, 5, 1.0)],)] * 50,
                               f"tokens array<{tok}>")
    assert S.thresholds(df) == {1: 20}


def test_running_sum_and_redaction(spark):
    df = spark.createDataFrame([([i % 7 for i in range(1000)],), ([],), ([3],)], "a array<int>")
    got = [r[0] for r in df.select(S.running_sum(F.col("a"))).collect()]
    want = [0]
    for i in range(999):
        want.append(want[-1] + i % 7)
    assert got == [want, [], [0]]
    d = spark.createDataFrame([("é secret=abcdef x", [(2, 0, 15), (9, 2, 16)]), ("clean", []), (None, [])],
                              "t string, s array<struct<start:int,kind:int,end:int>>")
    assert [r[0] for r in d.select(S.redacted(F.col("t"), F.col("s"))).collect()] == ["é [SECRET]x", "clean", None]
