"""Secret scans with a randomness test battery, in DataFrame functions only.

Base rules (assignments, access keys, long hex) are regular expressions.  The method looks at every
other long token: its encoding is inferred from its characters (digits, hex, base 32, letters,
letters and digits, base 64), and over that alphabet three tests ask whether it looks random:
chi-squared uniformity of its characters, the runs test about the middle of the alphabet, and lag-1
serial correlation.  Their p-values are combined by Fisher's method; a token that fails
``RANDOM_P`` is structured and dropped.

A token that fits no encoding is split at its inner '=' (name from value); a part that still fits none
mixes '+' or '/' with '-' or '_' and is split at the one kind or the other, whichever leaves the part of
most evidence (below), or, where neither leaves a part of ``LEAST`` characters, tested whole over all of its
characters.  Parts of ``LEAST`` or more are tested each with its own offsets, shorter ones are not long
tokens; the ways tried count as further encodings.  A token that fits an encoding is tested whole only.

Looking random is not enough for a short token, as short words pass such tests too.  The likelihood
ratio of the uniform model to a model of ordinary text (letter frequencies, runs of one character class) is an e-value, so 2 ** -bits
is a valid p-value against "ordinary text" (times the number of encodings tried); it sharpens with
the length.  Benjamini-Hochberg control at ``FDR`` runs over all tokens of the corpus, per length
stratum, on whole bits: the counts per stratum and bit are some hundred rows whatever the corpus.

Match positions come from the lengths of the pieces between the matches, summed in chunks, so a text
with many matches costs no quadratic work.

Defined results: null and empty texts have no spans; spans are (start, end) in code points, end
exclusive, ordered by start, then kind as listed, then end; padding ('=' at the end of a token) belongs to
the last part; a token that overlaps a base span is not
reported again; repeated rows are scanned alike; an empty table gives an empty result; columns are kept
where named, ``base`` and ``tokens`` being taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, written

#: The base rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api"]
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 or more: a match is a whole run either way
HEX = r"[0-9a-f]{24,}"  # as [0-9a-f]+ of 24 or more, for the same reason
KINDS = ["assign", "access", "hex", "random"]

LEAST = 20
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (pattern, alphabet), the first that fits is the encoding.
ENCODINGS = [
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("^[a-z]+$", LOWER),
    ("^[A-Z]+$", UPPER),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
]
#: Parts of a token in no encoding, the ways to split a part that still fits none, and the alphabet of one that can't be split.
VALUES = r"[^=]{%d,}" % LEAST
WAYS = [r"[^+/]{%d,}" % LEAST, r"[^_-]{%d,}" % LEAST]
ALL = UPPER + LOWER + DIGITS + "+/-_"
#: Relative frequencies (per cent) of the letters a to z in English text.
LETTERS = [8.17, 1.49, 2.78, 4.25, 12.70, 2.23, 2.02, 6.09, 6.97, 0.15, 0.77, 4.03, 2.41,
           6.75, 7.51, 1.93, 0.10, 5.99, 6.33, 9.06, 2.76, 0.98, 2.36, 0.15, 1.97, 0.07]
SIGNS = "+/-_="
#: In ordinary text a character is of the same class (lower, upper, digit, sign) as the one before with
#: this chance, of each other class with a third of the rest.
SAME_CLASS = 0.85
STRATA = [24, 32, 48, 96]  # upper ends of the length strata; the last is open
RANDOM_P = 0.001
FDR = 0.01
MOST_BITS = 200
CHUNK = 128


def running_sum(lengths: Column) -> Column:
    """Sums of the elements before each element, chunk by chunk."""

    def within(chunk, base):
        return F.aggregate(chunk, F.struct(base.alias("at"), F.expr("array()").cast("array<int>").alias("all")),
                           lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
                           lambda acc: acc["all"])

    n = F.size(lengths)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(CHUNK))
    chunks = F.transform(starts, lambda s: F.slice(lengths, s, CHUNK))
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(chunks, within(sums, F.lit(0)), within))


def matches(text: Column, pattern: str, kind: int) -> Column:
    """array<struct<start, kind, end, match>> of the leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda g: F.char_length(g))
    both = F.zip_with(gaps, found, lambda g, m: g + F.char_length(m))
    before = F.zip_with(running_sum(both), gaps, lambda s, g: s + g)
    return F.zip_with(before, found, lambda s, m: F.struct(
        s.alias("start"), F.lit(kind).alias("kind"), (s + F.char_length(m)).alias("end"), m.alias("match")))


SPAN = "struct<start:int,kind:int,end:int>"


def _where(condition: Column, spans: Column, kind: str) -> Column:
    return F.when(condition, spans).otherwise(F.expr("array()").cast(f"array<{kind}>"))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the base rules, ordered by start, then kind."""

    def bare(x):
        return F.struct(x["start"], x["kind"], x["end"])

    low = F.lower(text)
    maybe = F.lit(False)
    for w in ASSIGN_WORDS:
        maybe = maybe | low.contains(w)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.filter(F.zip_with(matches(text, ASSIGN, 0), values, lambda m, v: F.struct(
        m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"), F.char_length(v).alias("n"))),
        lambda x: x["n"] >= ASSIGN_VALUE)
    return F.array_sort(F.concat(
        _where(maybe, F.transform(assign, bare), SPAN),
        _where(text.contains("AKIA"), F.transform(matches(text, ACCESS, 1), bare), SPAN),
        _where(text.rlike(HEX), F.transform(matches(text, HEX, 2), bare), SPAN)))


def _text_bits() -> list[float]:
    """Bits of each of LOWER + UPPER + DIGITS + SIGNS, its class being known."""
    letters = [-math.log2(x / sum(LETTERS)) for x in LETTERS]
    return letters * 2 + [math.log2(10)] * 10 + [math.log2(len(SIGNS))] * len(SIGNS)


def ordinary_bits(token: Column, n: Column) -> Column:
    """Bits (minus log2 of the probability) of a token of n characters under the model of ordinary text."""
    chars = LOWER + UPPER + DIGITS + SIGNS
    costs = F.array(*[F.lit(c) for c in _text_bits()])
    own = F.aggregate(F.split(token, ""), F.lit(0.0), lambda s, c: s + F.get(costs, F.instr(F.lit(chars), c) - 1))
    classes = F.translate(token, chars, "l" * 26 + "u" * 26 + "d" * 10 + "s" * len(SIGNS))
    switches = F.char_length(F.regexp_replace(classes, r"(.)\1*", "$1")) - 1
    return own + 2 - switches * math.log2((1 - SAME_CLASS) / 3) - (n - 1 - switches) * math.log2(SAME_CLASS)


def token_bits(token: Column, n: Column, k: Column, tries: Column) -> Column:
    """Evidence of n characters from an alphabet of k against ordinary text, ``tries`` encodings being tried."""
    return ordinary_bits(token, n) - n * F.log2(k) - F.log2(tries)


def _two_sided(z: Column) -> Column:
    """Two-sided normal p-value (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-300))


def battery(rows: Column) -> Column:
    """``rows``: array of structs with ``token`` and ``alphabet`` (every character of the token is in
    it).  Adds ``p``, the p-value of the three tests.  Each step names its results in a struct, so
    that the next can use them twice without computing them twice."""

    def add(step, **new):
        return F.transform(step, lambda r: _added(r, {k: f(r) for k, f in new.items()}))

    def _added(r, cols):
        out = r
        for k, c in cols.items():
            out = out.withField(k, c)
        return out

    def high(r):
        return F.aggregate(r["x"], F.lit(0.0), lambda s, v: s + F.when(v > 0, 1.0).otherwise(0.0))

    rows = add(rows, k=lambda r: F.char_length(r["alphabet"]).cast("double"), n=lambda r: F.char_length(r["token"]).cast("double"))
    rows = add(
        rows,
        squares=lambda r: F.aggregate(
            F.transform(F.split(r["alphabet"], ""), lambda c: r["n"] - F.char_length(F.replace(r["token"], c, F.lit("")))),
            F.lit(0.0), lambda a, c: a + c * c),
        x=lambda r: F.transform(F.split(r["token"], ""), lambda c: F.instr(r["alphabet"], c).cast("double") - (r["k"] + 1) / 2))
    rows = add(
        rows, high=high,
        pairs=lambda r: F.zip_with(F.slice(r["x"], F.lit(1), F.size(r["x"]) - 1), F.slice(r["x"], F.lit(2), F.size(r["x"]) - 1),
                                   lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    rows = add(
        rows, split=lambda r: 2 * r["high"] * (r["n"] - r["high"]),
        runs=lambda r: F.aggregate(r["pairs"], F.lit(1.0), lambda s, p: s + F.when((p["a"] > 0) != (p["b"] > 0), 1.0).otherwise(0.0)),
        serial=lambda r: F.aggregate(r["pairs"], F.lit(0.0), lambda s, p: s + p["a"] * p["b"])
        / ((r["k"] * r["k"] - 1) / 12) / F.sqrt(r["n"] - 1))
    rows = add(
        rows,
        chi=lambda r: (r["k"] / r["n"] * r["squares"] - r["n"] - (r["k"] - 1)) / F.sqrt(2 * (r["k"] - 1) * (r["n"] - 1) / r["n"]),
        run=lambda r: (r["runs"] - 1 - r["split"] / r["n"]) / F.sqrt(F.greatest(
            r["split"] * (r["split"] - r["n"]) / (r["n"] * r["n"] * (r["n"] - 1)), F.lit(1e-9))))
    rows = add(rows, half=lambda r: F.aggregate(  # Fisher: minus the log of the product, 6 degrees of freedom
        F.array(r["chi"], r["run"], r["serial"]), F.lit(0.0), lambda s, z: s - F.ln(_two_sided(z))))
    return add(rows, p=lambda r: F.exp(-r["half"]) * (1 + r["half"] + r["half"] * r["half"] / 2))


def measured_tokens(text: Column) -> Column:
    """array<struct<start, kind, end, stratum, bits, p>> of the long tokens and parts: p is the battery's, bits the whole-bit evidence against ordinary text, 0 at least."""
    def encoded(m):
        alphabet = F.lit("")
        for pattern, a in reversed(ENCODINGS):
            alphabet = F.when(m["match"].rlike(pattern), F.lit(a)).otherwise(alphabet)
        return F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"), m["match"].alias("token"),
                        alphabet.alias("alphabet"), F.lit(len(ENCODINGS)).alias("tries"))

    def bare(m):
        return m.withField("match", F.regexp_replace(m["match"], "=+$", ""))

    def parts(m, pattern):
        return F.transform(matches(m["token"], pattern, 3), lambda x: encoded(F.struct(
            (m["start"] + x["start"]).alias("start"), x["kind"].alias("kind"),
            F.when(x["end"] == F.char_length(m["token"]), m["end"]).otherwise(m["start"] + x["end"]).alias("end"),
            x["match"].alias("match"))))

    def fits(m):
        return F.char_length(m["alphabet"]) > 0

    def gain(split):
        return F.array_max(F.transform(split, lambda r: token_bits(
            r["token"], F.char_length(r["token"]), F.char_length(r["alphabet"]), r["tries"])))

    def either(m):
        one, other = (F.transform(parts(m, w), lambda r: r.withField("tries", F.lit(len(ENCODINGS) * (len(WAYS) + 1)))) for w in WAYS)
        whole = F.array(m.withField("alphabet", F.lit(ALL)).withField("tries", F.lit(len(ENCODINGS) * (len(WAYS) + 1))))
        return F.when((F.size(one) == 0) & (F.size(other) == 0), whole) \
            .when((F.size(one) == 0) | (gain(other) > gain(one)), other).otherwise(one)

    def evidence(r):
        bits = token_bits(r["token"], r["n"], r["k"], r["tries"])
        stratum = F.lit(len(STRATA))
        for i, top in reversed(list(enumerate(STRATA))):
            stratum = F.when(r["n"] < top, F.lit(i)).otherwise(stratum)
        return F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end"), stratum.alias("stratum"),
                        F.least(F.greatest(F.floor(bits), F.lit(0)), F.lit(MOST_BITS)).cast("int").alias("bits"), r["p"].alias("p"))

    tokens = F.transform(F.transform(matches(text, TOKEN, 3), bare), encoded)
    tokens = F.flatten(F.transform(tokens, lambda m: F.when(fits(m), F.array(m)).otherwise(parts(m, VALUES))))
    tokens = F.flatten(F.transform(tokens, lambda m: F.when(fits(m), F.array(m)).otherwise(either(m))))
    long = F.filter(tokens, lambda r: F.char_length(r["token"]) > 2)
    kind = "struct<start:int,kind:int,end:int,stratum:int,bits:int,p:double>"
    return _where(text.rlike(TOKEN), F.transform(battery(long), evidence), kind)


def analyse(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``base`` spans and ``tokens`` with their evidence."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*keep, base_spans(text).alias("base"), measured_tokens(text).alias("tokens"))


def thresholds(analysed: DataFrame) -> dict[int, int]:
    """Bits that a token of each stratum needs: the smallest b with 2 ** -b * tokens <= FDR * tokens
    of b bits or more.  Counts per stratum and bit, 5 * 201 rows at most, reach the driver."""
    t = analysed.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.bits").agg(F.count("*").alias("n")).collect()
    out = {}
    for s in {r["stratum"] for r in t}:
        counts = {r["bits"]: r["n"] for r in t if r["stratum"] == s}
        total, above = sum(counts.values()), 0
        for b in sorted(counts, reverse=True):
            above += counts[b]
            if total * 2.0 ** -b <= FDR * above:
                out[s] = b
    return out


def all_spans(need: dict[int, int]) -> Column:
    """Base spans and the tokens that pass, from the columns of ``analyse``."""
    passed = F.lit(False)

    def ok(t):
        hit = passed
        for s, b in sorted(need.items()):
            hit = hit | ((t["stratum"] == s) & (t["bits"] >= b))
        clear = ~F.exists("base", lambda x: (x["start"] < t["end"]) & (t["start"] < x["end"]))
        return hit & (t["p"] >= RANDOM_P) & clear

    found = F.transform(F.filter("tokens", ok), lambda t: F.struct(t["start"], t["kind"], t["end"]))
    return F.array_sort(F.concat("base", found))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mask``."""
    merged = F.aggregate(spans, F.expr("array()").cast("array<struct<start:int,end:int>>"), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    ends = F.concat(F.array(F.lit(0)), F.transform(merged, lambda x: x["end"]))
    starts = F.concat(F.transform(merged, lambda x: x["start"]), F.array(F.char_length(text)))
    kept = F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a))
    return F.when(F.size(spans) > 0, F.array_join(kept, mask)).otherwise(text)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(analyse(table(spark, sf_dir, "documents"), ["doc_id"]), "secrets")

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(all_spans(thresholds(found))).alias("spans"))
