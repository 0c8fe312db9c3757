"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text (``FEATURES``): densities of two lexicons (a short fixed list, and one learned from labelled
texts), nearness of hits to second-person words, capitals, punctuation, and rates of obfuscation (signs or digits inside
words, letters set apart, drawn-out letters) with the hits that appear once these are undone.

The learned lexicon holds whole words and word beginnings of ``STEMS`` letters, weighted by the lower bound of their log
odds of toxic against other texts, ``LEXICON`` entries at most.  Fit: a hash sample of an expected ``TRAIN_DOCS`` labelled
texts (distinct by id and text), in ``FOLDS`` folds.  A fold's features use a lexicon counted on the other folds, and its raw
scores come from trees fitted on the other folds; isotonic regression of the labels on these raw scores is the
calibration.  The trees and the lexicon that score are those of the whole sample.  Counting runs in Spark; the driver gets
the lexicon and the sample's feature rows.

Defined results: a null text is an empty one, which has a score like any other; labels that are null count as no
label, of repeated labels of one id the largest counts; a null id is not held out and never trained on; repeated rows
score alike; without toxic and other texts to learn from every score is the labelled rate (0 without
labels); texts of any length are read whole; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cached, plus, slices, table

TRAIN_DOCS = 8000
FOLDS = 3
LEXICON = 4096
LEAST_TOXIC = 5  # toxic texts that a lexicon entry must stand in
STEMS = (4, 5)
STRONG, WEAK = 2.5, 1.0
NEAR = 5  # words
CHUNK = 1_000_000
EDGES = ".,;:|\"'()"
KNOWN = 200_000  # tokens that a task remembers
THRESHOLD = 0.3

#: Words of abuse, and words that address someone, in the corpus's languages.
ABUSE = ["idiot", "idiots", "stupid", "moron", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "fool",
         "dumm", "blöd", "trottel", "abschaum", "imbécile", "stupide", "ordure", "idiota", "estúpido", "basura", "imbécil"]
ADDRESS = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te",
           "ton", "ta", "vous", "votre", "tú", "ti", "usted", "ustedes", "vosotros"]
LEET = str.maketrans("0134578@$!|", "oieastbasil")

FEATURES = ["chars", "words", "strong_share", "strong_hits", "strong_kinds", "weak_share", "weak_hits", "mean_weight", "top_weight",
            "abuse_share", "abuse_hits", "address_share", "near_share", "near_hits", "capitals", "shouted", "exclaims", "questions",
            "signs", "sign_runs", "digits", "broken_words", "spaced_words", "drawn_words", "undone_hits", "word_length"]

LETTERS = re.compile(r"[^\W\d_]+")
BROKEN = re.compile(r"[^\W\d_]+(?:[0-9@$!*#+|.\-]+[^\W\d_]+)+")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_] ){3,}[^\W\d_](?!\w)")
DRAWN = re.compile(r"[^\W\d_]*([^\W\d_])\1\1[^\W\d_]*")
RUNS = re.compile(r"[!?]{2,}")
SIGNS = re.compile(r"[0-9@$!*#+|.\-]+")
SAME = re.compile(r"([^\W\d_])\1{2,}")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---------------------------------------------------------------- features
def _classes() -> np.ndarray:
    """Class of every code point: 1 capital, 2 other letter, 3 digit, 4 '!', 5 '?', 6 white space, 7 other sign."""
    def made():
        out = np.full(0x110000, 7, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                out[i] = 1 if c.isupper() else 2
            elif c.isdigit():
                out[i] = 3
            elif c.isspace():
                out[i] = 6
        out[ord("!")], out[ord("?")] = 4, 5
        return out
    return cached("toxicity classes", made)


def terms(text: str) -> set[str]:
    """Lexicon entries that a text could have: its words and, marked by ``*``, their beginnings."""
    out = set()
    for w in set(LETTERS.findall(text.lower())):
        if len(w) >= 3:
            out.add(w)
        for n in STEMS:
            if len(w) >= n:
                out.add(w[:n] + "*")
    return out


class Token:
    """What a token (a run without white space) adds to the counts of a text."""

    __slots__ = ("words", "strong", "weak", "weight", "top", "abuse", "address", "shouted", "runs", "broken", "drawn", "undone")

    def __init__(self, token: str, lexicon: "Lexicon"):
        low = token.lower()
        found = LETTERS.findall(low)
        weights = [lexicon.weight(w) for w in found]
        self.words = len(found)
        self.strong = [w for w, x in zip(found, weights) if x >= STRONG]
        self.weak = sum(WEAK <= x < STRONG for x in weights)
        self.weight, self.top = sum(weights), max(weights, default=0.0)
        self.abuse, self.address = [w for w in found if w in ABUSE_SET], sum(w in ADDRESS_SET for w in found)
        self.shouted, self.runs = sum(w.isupper() and len(w) >= 3 for w in LETTERS.findall(token)), len(RUNS.findall(token))
        broken, drawn = [m.group() for m in BROKEN.finditer(low)], [m.group() for m in DRAWN.finditer(low)]
        self.broken, self.drawn = len(broken), len(drawn)
        hit = lexicon.hit
        self.undone = sum(any(map(hit, {SIGNS.sub("", w.translate(LEET)), SIGNS.sub("", w)})) for w in broken)
        self.undone += sum(hit(SAME.sub(r"\1", w)) or hit(SAME.sub(r"\1\1", w)) for w in drawn)

    def plain(self) -> bool:
        return not (self.strong or self.weak or self.weight or self.abuse or self.address or self.shouted or self.runs or self.broken or self.drawn)


class Lexicon:
    """Weights of words, and what is known of the tokens met so far (``KNOWN`` at most): a plain one's number of words."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.tokens = weights, {}

    def weight(self, word: str) -> float:
        """The largest weight among the word and its beginnings; 0 for a word of none."""
        get = self.weights.get
        return max(get(word, 0.0), *(get(word[:n] + "*", 0.0) for n in STEMS))

    def hit(self, word: str) -> bool:
        return word in ABUSE_SET or self.weight(word) >= STRONG

    def token(self, token: str, drawn: bool) -> "Token | int":
        """``drawn``: whether the text has a letter three times over at all."""
        core = token.strip(EDGES)
        if core.isalpha() and not drawn and "!!" not in token and "?" not in token:  # most: one word, nothing odd
            low = core.lower()
            get = self.weights.get
            if not (get(low) or get(low[:4] + "*") or get(low[:5] + "*") or low in ABUSE_SET or low in ADDRESS_SET
                    or (core.isupper() and len(core) >= 3) or not LETTERS.fullmatch(low)):
                if len(token) <= 32 and len(self.tokens) < KNOWN:
                    self.tokens[token] = 1
                return 1
        t = Token(token, self)
        known = t.words if t.plain() else t
        if len(token) <= 32 and len(self.tokens) < KNOWN:
            self.tokens[token] = known
        return known


ABUSE_SET, ADDRESS_SET = frozenset(ABUSE), frozenset(ADDRESS)


def _near(text: str, hot: set[str]) -> int:
    """Hits that stand at most NEAR words from one that addresses someone."""
    words = LETTERS.findall(text.lower())
    at = np.array([k for k, w in enumerate(words) if w in ADDRESS_SET])
    mine = np.array([k for k, w in enumerate(words) if w in hot])
    if not len(at) or not len(mine):
        return 0
    place = np.searchsorted(at, mine)
    gap = np.minimum(np.abs(mine - at[np.minimum(place, len(at) - 1)]), np.abs(mine - at[np.maximum(place - 1, 0)]))
    return int((gap <= NEAR).sum())


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    counts, drawn_out = np.zeros((len(texts), 8)), np.zeros(len(texts), bool)
    for a, b in slices([len(t) for t in texts], CHUNK):
        codes = np.frombuffer("".join(texts[a:b]).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(b - a), [len(t) for t in texts[a:b]])
        kind = _classes()[codes]
        counts[a:b] = np.bincount(owner * 8 + kind, minlength=(b - a) * 8).reshape(b - a, 8)
        # lower-casing may join letters of two cases
        thrice = (kind[2:] <= 2) & (codes[2:] | 32 == codes[1:-1] | 32) & (codes[1:-1] | 32 == codes[:-2] | 32)
        drawn_out[a + np.unique(owner[2:][thrice])] = True
    for i, text in enumerate(texts):
        words = single = n_strong = n_weak = n_abuse = n_address = shouted = runs = broken = drawn = undone = 0
        weight = top = 0.0
        kinds, hot = set(), set()
        get, find = lexicon.tokens.get, lexicon.token
        for token, n in Counter(text.split()).items():
            t = get(token)
            if t is None:
                t = find(token, drawn_out[i])
            if len(token) == 1:
                single += n
            if type(t) is int:
                words += t * n
                continue
            words += t.words * n
            n_strong += len(t.strong) * n
            n_weak += t.weak * n
            weight += t.weight * n
            top = max(top, t.top)
            n_abuse += len(t.abuse) * n
            n_address += t.address * n
            shouted += t.shouted * n
            runs += t.runs * n
            broken += t.broken * n
            drawn += t.drawn * n
            undone += t.undone * n
            kinds.update(t.strong)
            hot.update(t.abuse)
        near = _near(text, kinds | hot) if n_address and (kinds or hot) else 0
        spaced = SPACED.findall(text.lower()) if single >= 4 else []
        undone += sum(lexicon.hit("".join(LETTERS.findall(w))) for w in spaced)
        n, n_chars, c = max(words, 1), max(len(text), 1), counts[i]
        out[i] = (np.log1p(len(text)), np.log1p(words), n_strong / n, np.log1p(n_strong), np.log1p(len(kinds)), n_weak / n, np.log1p(n_weak),
                  weight / n, top, n_abuse / n, np.log1p(n_abuse), n_address / n, near / n, np.log1p(near), c[1] / max(c[1] + c[2], 1),
                  shouted / n, c[4] / n_chars, c[5] / n_chars, c[7] / n_chars, runs / n, c[3] / n_chars, broken / n, len(spaced) / n,
                  drawn / n, np.log1p(undone), (c[1] + c[2]) / n)
    return out


# ---------------------------------------------------------------- boosted trees
class Trees:
    """Newton boosting of log loss with trees of a fixed depth over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        cuts = [np.unique(np.quantile(x[:, j], np.arange(1, self.bins) / self.bins)) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        p = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(len(y), self.base)
        inner, width = (1 << self.depth) - 1, self.bins + 1
        self.feature = np.zeros((self.rounds, inner), int)
        self.cut = np.full((self.rounds, inner), np.inf)
        self.leaf = np.zeros((self.rounds, inner + 1))
        for t in range(self.rounds):
            q = 1 / (1 + np.exp(-f))
            g, h = q - y, q * (1 - q)
            node = np.zeros(len(y), int)
            for level in range(self.depth):
                first, n = (1 << level) - 1, 1 << level
                local = node - first
                best = np.full(n, 1e-9)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    at = local * width + binned[:, j]
                    gl = np.bincount(at, g, n * width).reshape(n, width).cumsum(1)
                    hl = np.bincount(at, h, n * width).reshape(n, width).cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl ** 2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt ** 2 / (ht + self.l2)
                    gain = gain[:, :len(c)]
                    k = gain.argmax(1)
                    better = gain[np.arange(n), k] > best
                    best = np.where(better, gain[np.arange(n), k], best)
                    at = first + np.flatnonzero(better)
                    self.feature[t, at], self.cut[t, at] = j, c[k[better]]
                node = 2 * node + 1 + (x[np.arange(len(y)), self.feature[t, node]] > self.cut[t, node])
            local = node - inner
            value = -np.bincount(local, g, inner + 1) / (np.bincount(local, h, inner + 1) + self.l2)
            self.leaf[t] = self.rate * value
            f += self.leaf[t, local]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(self.rounds):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            f += self.leaf[t, node - len(self.feature[t])]
        return f


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares fit of y that doesn't fall with x, by pooling neighbours that violate it: (places, values);
    equal x are one place."""
    places, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    mean = np.bincount(inverse, y) / n
    blocks: list[list[float]] = []  # total, weight, places
    for m, w in zip(mean, n):
        blocks.append([m * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, weight, k = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += weight
            blocks[-1][2] += k
    values = np.repeat([b[0] / b[1] for b in blocks], [int(b[2]) for b in blocks])
    return places, values


# ---------------------------------------------------------------- fit
class Model:
    """Calibrated score in [0, 1]; a thousandth of it is the raw probability, so that texts on one step of the
    calibration keep their order."""

    def __init__(self, weights: dict[str, float], trees: Trees | None, places, values, rate: float):
        self.weights, self.trees, self.places, self.values, self.rate = weights, trees, places, values, rate

    def scores(self, texts: list[str], lexicon: Lexicon) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.rate)
        raw = self.trees.raw(features(texts, lexicon))
        return 0.999 * np.interp(raw, self.places, self.values) + 0.001 / (1 + np.exp(-raw))


def sample_of(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text, toxic, fold of an expected ``train_docs`` distinct labelled texts."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = min(1.0, train_docs / max(ids.count(), 1))
    ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    # broadcast: bounded by train_docs in expectation
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id") \
        .withColumn("h", F.xxhash64("doc_id", "text"))
    # one id may have many texts
    share = min(1.0, train_docs / max(found.select("doc_id", "h").distinct().count(), 1))
    found = found.where(F.pmod("h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).dropDuplicates(["doc_id", "h"])
    return found.select("doc_id", "text", "toxic", F.pmod(F.xxhash64("h"), F.lit(FOLDS)).cast("int").alias("fold"))


def _weight(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Lower bound of the log odds of an entry that stands in a toxic and b other texts."""
    return np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1)) - 1.645 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """FOLDS + 1 lexicons: without each fold, and of the whole sample."""
    def count(batches):
        for b in batches:
            held = {}
            for text, toxic, fold in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                held.setdefault((fold, toxic), Counter()).update(terms(text))
            for (fold, toxic), found in held.items():
                yield pa.record_batch({"term": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64()),
                                       "fold": pa.array([fold] * len(found), pa.int32()), "toxic": pa.array([toxic] * len(found), pa.int32())})

    size = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    cells = [(f, t) for f in range(FOLDS) for t in (0, 1)]
    found = sample.mapInArrow(count, "term string, n long, fold int, toxic int").groupBy("term").agg(
        *[F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{f}{t}") for f, t in cells])
    total = [sum(F.col(f"n{f}{t}") for f in range(FOLDS)) for t in (0, 1)]
    n = [float(sum(size.get((f, t), 0) for f in range(FOLDS))) for t in (0, 1)]
    odds = F.log((total[1] + 0.5) / (n[1] + 1)) - F.log((total[0] + 0.5) / (n[0] + 1)) - 1.645 * F.sqrt(1 / (total[1] + 0.5) + 1 / (total[0] + 0.5))
    rows = found.where(total[1] >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= WEAK) \
        .orderBy(F.desc("odds"), "term").limit(LEXICON).collect()
    words = [r["term"] for r in rows]
    table_ = np.array([[[r[f"n{f}{t}"] for t in (0, 1)] for f in range(FOLDS)] for r in rows], float).reshape(len(rows), FOLDS, 2)
    out = []
    for left in [*range(FOLDS), None]:
        use = [f for f in range(FOLDS) if f != left]
        a, b = table_[:, use, 1].sum(1), table_[:, use, 0].sum(1)
        w = _weight(a, b, sum(size.get((f, 1), 0) for f in use), sum(size.get((f, 0), 0) for f in use))
        out.append({t: float(x) for t, x, k in zip(words, w, a) if x >= WEAK and k >= LEAST_TOXIC - 2})
    return out


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    sample = sample_of(docs, labels, train_docs).persist()
    try:
        size = sample.groupBy("toxic").count().collect()
        n = {r["toxic"]: r["count"] for r in size}
        rate = n.get(1, 0) / max(sum(n.values()), 1)
        if not n.get(0) or not n.get(1):
            return Model({}, None, None, None, rate)
        learned = lexicons(sample)

        def rows(batches):
            known = [Lexicon(w) for w in learned]
            for b in batches:
                texts, folds = b.column("text").to_pylist(), b.column("fold").to_pylist()
                x = np.zeros((len(texts), len(FEATURES)))
                for f in set(folds):
                    at = [i for i, k in enumerate(folds) if k == f]
                    x[at] = features([texts[i] for i in at], known[f])
                yield pa.record_batch({"doc_id": b.column("doc_id"), "toxic": b.column("toxic"), "fold": b.column("fold"),
                                       "x": pa.array(list(x), pa.list_(pa.float64()))})

        got = sample.mapInArrow(rows, "doc_id long, toxic int, fold int, x array<double>").orderBy("doc_id", "x").toArrow()
    finally:
        sample.unpersist()
    x, y, fold = np.stack(got.column("x").to_numpy()), got.column("toxic").to_numpy().astype(float), got.column("fold").to_numpy()
    raw = np.zeros(len(y))
    for f in set(fold.tolist()):
        rest = fold != f
        raw[fold == f] = Trees().fit(x[rest], y[rest]).raw(x[fold == f]) if rest.any() else 0.0
    return Model(learned[-1], Trees().fit(x, y), *isotonic(raw, y), rate)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and score (double), predicted (int); a kept column may not bear these names."""
    if clash := {"score", "predicted"} & {c.lower() for c in keep}:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))

    def run(batches):
        lexicon = Lexicon(model.weights)
        for b in batches:
            s = model.scores(b.column("__text").to_pylist(), lexicon)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    return rows.mapInArrow(run, plus(rows.select(*keep).schema, "score double, predicted int"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
