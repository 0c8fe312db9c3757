"""Language identification with bit-sliced Bloom filters of character n-grams.

All languages share one Bloom filter layout; row ``r`` holds one bit per language, so AND-ing the
rows of an n-gram's probes returns the bitmask of *all* languages that contain it.  A text is judged
by per-language popcounts over its n-grams, corrected for each language's false-positive rate
(fill ** probes): (count - n * fp) / (1 - fp).

Training takes ``TRAIN_DOCS`` documents per language (expected size of a hash sample; a language with
fewer gives all of them), counts n-grams with Spark and keeps, per n-gram, the languages where its
relative frequency is at least ``KEEP_SHARE`` of the best language's.  The filter has a fixed number
of rows, so what reaches the driver and the executors is ``ROWS`` * 8 bytes per 64 languages.

Defined results: null text or text without a letter -> ``und`` with score 0; a text whose letters
give no known n-gram, and any tie -> the language with the most training documents, then the smallest
name; no training data -> ``und``; null ids count as not held out and are never trained on; repeated
rows are judged alike; empty tables give empty results; only named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import cached, mix64, plus, slices, table

NGRAM = 4
PROBES = 3
ROWS = 1 << 20
TRAIN_DOCS = 1500
KEEP_SHARE = 0.25
MIN_COUNT = 2
CHUNK = 400_000  # characters handled at once inside a task
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    return cached("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def grams(texts: list[str | None], n: int = NGRAM):
    """(hash of each n-gram, index of its text, whether each text has a letter).  Letters are
    lower-cased, every other character is a space; n-grams lie inside one word, with at most one
    space at either end; words shorter than that give their padded form."""
    low = [(t or "").lower() for t in texts]
    # the spaces around each text let its first and last word have padded n-grams
    codes = np.frombuffer(("  " + "  ".join(low) + "  ").encode("utf-32-le"), np.uint32)
    size = np.fromiter((len(t) + 2 for t in low), np.int64, len(low))
    owner = np.repeat(np.arange(len(low)), size)
    owner = np.concatenate([owner, np.full(2, len(low) - 1)])
    letter = _letters()[codes]
    has = np.bincount(owner[letter], minlength=len(low)) > 0
    c = np.where(letter, codes, 32).astype(np.uint64)
    out, own = [], []
    m = len(c) - n + 1
    inner = np.ones(m, bool)
    for j in range(1, n - 1):
        inner &= letter[j:m + j]
    at = np.flatnonzero(inner & (letter[:m] | letter[n - 1:]))
    out.append(_hash(c, at, n))
    own.append(owner[at + 1])
    for k in range(3, n):  # short words: space, k - 2 letters, space
        m = len(c) - k + 1
        word = ~letter[:m] & ~letter[k - 1:]
        for j in range(1, k - 1):
            word &= letter[j:m + j]
        at = np.flatnonzero(word)
        out.append(_hash(c, at, k))
        own.append(owner[at + 1])
    return np.concatenate(out), np.concatenate(own), has


def _hash(c: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    h = np.full(len(at), n, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x100000001B3) + c[at + j]
    return mix64(h)


def probes(h: np.ndarray, rows: int = ROWS, k: int = PROBES) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(j) * step) % np.uint64(rows)).astype(np.int64) for j in range(k)]


class Model:
    """Languages in order of training size, and the bit-sliced filter: words[w][row]."""

    def __init__(self, langs: list[str], words: np.ndarray, k: int = PROBES):
        self.langs, self.words, self.k = langs, words, k
        fill = [((words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
        self.fp = np.array(fill, float) ** k

    def masks(self, h: np.ndarray) -> list[np.ndarray]:
        """Per word of languages, the bitmask of all languages that contain each n-gram."""
        at = probes(h, self.words.shape[1], self.k)
        out = []
        for w in self.words:
            m = w[at[0]]
            for a in at[1:]:
                m = m & w[a]
            out.append(m)
        return out

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """(language, score, n-grams looked up) of each text."""
        h, own, has = grams(texts)
        total = np.bincount(own, minlength=len(texts)).astype(float)
        masks = self.masks(h)
        corrected = np.zeros((len(self.langs), len(texts)))
        for i in range(len(self.langs)):
            bit = (masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            c = np.bincount(own, bit, minlength=len(texts))
            corrected[i] = np.maximum(0.0, (c - total * self.fp[i]) / max(1 - self.fp[i], 1e-9))
        best = corrected.argmax(0)
        score = np.clip(corrected.max(0) / np.maximum(total, 1), 0, 1)
        return [(self.langs[b], float(s), int(n)) if ok else (UNDETERMINED, 0.0, 0)
                for b, s, n, ok in zip(best, score, total, has)]


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, rows: int = ROWS) -> Model | None:
    """``docs``: (doc_id, text, lang) allowed for training."""
    docs = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes, key=lambda x: (-sizes[x], x))
    share = F.create_map(*[F.lit(v) for x in langs for v in (x, float(train_docs) / sizes[x])])
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.where(at < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), object)
            text = b.column("text").to_pylist()
            for i, j in slices([len(t) for t in text], CHUNK):
                h, own, _ = grams(text[i:j])
                which = lang[i:j][own]
                for x in set(lang[i:j]):
                    g, c = np.unique(h[which == x], return_counts=True)
                    yield pa.record_batch({"lang": pa.array([x] * len(g), pa.string()),
                                           "gram": pa.array(g.view(np.int64)), "c": pa.array(c.astype(np.int64))})

    counts = sample.mapInArrow(count, "lang string, gram long, c long") \
        .groupBy("gram", "lang").agg(F.sum("c").alias("c"))
    totals = Window.partitionBy("gram")
    per_lang = sample.mapInArrow(_gram_totals, "lang string, c long").groupBy("lang").agg(F.sum("c").alias("c")).collect()
    weight = F.create_map(*[F.lit(v) for r in per_lang for v in (r["lang"], 1.0 / max(r["c"], 1))])
    index = F.create_map(*[F.lit(v) for i, x in enumerate(langs) for v in (x, i)])
    kept = counts.withColumn("f", F.col("c") * weight[F.col("lang")]) \
        .withColumn("top", F.max("f").over(totals)) \
        .where((F.col("f") >= KEEP_SHARE * F.col("top")) & (F.col("c") >= MIN_COUNT)) \
        .select("gram", index[F.col("lang")].alias("i"))

    def place(batches):
        for b in batches:
            h = b.column("gram").to_numpy().view(np.uint64)
            i = b.column("i").to_numpy().astype(np.int64)
            for p in probes(h, rows):
                yield pa.record_batch({"w": pa.array((i // 64).astype(np.int32)), "pos": pa.array(p),
                                       "bits": pa.array((np.uint64(1) << (i % 64).astype(np.uint64)).view(np.int64))})

    cells = kept.mapInArrow(place, "w int, pos long, bits long") \
        .groupBy("w", "pos").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(((len(langs) + 63) // 64, rows), np.uint64)
    words[cells.column("w").to_numpy(), cells.column("pos").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return Model(langs, words)


def _gram_totals(batches):
    for b in batches:
        lang, text = b.column("lang").to_pylist(), b.column("text").to_pylist()
        for i, j in slices([len(t) for t in text], CHUNK):
            _, own, _ = grams(text[i:j])
            n = np.bincount(own, minlength=j - i)
            yield pa.record_batch({"lang": pa.array(lang[i:j], pa.string()), "c": pa.array(n.astype(np.int64))})


def identify(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score and n_grams for every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model and (model.langs, model.words, model.k))
    cols = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = plus(cols.drop("__text").schema, "lang_pred string, score double, n_grams long")
    kept = list(keep)

    def judge(batches):
        m = Model(*shared.value) if shared.value else None
        for b in batches:
            text = b.column("__text").to_pylist()
            for i, j in slices([len(t or "") for t in text], CHUNK):
                found = m.judge(text[i:j]) if m else [(UNDETERMINED, 0.0, 0)] * (j - i)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array([x[0] for x in found], pa.string()),
                                                      pa.array([x[1] for x in found], pa.float64()),
                                                      pa.array([x[2] for x in found], pa.int64())],
                    names=kept + ["lang_pred", "score", "n_grams"])

    return cols.mapInArrow(judge, schema)


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id").alias("held_out"))
    model = train(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return identify(docs, model, ["doc_id", "held_out"])
