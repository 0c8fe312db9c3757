"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document long, so their Jaccard similarity says little.  Items are
partitioned by size: class u holds items of u/2 < q <= u distinct shingles (u a power of two).  For
every class that has items, a document is cut into windows of 2u shingles with stride u; any u
consecutive shingles lie inside one window, so a window that holds an item at containment c has a
Jaccard similarity of c*q / (2u + (1-c)*q) at least, 0.19 at the threshold of 0.8.  With ``HASHES``
min-hashes of one row per band such a window is missed with a probability of 0.81 ** 40 = 0.0002 in
the worst case, and 0.75 ** 40 = 0.00001 when the item is there in full.

Documents are scanned once.  What the tasks hold of the items is a pair of bitmaps of fixed size;
window minima and shingles that pass them are written to the shared folder, joined with the item
sketches, and every candidate pair is verified by exact containment of the item's shingle strings in
the whole document.  Both joins are equi-joins, and no partner is capped.

Words are runs of letters and digits, lower-cased; a shingle is five words; an item of one to four
words is one shorter shingle and is looked up at that length.

Defined results: null, empty or wordless texts and items match nothing; rows that share a doc_id
count as one document (null doc_ids too, as the document null), likewise item ids; ties need no rule as all pairs are returned;
an empty table on either side gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cached, mix64, plus, slices, table, written

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 40
SKETCH_BITS = 18
SHINGLE_BITS = 22
CHUNK = 400_000
BASE = 0x9E3779B97F4A7C15


def _alnum() -> np.ndarray:
    return cached("alnum", lambda: np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64."""

    def run(b):
        p = np.full(1 << (n - 1).bit_length(), b, np.uint64)
        p[0] = 1
        return np.cumprod(p)

    return cached(("powers", (n - 1).bit_length()), lambda: (run(BASE), run(pow(BASE, -1, 1 << 64))))


class Words:
    """The words of some texts: joined lower-cased text, word spans, text of each word, word hash."""

    def __init__(self, texts: list[str | None]):
        low = [(t or "").lower() for t in texts]
        self.joined = "\n".join(low) + "\n"
        codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        word = _alnum()[codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))
        self.text = np.searchsorted(ends, self.start, side="right")
        up, down = _powers(len(codes) + 1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=total[1:])
        self.hash = mix64((total[self.end] - total[self.start]) * down[self.start])
        self.count = np.bincount(self.text, minlength=len(low))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of all runs of k words inside one text, in order."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x100000001B3) + self.hash[j:n + j]
        at = np.flatnonzero(self.text[:n] == self.text[k - 1:])
        return at, mix64(h[at])

    def string(self, first: int, k: int) -> str:
        return " ".join(self.joined[self.start[i]:self.end[i]] for i in range(first, first + k))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seed = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(BASE))
    return seed[:HASHES], seed[HASHES:] | np.uint64(1)


def _value(h: np.ndarray, j: int, fn) -> np.ndarray:
    return (((h ^ fn[0][j]) * fn[1][j]) >> np.uint64(32)).astype(np.uint32)


def size_class(q: int) -> int:
    return 1 << (q - 1).bit_length()


def item_parts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, k, cls, j, value, shingle, hash): sketch rows have j >= 0, shingle rows j = -1."""

    def run(batches):
        fn = _functions()
        for b in batches:
            ids, text = b.column("item_id"), b.column("text").to_pylist()
            rows, at = [], []
            for i, t in enumerate(text):
                w = Words([t])
                if not len(w.hash):
                    continue
                k = min(SHINGLE, len(w.hash))
                first, h = w.shingles(k)
                found = {w.string(f, k): x for f, x in zip(first, h)}
                cls = size_class(len(found))
                part = [(k, cls, -1, 0, s, int(x.astype(np.int64))) for s, x in found.items()]
                hs = np.fromiter(found.values(), np.uint64, len(found))
                part += [(k, cls, j, int(_value(hs, j, fn).min()), None, None) for j in range(HASHES)]
                rows += part
                at += [i] * len(part)
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64()))] + [pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["item_id", "k", "cls", "j", "value", "shingle", "hash"])

    cols = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    schema = plus(cols.select("item_id").schema, "k int, cls int, j int, value long, shingle string, hash long")
    return cols.mapInArrow(run, schema)


def _bitmap(values: DataFrame, by: list[str], bits: int) -> dict:
    """Per group, a bitmap of the values' low bits: 2 ** bits / 8 bytes however many values."""
    low = F.col("x").bitwiseAND(F.lit((1 << bits) - 1))
    cells = values.select(*by, F.shiftright(low, 6).alias("word"), low.bitwiseAND(F.lit(63)).cast("int").alias("at")) \
        .groupBy(*by, "word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits")).collect()
    out: dict = {}
    for r in cells:
        out.setdefault(tuple(r[c] for c in by), np.zeros(1 << (bits - 6), np.uint64))[r["word"]] = np.uint64(r["bits"] & (2**64 - 1))
    return out


def _in(bitmap: np.ndarray, x: np.ndarray, bits: int) -> np.ndarray:
    low = x & x.dtype.type((1 << bits) - 1)
    return (bitmap[low >> low.dtype.type(6)] >> (low & low.dtype.type(63)).astype(np.uint64)) & np.uint64(1) > 0


def _scan(docs: DataFrame, sketches: dict, members: dict) -> DataFrame:
    """(doc_id, cls, j, value, shingle) of one pass over the documents: window minima (j >= 0) and
    shingles (j = -1) that pass the items' bitmaps."""
    shared = docs.sparkSession.sparkContext.broadcast((sketches, members))

    def look(texts, fn, sketches, members):
        w = Words(texts)
        rows = []  # (text, cls, j, value, shingle)
        for (k,), members_k in members.items():
            at, h = w.shingles(k)
            if not len(h):
                continue
            owner = w.text[at]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.append(first, len(owner)))
            blocks = {}
            for cls in sorted({c for kk, c, _ in sketches if kk == k}):
                parts = -(-count // cls)
                begin = np.concatenate([[0], np.cumsum(parts)[:-1]])
                start = np.repeat(first, parts) + cls * (np.arange(parts.sum()) - np.repeat(begin, parts))
                blocks[cls] = start, owner[start]
            hit = np.zeros(len(texts), bool)
            for j in range(HASHES):
                v = _value(h, j, fn)
                for cls, (start, whose) in blocks.items():
                    low = np.minimum.reduceat(v, start)
                    pair = whose[1:] == whose[:-1]
                    low[:-1] = np.where(pair, np.minimum(low[:-1], low[1:]), low[:-1])
                    got = np.flatnonzero(_in(sketches[k, cls, j], low, SKETCH_BITS)) if (k, cls, j) in sketches else ()
                    if len(got):
                        key = np.unique(np.stack([whose[got], low[got]]), axis=1)
                        rows += [(int(a), cls, j, int(x), None) for a, x in key.T]
                        hit[key[0]] = True
            near = np.flatnonzero(_in(members_k, h, SHINGLE_BITS) & hit[owner])
            rows += [(a, 0, -1, 0, s) for a, s in {(int(owner[i]), w.string(at[i], k)) for i in near}]
        return rows

    def run(batches):
        fn = _functions()
        sketches, members = shared.value
        for b in batches:
            ids, text = b.column("doc_id"), b.column("text").to_pylist()
            for i, j in slices([len(t or "") for t in text], CHUNK):
                rows = look(text[i:j], fn, sketches, members)
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).take(pa.array(cols[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(cols[1:], kinds)],
                    names=["doc_id", "cls", "j", "value", "shingle"])

    schema = plus(docs.select("doc_id").schema, "cls int, j int, value long, shingle string")
    return docs.mapInArrow(run, schema)


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, matched, shingles, containment) of all pairs at or above the threshold."""
    parts = written(item_parts(items, item_id, item_text), "items")
    sketch = parts.where("j >= 0")
    exact = parts.where("j = -1").select("item_id", "shingle", "hash", "k").distinct()
    sketches = _bitmap(sketch.select("k", "cls", "j", F.col("value").alias("x")), ["k", "cls", "j"], SKETCH_BITS)
    members = _bitmap(exact.select("k", F.col("hash").alias("x")), ["k"], SHINGLE_BITS)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text"))
    found = written(_scan(d, sketches, members), "decontamination")
    candidates = found.where("j >= 0").join(sketch.select("cls", "j", "value", "item_id"), ["cls", "j", "value"]) \
        .select("doc_id", "item_id").distinct()
    sizes = exact.groupBy("item_id").agg(F.countDistinct("shingle").alias("shingles"))
    matched = found.where("j = -1").select("doc_id", "shingle").distinct() \
        .join(exact.select("item_id", "shingle").distinct(), "shingle") \
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("matched"))
    pairs = matched.alias("m").join(candidates.alias("c"), F.expr("m.doc_id <=> c.doc_id and m.item_id <=> c.item_id"), "left_semi")
    s = sizes.select(F.col("item_id").alias("_item"), "shingles")
    return pairs.join(s, F.expr("item_id <=> _item")).select(
        "doc_id", "item_id", "matched", "shingles", (F.col("matched") / F.col("shingles")).alias("containment")) \
        .where(F.col("containment") >= threshold)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark),
ish AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM i)),
isz AS (SELECT item_id, count(*) AS shingles FROM ish GROUP BY 1),
dsh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM w)),
m AS (SELECT doc_id, item_id, count(*) AS matched FROM dsh JOIN ish USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, matched, shingles, matched / shingles AS containment
FROM m JOIN isz USING (item_id) WHERE matched / shingles >= {THRESHOLD}
"""
