"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64-bit SimHashes over XXH64 hashes of word shingles.  All pairs within the radius
are found exactly: a 64-bit fingerprint is cut into four 16-bit blocks, and two fingerprints that
differ in at most two bits agree in at least two whole blocks, so they meet under one of the six
pairs of blocks.  Buckets larger than ``BUCKET`` are dealt again by two of the four bytes of the
remaining 32 bits (the same argument), after which a bucket holds 2 ** 16 distinct fingerprints at
most: memory is bounded whatever the data, and no pair is lost.

Inside the buckets the fingerprints lie in bit planes (plane b holds bit b of many fingerprints, 64
to a machine word).  Row i is compared with row i + d of its bucket for all rows at once: the XOR of
the plane and its shifted self feeds a carry-save counter (ones, twos, and a sticky "over" plane),
and a block is abandoned as soon as every lane is over the radius.  Linked rows are merged inside the
bucket and only (fingerprint, representative) edges leave the task; components of these follow
in Spark.  Exact copies share one fingerprint and are compared once.

Defined results: null or empty text and text without words has fingerprint zero, linked like any
other; a null doc_id gets a fingerprint and its group's component; the component of a group with
null ids only is null; repeated rows are returned as often as they stand in the table; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import plus, slices, table, written
from .graph import components

SHINGLE = 3
RADIUS = 2
SEED = 42
BUCKET = 2048
CHUNK = 1_000_000  # characters fingerprinted at once inside a task
BLOCK = 4096  # rows compared at once; a bucket is never cut
PAIRS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
LANES = 0x0101010101010101


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    parts = zip(*(words[i:] for i in range(k)))
    return np.fromiter((digest(join(p), SEED) for p in parts), np.uint64, len(words) - k + 1)


def majority(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is 1 if set in over half of the run.  Bits
    are counted eight at a time in the byte lanes of 64-bit words, 255 hashes to a partial sum."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    n = sizes[full]
    if not len(n):
        return out
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    parts = -(-n // 255)
    first = np.concatenate([[0], np.cumsum(parts)[:-1]])
    at = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    found = np.zeros(len(n), np.uint64)
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & np.uint64(LANES), at)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for lane in range(8):
            found |= (2 * counts[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + j)
    out[full] = found
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 mark: bool = False) -> DataFrame:
    """(doc_id, fp): the signed 64-bit view of each row's SimHash; with ``mark`` also ``mark``, a hash
    of the text that tells rows of one doc_id apart."""

    def run(batches):
        for b in batches:
            text = b.column("text").to_pylist()
            for i, j in slices([len(t or "") for t in text], CHUNK):
                h = [shingle_hashes(t, shingle) for t in text[i:j]]
                fp = majority(np.concatenate(h), np.array([len(x) for x in h]))
                yield pa.RecordBatch.from_arrays([b.column(c).slice(i, j - i) for c in kept] + [pa.array(fp.view(np.int64))],
                                                 names=kept + ["fp"])

    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *([F.xxhash64(text_col).alias("mark")] if mark else []))
    kept = [c for c in cols.columns if c != "text"]
    return cols.mapInArrow(run, plus(cols.select(*kept).schema, "fp long"))


def _planes(fp: np.ndarray) -> np.ndarray:
    """[64, words] bit planes, least significant bit first."""
    bits = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(fp) % 64
    bits = np.pad(bits, ((0, pad), (0, 0))).T
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<u8")


def _moved(planes: np.ndarray, d: int) -> np.ndarray:
    """Lane i takes the value of lane i + d."""
    w, s = divmod(d, 64)
    out = np.zeros_like(planes)
    if w < planes.shape[-1]:
        out[..., :planes.shape[-1] - w] = planes[..., w:]
    if s:
        high = np.zeros_like(out)
        high[..., :-1] = out[..., 1:]
        out = (out >> np.uint64(s)) | (high << np.uint64(64 - s))
    return out


def close_lanes(planes: np.ndarray, moved: np.ndarray, live: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Lanes of ``live`` whose two fingerprints differ in ``radius`` bits at most: differences are
    added into vertical counters; stops when no lane is left."""
    width = max(radius.bit_length(), 1)
    counter = [np.zeros_like(live) for _ in range(width)]
    over = ~live
    for start in range(0, 64, 8):
        diff = planes[start:start + 8] ^ moved[start:start + 8]
        for carry in diff:
            for k in range(width):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over = over | carry
        # a value above the radius that still fits the counter
        above, equal = np.zeros_like(live), ~np.zeros_like(live)
        for k in reversed(range(width)):
            if radius >> k & 1:
                equal = equal & counter[k]
            else:
                above = above | (equal & counter[k])
                equal = equal & ~counter[k]
        over = over | above
        if not (~over).any():
            break
    return ~over


def merged(fp: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, representative) that connect all rows of equal ``group`` (consecutive)
    within ``radius`` bits, directly or through others of the group."""
    n = len(fp)
    label = np.arange(n)
    first = np.concatenate([[True], group[1:] != group[:-1]])
    gid = np.cumsum(first) - 1
    size = np.bincount(gid)
    planes = _planes(fp)
    lanes = planes.shape[1] * 64
    for d in range(1, int(size.max(initial=1))):
        same = np.zeros(lanes, bool)
        same[:n - d] = gid[:n - d] == gid[d:]
        same[:n - d] &= label[:n - d] != label[d:]
        if not same.any():
            if not _open(label, gid, size, d):
                break
            continue
        live = np.packbits(same, bitorder="little").view("<u8")
        hit = close_lanes(planes, _moved(planes, d), live, radius)
        at = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little")[:n - d])
        if len(at):
            label = _union(label, at, at + d)
    child = np.flatnonzero(label != np.arange(n))
    return fp[child], fp[label[child]]


def _open(label: np.ndarray, gid: np.ndarray, size: np.ndarray, d: int) -> bool:
    """Whether a bucket with rows further than ``d`` apart still has more than one label."""
    low = np.full(len(size), len(label))
    high = np.zeros(len(size), int)
    np.minimum.at(low, gid, label)
    np.maximum.at(high, gid, label)
    return bool(((low != high) & (size > d + 1)).any())


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; every label is the smallest row of its set."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(u, v) edges of distinct fingerprints (column fp) that span every set within the radius."""
    if not 0 <= radius <= 2:
        raise ValueError("two of four blocks are sure to agree up to a radius of 2")

    def part(col, i, bits):
        return F.shiftrightunsigned(col, bits * i).bitwiseAND(F.lit((1 << bits) - 1))

    def pair(col, a, b, bits):
        return F.shiftleft(part(col, a, bits), bits).bitwiseOR(part(col, b, bits))

    fp = F.col("fp")
    rest = {p: [q for q in range(4) if q not in p] for p in PAIRS}
    keys = distinct.select("fp", F.explode(F.array(*[F.struct(
        F.lit(t).alias("t"), pair(fp, *p, 16).alias("key"), pair(fp, *rest[p], 16).alias("rest"))
        for t, p in enumerate(PAIRS)])).alias("x")).select("fp", "x.*")
    shared = keys.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(shared, ["t", "key"])
    once = met.where(F.col("n") <= bucket).select("fp", "t", "key", F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sub"))
    twice = met.where(F.col("n") > bucket).select("fp", "t", "key", F.explode(F.array(*[F.struct(
        F.lit(t).alias("s"), pair(F.col("rest"), *p, 8).alias("sub")) for t, p in enumerate(PAIRS)])).alias("x")) \
        .select("fp", "t", "key", "x.*")
    by = ["t", "key", "s", "sub"]
    dealt = once.unionByName(twice).select("fp", F.xxhash64(*by).alias("g")).repartition("g").sortWithinPartitions("g")

    def run(batches):
        fps, gs, n = [], [], 0

        def flush():
            f, g = np.concatenate(fps), np.concatenate(gs)
            u, v = merged(f.view(np.uint64), g, radius)
            return pa.record_batch({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

        for b in batches:
            f, g = b.column("fp").to_numpy(), b.column("g").to_numpy()
            while len(f):
                # the open bucket takes its remaining rows first, then whole buckets up to the block
                last = gs[-1][-1] if n else None
                cut = len(f)
                if n >= BLOCK:
                    ends = np.flatnonzero(g != last)
                    cut = ends[0] if len(ends) else len(f)
                    if cut == 0:
                        yield flush()
                        fps, gs, n = [], [], 0
                        continue
                else:
                    cut = min(cut, BLOCK - n)
                fps.append(f[:cut])
                gs.append(g[:cut])
                n += cut
                f, g = f[cut:], g[cut:]
        if n:
            yield flush()

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, bucket: int = BUCKET, mark: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest doc_id reachable), root (the
    smallest fingerprint reachable, the same for all of a group) and, if asked for, mark."""
    fps = written(fingerprints(docs, id_col, text_col, shingle, mark), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), radius, bucket))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(placed.select("fp", "root").join(named, "root"), "fp") \
        .select("doc_id", "fp", "component_id", "root", *(["mark"] if mark else []))


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest doc_id of every group (rows without an id last; of rows that share
    it the one whose text hashes lowest, once)."""
    found = near_duplicates(docs, shingle=shingle, radius=radius, mark=True)
    keep = written(found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("x"))
                   .select(F.col("x.doc_id").alias("_id"), F.col("x.mark").alias("_mark")), "keepers")
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    return marked.join(keep, F.expr("doc_id <=> _id and __mark = _mark"), "left_semi") \
        .dropDuplicates(["doc_id", "__mark"]).drop("__mark")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
