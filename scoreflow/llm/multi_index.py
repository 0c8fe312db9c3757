"""Hard negatives from an inverted multi-index.

Vectors are cut into two halves; each half has a codebook (k-means on a hash sample of ``CODEBOOK_ROWS`` rows, the
only thing that is fitted), and a row lies in the cell of its two nearest codewords.  Every row is indexed:
rows are dealt by (cell, id) and written once, and tasks read them in pages of ``PAGE_ROWS``.

For an anchor a and half h, a . c + |a| * r bounds the half score of every row at codeword c, r being the largest
distance of the page's rows from it.  A heap walks the cells of a page by the sum of their two half bounds,
highest first (multi-sequence).  It stops once the next bound falls below the last place of every list still
wanted: such a list is certified.  Cells that lie wholly above the windows are passed over.  Scores are exact
integer inner products, so the result doesn't depend on codebooks, pages or sample.

Two passes: the first finds an anchor's positives, whose scores give the windows for the second.  Anchors go in
blocks of ``ANCHOR_BLOCK`` (by hash); only one block at a time is sent to the tasks, against all rows.  Each task
keeps its best few per list across its pages, and Spark merges the lists.

Defined results: rows with null vec_id, label or vector, or a component that is null, NaN or infinite, take no
part; repeated rows (same id, label and vector) count once; rows that share only the id are rows of their own;
shorter vectors are as if padded with zeros; a component's integer is held within +-2**26; an anchor without another
row of its label has no result; a window whose ends cross (negative positive score) is empty; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import shared_path, table, written

CODEBOOK_ROWS = 4096  # expected size of the hash sample that the codebooks are fitted on
CELL_ROWS = 64  # rows a cell should hold; sets the size of the codebooks
MOST_WORDS = 256
SHARD_ROWS = 16_384
PAGE_ROWS = 16_384
ANCHOR_BLOCK = 2048
GATHER = 1024  # rows scored at once
LIMIT = 1 << 26
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score


def prepared(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, v): the rows that take part, their components as integers."""
    sound = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector_col, lambda x: F.greatest(F.least(F.floor(256 * x.cast("double")), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    return embeddings.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                                          whole.alias("v")).distinct()


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column as a dense int64 matrix, padded with zeros."""
    flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    size = np.diff(offsets)
    if (size == dim).all():
        return flat[offsets[0]:offsets[-1]].reshape(len(size), dim).astype(np.int64)
    out = np.zeros((len(size), dim), np.int64)
    for i, (a, n) in enumerate(zip(offsets, size)):
        out[i, :n] = flat[a:a + n]
    return out


def codebook(x: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows; rows in a fixed order give a fixed codebook."""
    x = np.unique(x, axis=0).astype(np.float64)
    at = np.unique(np.linspace(0, len(x) - 1, min(words, len(x))).astype(int))
    c = x[np.random.default_rng(0).permutation(len(x))[at]]
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * (x.astype(np.float64) @ c.T)).argmin(1)


class Page:
    """Rows of an index, grouped by cell."""

    def __init__(self, ids, labels, v, c1, c2, books):
        order = np.lexsort((c2, c1))
        self.ids, self.labels, self.v, c1, c2 = ids[order], labels[order], v[order], c1[order], c2[order]
        half = books[0].shape[1]
        self.halves = []
        for c, book, x in ((c1, books[0], self.v[:, :half]), (c2, books[1], self.v[:, half:])):
            words, place = np.unique(c, return_inverse=True)
            far = np.sqrt(((x - book[words][place]) ** 2).sum(1))
            radius = np.zeros(len(words))
            np.maximum.at(radius, place, far)
            self.halves.append((book[words], radius, place))
        cell = self.halves[0][2] * len(self.halves[1][0]) + self.halves[1][2]
        cells, first = np.unique(cell, return_index=True)
        self.cells = dict(zip(cells.tolist(), zip(first.tolist(), np.append(first[1:], len(cell)).tolist())))
        big = int(np.abs(self.v).max(initial=0))
        self.floats = self.v.astype(np.float64)
        self.exact = big * big * self.v.shape[1] < 1 << 52

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact and self.exact:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.v[rows] @ anchor

    def walk(self, anchor: np.ndarray, above: float, least):
        """Yields arrays of row numbers, cells by descending bound.  ``least()`` is the score below which nothing is
        wanted any more; cells whose lowest possible score is over ``above`` are passed over."""
        half = self.halves[0][0].shape[1]
        sides = []
        for (words, radius, _), a in zip(self.halves, (anchor[:half], anchor[half:])):
            mid, reach = words @ a, radius * np.sqrt(float((a * a).sum()))
            slack = 1e-9 * (np.abs(mid) + reach) + 1e-6
            high = mid + reach + slack
            order = np.argsort(-high, kind="stable")
            sides.append((order.tolist(), high[order].tolist(), (mid - reach - slack)[order].tolist()))
        (o1, h1, l1), (o2, h2, l2) = sides
        wide = len(o2)
        heap, seen = [(-(h1[0] + h2[0]), 0, 0)], {(0, 0)}
        held, n = [], 0
        floor = least()
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < floor:
                break
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(o1) and y < wide and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(h1[x] + h2[y]), x, y))
            span = self.cells.get(o1[i] * wide + o2[j])
            if span is None or l1[i] + l2[j] > above:
                continue
            held.append(span)
            n += span[1] - span[0]
            if n >= GATHER:
                yield np.concatenate([np.arange(*s) for s in held])
                held, n, floor = [], 0, least()
        if held:
            yield np.concatenate([np.arange(*s) for s in held])


def best(scores: np.ndarray, ids: np.ndarray, k: int):
    """The first k by score, then smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= cut
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Lists:
    """Running best lists of one task: (anchor, slot) -> scores, ids."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def last(self, key, otherwise: float) -> float:
        found = self.held.get(key)
        return float(found[0][-1]) if found is not None and len(found[0]) == self.k else otherwise

    def add(self, key, scores, ids) -> None:
        old = self.held.get(key)
        if old is not None:
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        self.held[key] = best(scores, ids, self.k)


def find_positives(page: Page, anchors, lists: Lists) -> int:
    """Adds the page's rows of the anchor's label to its list; returns the number of rows scored."""
    ids, labels, vectors, exact = anchors
    seen = 0
    for a in range(len(ids)):
        for rows in page.walk(vectors[a], np.inf, lambda: lists.last((a, 0), -np.inf)):
            seen += len(rows)
            rows = rows[page.labels[rows] == labels[a]]
            same = page.ids[rows] == ids[a]
            if same.any():
                same[same] = (page.v[rows[same]] == vectors[a]).all(1)
                rows = rows[~same]
            if len(rows):
                lists.add((a, 0), page.scores(rows, vectors[a], exact), page.ids[rows])
    return seen


def find_negatives(page: Page, anchors, windows, lists: Lists) -> int:
    """``windows``: per anchor a list of (slot, low, high) of scores.  Returns the number of rows scored."""
    ids, labels, vectors, exact = anchors
    seen = 0
    for a in range(len(ids)):
        mine = [w for w in windows[a] if w[1] <= w[2]]
        if not mine:
            continue
        top = max(high for _, _, high in mine)

        def least():
            return min(max(lists.last((a, slot), low), low) for slot, low, _ in mine)

        for rows in page.walk(vectors[a], top, least):
            seen += len(rows)
            rows = rows[page.labels[rows] != labels[a]]
            s = page.scores(rows, vectors[a], exact)
            keep = (s <= top) & (s >= least())
            s, found = s[keep], page.ids[rows[keep]]
            for slot, low, high in mine:
                inside = (s <= high) & (s >= low)
                if inside.any():
                    lists.add((a, slot), s[inside], found[inside])
    return seen


def pages(batches, books, dim: int, page_rows: int = PAGE_ROWS):
    """Arrow batches of an index partition -> pages."""
    held, n = [], 0

    def made():
        parts = [np.concatenate(x) for x in zip(*held)]
        return Page(*parts, books)

    for b in batches:
        columns = [b.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "c1", "c2")]
        v = matrix(b.column("v"), dim)
        for i in range(0, len(v), page_rows):
            held.append((columns[0][i:i + page_rows], columns[1][i:i + page_rows], v[i:i + page_rows],
                         columns[2][i:i + page_rows], columns[3][i:i + page_rows]))
            n += len(held[-1][0])
            if n >= page_rows:
                yield made()
                held, n = [], 0
    if n:
        yield made()


def indexed(rows: DataFrame, codebook_rows: int = CODEBOOK_ROWS, cell_rows: int = CELL_ROWS, shard_rows: int = SHARD_ROWS):
    """Writes the index of ``rows`` (vec_id, label, v): (index with c1 and c2, codebooks, width, number of rows)."""
    rows = written(rows, "vectors")
    stat = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    n, dim = stat["n"], max(stat["dim"] or 0, 2)
    if not n:
        return None
    share = min(1.0, codebook_rows / n)
    h = F.pmod(F.xxhash64("v"), F.lit(1 << 20))
    sample = rows.where(h < F.lit(int(share * (1 << 20)) + 1)).select("v").orderBy(F.xxhash64("v"), "v").toArrow().column("v").combine_chunks()
    x = matrix(sample, dim) if len(sample) else np.zeros((1, dim), np.int64)
    words = int(min(MOST_WORDS, max(1, np.ceil((n / cell_rows) ** 0.5))))
    half = (dim + 1) // 2
    books = (codebook(x[:, :half], words), codebook(x[:, half:], words))

    def assign(batches):
        for b in batches:
            v = matrix(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest(v[:, :half], books[0]), pa.int32()),
                                              pa.array(nearest(v[:, half:], books[1]), pa.int32())], names=[*b.schema.names, "c1", "c2"])

    cells = rows.mapInArrow(assign, "vec_id long, label long, v array<int>, c1 int, c2 int")
    keys = ["c1", "c2", "vec_id", "label"]
    shards = max(1, -(-n // shard_rows))
    return written(cells.repartitionByRange(shards, *keys, F.xxhash64("v")).sortWithinPartitions(*keys), "index"), books, dim, n


EMPTY = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchor_block: int = ANCHOR_BLOCK, page_rows: int = PAGE_ROWS, **index) -> DataFrame:
    """``rows``: vec_id, label, v; ``is_anchor``: condition on them.  For each anchor and each of its first ``positives`` rows
    of the same label, the first ``negatives`` rows of other labels with low <= 100 * score / positive's score <= high."""
    spark = rows.sparkSession
    made = indexed(rows, **index)
    if made is None:
        return spark.createDataFrame([], EMPTY)
    indexed_rows, books, dim, _ = made
    anchors = indexed_rows.where(is_anchor).select("vec_id", "label", "v")
    blocks = -(-anchors.count() // anchor_block)
    if not blocks:
        return spark.createDataFrame([], EMPTY)
    folder = shared_path(spark, "anchors")
    anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks))).write.partitionBy("block").parquet(folder)
    out = shared_path(spark, "negatives")
    dealt = spark.read.schema("vec_id long, label long, v array<int>, block long").parquet(folder)
    for block in range(blocks):
        got = dealt.where(F.col("block") == block).select("vec_id", "label", "v").orderBy("vec_id", "label", "v").toArrow().combine_chunks()
        if not len(got):
            continue
        column = got.column("v").combine_chunks()
        vectors = matrix(column, dim)
        big = int(np.abs(vectors).max(initial=0))
        own = (got.column("vec_id").to_numpy(), got.column("label").to_numpy(), vectors, big * big * dim < 1 << 52)
        _block(spark, indexed_rows, books, dim, own, positives, negatives, low, high, page_rows).write.mode("append").parquet(out)
    return spark.read.schema(EMPTY).parquet(out)


def _block(spark, index, books, dim, own, positives, negatives, low, high, page_rows):
    ids = own[0]

    def lists_of(lists: Lists):
        keys = list(lists.held)
        size = [len(lists.held[k][0]) for k in keys]
        a = np.repeat(np.array([k[0] for k in keys], np.int64), size)
        slot = np.repeat(np.array([k[1] for k in keys], np.int64), size)
        score = np.concatenate([lists.held[k][0] for k in keys]) if keys else np.zeros(0, np.int64)
        found = np.concatenate([lists.held[k][1] for k in keys]) if keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(slot, pa.int64()), pa.array(score, pa.int64()),
                                           pa.array(found, pa.int64())], names=["a", "slot", "score", "vec_id"])

    def first(batches):
        lists = Lists(positives)
        for page in pages(batches, books, dim, page_rows):
            find_positives(page, own, lists)
        yield lists_of(lists)

    ddl = "a long, slot long, score long, vec_id long"
    place = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "vec_id")
    top = index.mapInArrow(first, ddl).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= positives)
    windows: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    pairs = []
    for r in top.orderBy("a", "rank").collect():  # at most one block's anchors x positives
        # ceil and floor of the window's ends
        windows[r["a"]].append((r["rank"], -(-low * r["score"] // 100), high * r["score"] // 100))
        pairs.append((r["a"], r["rank"], int(ids[r["a"]]), r["vec_id"], r["score"]))

    def second(batches):
        lists = Lists(negatives)
        for page in pages(batches, books, dim, page_rows):
            find_negatives(page, own, windows, lists)
        yield lists_of(lists)

    found = index.mapInArrow(second, ddl).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    known = F.broadcast(spark.createDataFrame(pairs, "a long, slot long, anchor_id long, positive_id long, positive_score long"))
    return found.join(known, ["a", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row of ``embeddings`` whose vec_id is divisible by 100."""
    rows = prepared(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
n AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
