"""Prefix trie of conversations by a splitter skeleton.

A conversation is the sequence of its turns; a turn becomes a slot of ``SLOT`` bytes (MD5 of role and text,
then the text's length in code points), a conversation its slots side by side.  These paths are
range-partitioned by (path, conv_id), so that even equal conversations spread over many shards.

A trie node that lies in more than one shard is a prefix of both the last path of a shard and the first of the
next: the trie of these common prefixes of the splitters is the skeleton.  It is broadcast as integers, its
nodes named (shard where the node starts, depth).  Every shard is read in order with a stack of the open
nodes and finishes all other nodes by itself; of skeleton nodes it gives partial sums, which are added up by
(start, depth), and the sums over subtrees run along the skeleton only, from its deepest node up.  The skeleton
has no more nodes than the splitter paths have turns, one splitter for ``SHARD_TURNS`` turns.

The digest of the conversations that end at a skeleton node is made of pieces of ``PIECE_BYTES``: one
task streams them in order, since SHA-256 can't be computed otherwise; no list is held.

Defined results: rows without conv_id belong to no conversation; null role or text is empty; a null turn comes
first, equal turns are ordered by their MD5; repeated rows are turns of their own; a rebuilt conversation
without turns ends at the root; an empty table gives no node, not even the root; only the named columns are
read.  A conversation is a unit like a document: its slots (not its texts) lie in one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import table, written

SLOT = 20
SHARD_TURNS = 16_384
PIECE_BYTES = 65_536
BATCH_ROWS = 20_000

NODE = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string, start long, parent_start long, last_length long, part long, seq long, piece binary")
_TYPES = [pa.int32(), *[pa.int64()] * 7, pa.string(), *[pa.int64()] * 5, pa.binary()]
_NAMES = [x.split()[0] for x in NODE.split(", ")]
WHOLE, PARTIAL, PIECE = 0, 1, 2


# ---------------------------------------------------------------- conversations
def paths(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, slots): the turns of each conversation in order, every one as hexadecimal digits of its slot."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    slot = F.concat(digest, F.lpad(F.hex(F.char_length(text)), 8, "0"))
    named = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), slot.alias("slot")).alias("t"))
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).getField("slot").alias("slots"))


def spliced(own: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """Each conversation c as the first h turns of conversation c - c % ``group``, then its own after the first h,
    h = crc32(c) % (most + 1).  A base meets the conversations of its hundred only."""
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("slots", 1, most).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    both = own.select("conv_id", "slots", base.alias("_base"), h.alias("_h")).join(heads, "_base", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.array().cast("array<string>"))
    rest = F.slice("slots", F.col("_h") + 1, F.greatest(F.size("slots") - F.col("_h"), F.lit(0)))
    return both.select("conv_id", F.concat(head, rest).alias("slots"))


# ---------------------------------------------------------------- skeleton
def _common_slots(a: Column, b: Column) -> Column:
    """Number of leading slots that two paths share."""
    n = (F.least(F.octet_length(a), F.octet_length(b)) / SLOT).cast("int")
    same = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(a, i * SLOT + 1, F.lit(SLOT)) == F.substring(b, i * SLOT + 1, F.lit(SLOT)))
    first = F.array_position(same, False)
    return F.when(n == 0, F.lit(0)).when(first == 0, n).otherwise(first - 1)


def skeleton(dealt: DataFrame) -> dict[int, tuple[list[int], int, int]]:
    """Shard -> (starts of the nodes that reach into it from the left, by depth from 0; depth of the deepest node that
    goes on to the right; depth of the deepest node that holds the whole shard).  -1: none."""
    ends = dealt.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    after = Window.orderBy("part")  # one row per shard
    rows = ends.select("part", _common_slots(F.col("low"), F.col("high")).alias("inner"),
                       F.coalesce(_common_slots(F.col("high"), F.lead("low").over(after)), F.lit(-1)).alias("right")).orderBy("part").collect()
    out: dict[int, tuple[list[int], int, int]] = {}
    left, before = -1, None
    for r in rows:
        starts: list[int] = []
        if before is not None:
            prior, _, inner = out[before]
            through = min(len(prior) - 1, inner)
            starts = [prior[d] if d <= through else before for d in range(left + 1)]
        out[r["part"]] = (starts, int(r["right"]), int(r["inner"]))
        left, before = int(r["right"]), r["part"]
    return out


class _Node:
    __slots__ = ("start", "least", "n_convs", "n_children", "n_leaves", "saved", "length", "ends", "kids")

    def __init__(self, start: int | None, length: int):
        self.start, self.length = start, length
        self.least = None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.ends: list[int] = []
        self.kids: list[list] = []


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // SLOT
    if a[:n * SLOT] == b[:n * SLOT]:
        return n
    if n <= 16:
        return next(i for i in range(n) if a[i * SLOT:(i + 1) * SLOT] != b[i * SLOT:(i + 1) * SLOT])
    differs = np.frombuffer(a, np.uint8, n * SLOT) != np.frombuffer(b, np.uint8, n * SLOT)
    return int(differs.argmax()) // SLOT


class _Shard:
    """One shard, read in order: the stack holds the nodes along the last path."""

    def __init__(self, part: int, frame: tuple[list[int], int, int]):
        self.part, (self.starts, self.right, _) = part, frame
        self.stack: list[_Node] = []
        self.last: bytes | None = None
        self.rows: list[list] = []

    def add(self, path: bytes, conv: int) -> None:
        depth = len(path) // SLOT
        if self.last is None:
            self._push(self.starts[0] if self.starts else None, 0)
            shared = 0
        else:
            shared = _common(self.last, path)
            while len(self.stack) > shared + 1:
                self._pop(False)
        for d in range(shared + 1, depth + 1):
            goes_on = self.last is None and d < len(self.starts)
            if not goes_on:
                self.stack[-1].n_children += 1
            self._push(self.starts[d] if goes_on else None, int.from_bytes(path[d * SLOT - 4:d * SLOT], "big"))
        self.stack[-1].ends.append(conv)
        self.last = path

    def _push(self, start: int | None, length: int) -> None:
        self.stack.append(_Node(start, length))

    def _pop(self, at_end: bool) -> None:
        depth, node = len(self.stack) - 1, self.stack.pop()
        if node.ends:
            node.n_convs += len(node.ends)
            node.least = node.ends[0] if node.least is None else min(node.least, node.ends[0])
        if node.start is None and at_end and depth <= self.right:
            node.start = self.part
        if node.start is not None:  # of the skeleton
            self._partial(node, depth)
            return
        node.n_leaves = node.n_leaves or 1
        node.saved += (node.n_convs - 1) * node.length
        sha = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest()
        for kid in node.kids:
            kid[3] = node.least
        self.rows += node.kids
        row = [WHOLE, node.least, depth, None, node.n_convs, node.n_children, node.n_leaves, node.saved, sha,
               None, None, None, None, None, None]
        if not self.stack:
            self.rows.append(row)
            return
        up = self.stack[-1]
        up.n_convs += node.n_convs
        up.n_leaves += node.n_leaves
        up.saved += node.saved
        up.least = node.least if up.least is None else min(up.least, node.least)
        up.kids.append(row)

    def _partial(self, node: _Node, depth: int) -> None:
        for kid in node.kids:
            kid[10] = node.start
        self.rows += node.kids
        self.rows.append([PARTIAL, node.least, depth, None, node.n_convs, node.n_children, node.n_leaves, node.saved,
                          None, node.start, None, node.length, None, None, None])
        held, size, seq = [], 0, 0
        for i, x in enumerate(map(str, node.ends)):
            held.append(x)
            size += len(x) + 1
            if size >= PIECE_BYTES or i + 1 == len(node.ends):
                self.rows.append([PIECE, None, depth, None, None, None, None, None, None, node.start, None, None,
                                  self.part, seq, ",".join(held).encode()])
                held, size, seq = [], 0, seq + 1

    def close(self) -> None:
        while self.stack:
            self._pop(True)


def _batches(rows: list[list]):
    for i in range(0, len(rows), BATCH_ROWS):
        columns = zip(*rows[i:i + BATCH_ROWS])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _digests(batches):
    """Rows of pieces in order of (start, depth, part, seq) -> one digest per (start, depth)."""
    key, sha = None, None

    def done():
        return pa.record_batch({"start": pa.array([key[0]], pa.int64()), "depth": pa.array([key[1]], pa.int64()),
                                "sha": pa.array([sha.hexdigest()], pa.string())})

    for b in batches:
        for start, depth, piece in zip(b.column("start").to_pylist(), b.column("depth").to_pylist(), b.column("piece")):
            if key != (start, depth):
                if key is not None:
                    yield done()
                key, sha = (start, depth), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.as_buffer())
    if key is not None:
        yield done()


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``conversations``: conv_id (distinct), slots.  One row per node of their prefix trie."""
    spark = conversations.sparkSession
    flat = written(conversations.select("conv_id", F.unhex(F.array_join("slots", "")).alias("path")), "paths")
    turns = flat.agg(F.sum(F.octet_length("path") / SLOT + 1)).first()[0] or 0
    shards = max(1, int(-(-turns // shard_turns)))
    dealt = written(flat.repartitionByRange(shards, "path", "conv_id").withColumn("part", F.spark_partition_id().cast("long")), "shards")
    frames = skeleton(dealt)
    empty = hashlib.sha256(b"").hexdigest()
    shared = spark.sparkContext.broadcast(frames)

    def run(batches):
        shard = None
        for b in batches:
            for part, path, conv in zip(*(b.column(c).to_pylist() for c in ("part", "path", "conv_id"))):
                if shard is None or part != shard.part:
                    if shard is not None:
                        shard.close()
                        yield from _batches(shard.rows)
                    shard = _Shard(part, shared.value[part])
                shard.add(path, conv)
                if len(shard.rows) >= BATCH_ROWS:
                    yield from _batches(shard.rows)
                    shard.rows = []
        if shard is not None:
            shard.close()
            yield from _batches(shard.rows)

    ordered = dealt.repartitionByRange(shards, "part").sortWithinPartitions("part", "path", "conv_id")
    found = written(ordered.mapInArrow(run, NODE), "nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    sums = found.where(F.col("kind") == PARTIAL).groupBy("start", "depth").agg(
        F.min("conv_id").alias("least"), F.max("last_length").alias("length"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]).collect()
    finished = _finish(sums, frames)
    bones = spark.createDataFrame(finished, "start long, depth long, conv_id long, parent_conv_id long, n_convs long, "
                                            "n_children long, n_leaves long, saved_tokens long")
    digests = found.where(F.col("kind") == PIECE).select("start", "depth", "part", "seq", "piece") \
        .repartition("start", "depth").sortWithinPartitions("start", "depth", "part", "seq") \
        .mapInArrow(_digests, "start long, depth long, sha string")
    bones_out = bones.join(digests, ["start", "depth"], "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(empty)))
    tops = F.broadcast(bones.select(F.col("start").alias("parent_start"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_up")))
    whole = found.where(F.col("kind") == WHOLE).join(tops, ["parent_start", "depth"], "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_up"))
    return whole.select(*columns).unionByName(bones_out.select(*columns))


def _finish(sums, frames) -> list[tuple]:
    """Sums over subtrees of the skeleton, from the deepest nodes up."""
    node = {(r["start"], r["depth"]): r.asDict() for r in sums}

    def parent(start: int, depth: int) -> tuple[int, int]:
        starts, _, inner = frames[start]
        up = depth - 1
        return (starts[up] if up <= min(len(starts) - 1, inner) else start, up)

    for key in sorted(node, key=lambda k: -k[1]):
        x = node[key]
        x["n_leaves"] = x["n_leaves"] or int(x["n_children"] == 0)
        x["saved_tokens"] += (x["n_convs"] - 1) * x["length"]
        if key[1]:
            x["up"] = parent(*key)
            up = node[x["up"]]
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                up[c] += x[c]
            up["least"] = x["least"] if up["least"] is None else min(up["least"], x["least"])
    return [(*key, x["least"], node[x["up"]]["least"] if key[1] else None, x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"])
            for key, x in node.items()]


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt ``conversations``."""
    return trie(spliced(paths(table(spark, sf_dir, "conversations"))))


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(text, '') AS text,
         md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS slot,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda z: ord(z)::BIGINT)),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT conv_id, slot, length, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS d FROM (
    SELECT c.conv_id, slot, length(text) AS length, 0 AS own, i FROM c JOIN t ON t.conv_id = c.base AND i <= h
    UNION ALL
    SELECT c.conv_id, slot, length(text) AS length, 1 AS own, i FROM c JOIN t ON t.conv_id = c.conv_id AND i > h)),
w AS (SELECT c.conv_id, coalesce(list(slot ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS slots,
             coalesce(list(length ORDER BY d) FILTER (WHERE d IS NOT NULL), []) AS lengths
      FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d, len(slots) AS n, md5(d::VARCHAR || ':' || array_to_string(slots[1:d], ',')) AS key,
             CASE WHEN d > 0 THEN md5((d - 1)::VARCHAR || ':' || array_to_string(slots[1:d - 1], ',')) END AS up,
             coalesce(lengths[d], 0) AS length
      FROM (SELECT *, unnest(range(len(slots) + 1)) AS d FROM w)),
g AS (SELECT key, d, any_value(up) AS up, any_value(length) AS length, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends
      FROM p GROUP BY 1, 2),
k AS (SELECT up AS key, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY 1),
o AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (key)),
s AS (SELECT p.key, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.length) AS saved
      FROM o JOIN p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY 1)
SELECT o.conv_id, o.d::BIGINT AS depth, q.conv_id AS parent_conv_id, o.n_convs::BIGINT AS n_convs, o.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, o.ends AS ends_sha256
FROM o JOIN s USING (key) LEFT JOIN g q ON q.key = o.up
"""
