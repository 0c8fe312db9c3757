"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

The pieces come from a public model file (its path is a parameter; only the table of pieces, some
32,000 entries, is broadcast).  No piece of the model holds a word mark after another
character, so a text falls apart into units (a run of marks and the characters up to the next one)
that can be searched alone.  Different units of equal length advance together: at every end position the hashes of
all substrings up to the longest piece are probed in the sorted piece keys in one call, and one
vectorised maximum stores the back pointers.  Each unit is searched once per task and kept in a
bounded table.

The model file gives merge ranks, not probabilities; the search maximises the sum of log
probabilities under Zipf's law, log p = -log(rank + 2).  A character without a piece costs ten more
than the rarest piece and is written as its UTF-8 byte pieces.  Ties take the longest last piece.

Defined results: null and empty texts have no ids and decode to the empty text; U+2581 in a text is
taken for a space, as the format does; everything else decodes to the same text exactly; other columns
are kept where named in ``keep``; repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cached, mix64, plus, slices, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CHUNK = 1_000_000  # characters encoded at once inside a task
KEPT_UNITS = 400_000
BASE = 0x9E3779B97F4A7C15
UNKNOWN_COST = 10.0


def load_pieces(path: str = MODEL) -> list[tuple[str, float | None, int | None]]:
    """(piece, log probability or None, byte or None) by id; control pieces have neither."""
    import math

    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(m.get_piece_size()):
        p = m.id_to_piece(i)
        if m.is_byte(i):
            out.append((p, None, int(p[3:5], 16)))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            out.append(("", None, None))
        else:
            out.append((p, -math.log(2 + (-m.get_score(i) if m.get_score(i) > -1e8 else i)), None))
    return out


class Pieces:
    """Piece table with sorted keys, the unit search and the decoder."""

    def __init__(self, pieces):
        known = [(i, p, s) for i, (p, s, b) in enumerate(pieces) if s is not None]
        if any(MARK in p.lstrip(MARK) for _, p, _ in known):
            raise ValueError("a piece crosses a word mark: units can't be searched alone")
        self.longest = max(len(p) for _, p, _ in known)
        self.base = np.uint64(BASE)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, self.base)]).astype(np.uint64))
        keys = self._keys([p for _, p, _ in known])
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("piece keys collide")
        self.present = np.zeros(1 << 20, bool)  # by the first 20 bits of a key: most misses end here
        self.present[self.keys >> np.uint64(44)] = True
        self.ids = np.array([i for i, _, _ in known], np.int32)[order]
        self.scores = np.array([s for _, _, s in known])[order]
        self.unknown = min(s for _, _, s in known) - UNKNOWN_COST
        self.byte_id = {b: i for i, (_, _, b) in enumerate(pieces) if b is not None}
        self.out = [p.replace(MARK, " ").encode() if s is not None else bytes([b]) if b is not None else b""
                    for p, s, b in pieces]
        self.cache: dict[str, bytes] = {}

    def _prefix(self, codes: np.ndarray) -> np.ndarray:
        """[length + 1, n] polynomial prefix hashes of [length, n] code points."""
        h = np.zeros((codes.shape[0] + 1, codes.shape[1]), np.uint64)
        for j in range(codes.shape[0]):
            h[j + 1] = h[j] * self.base + codes[j].astype(np.uint64) + np.uint64(1)
        return h

    def _keys(self, pieces: list[str]) -> np.ndarray:
        out = np.zeros(len(pieces), np.uint64)
        size = np.array([len(p) for p in pieces])
        for k in np.unique(size):
            at = np.flatnonzero(size == k)
            codes = np.frombuffer("".join(pieces[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), k)
            out[at] = mix64(self._prefix(codes.T)[-1] + np.uint64(k))
        return out

    def search(self, units: list[str]) -> list[bytes]:
        """Best ids (little-endian int32) of units of one length, advanced together."""
        n, length = len(units), len(units[0])
        codes = np.ascontiguousarray(np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(n, length).T)
        prefix = self._prefix(codes)
        best = np.zeros((length + 1, n))
        back = np.zeros((length + 1, n), np.int32)
        token = np.zeros((length + 1, n), np.int32)
        rows = np.arange(n)
        for e in range(1, length + 1):
            low = max(0, e - self.longest)
            size = np.arange(e - low, 0, -1)  # longest first: ties take it
            key = mix64(prefix[e] - prefix[low:e] * self.power[size][:, None] + size[:, None].astype(np.uint64))
            maybe = np.flatnonzero(self.present[key >> np.uint64(44)])
            asked = key.ravel()[maybe]
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            hit = self.keys[at] == asked
            maybe, at = maybe[hit], at[hit]
            score = np.full((e - low, n), -np.inf)
            ids = np.full((e - low, n), -1, np.int32)
            score.ravel()[maybe] = self.scores[at]
            ids.ravel()[maybe] = self.ids[at]
            score[-1][ids[-1] < 0] = self.unknown
            score += best[low:e]
            pick = score.argmax(0)
            best[e] = score[pick, rows]
            back[e] = low + pick
            token[e] = ids[pick, rows]
        found = np.full((n, length), -2, np.int32)  # filled from the right
        end, slot = np.full(n, length), length
        while (end > 0).any():
            slot -= 1
            live = np.flatnonzero(end > 0)
            found[live, slot] = token[end[live], live]
            end[live] = back[end[live], live]
        used = found != -2
        ends = np.concatenate([[0], np.cumsum(used.sum(1))]) * 4
        flat = found[used].astype("<i4").tobytes()
        out = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for i in np.flatnonzero((found == -1).any(1)):
            out[i] = self._with_bytes(units[i], token[:, i], back[:, i])
        return out

    def _with_bytes(self, unit: str, token: np.ndarray, back: np.ndarray) -> bytes:
        end, parts = len(unit), []
        while end:
            start = back[end]
            parts.append([int(token[end])] if token[end] >= 0 else [self.byte_id[b] for b in unit[start:end].encode()])
            end = start
        return np.array([x for p in reversed(parts) for x in p], "<i4").tobytes()

    def learn(self, units: set[str]) -> None:
        """Search new units, those of one length together."""
        new = units.difference(self.cache)
        if len(self.cache) + len(new) > KEPT_UNITS:
            self.cache.clear()
            new = units
        by_length: dict[int, tuple[list, list]] = {}
        for u in new:
            word = u if u.startswith(MARK) else MARK + u
            names, words = by_length.setdefault(len(word), ([], []))
            names.append(u)
            words.append(word)
        for length, (names, words) in by_length.items():
            step = max(1, 200_000 // length)
            for i in range(0, len(words), step):
                self.cache.update(zip(names[i:i + step], self.search(words[i:i + step])))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [units(t) for t in texts]
        self.learn(set().union(*split))
        get = self.cache.__getitem__
        return [b"".join(map(get, u)) for u in split]

    def decode(self, ids) -> str:
        s = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return s[1:] if s.startswith(" ") else s


def units(text: str | None) -> list[str]:
    """The units of a text; the single mark that most of them start with is left out."""
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts:
        return parts
    out, marks = [], 0
    for p in parts:
        marks += 1
        if p:
            out.append(p if marks == 1 else MARK * marks + p)
            marks = 0
    if marks:
        out.append(MARK * marks)
    return out


def encode(docs: DataFrame, keep: list[str], text_col: str = "text", pieces=None, model: str = MODEL,
           decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of every row; with ``decoded`` also ``decoded``, the text
    that the ids stand for, from the same pass (one Python worker per task instead of two)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, pieces or load_pieces(model)))
    cols = docs.select(*keep, F.col(text_col).alias("__text"))
    kept = list(keep)

    def run(batches):
        p = cached(("pieces", shared.value[0]), lambda: Pieces(shared.value[1]))
        for b in batches:
            text = b.column("__text").to_pylist()
            for i, j in slices([len(t or "") for t in text], CHUNK):
                found = p.encode(text[i:j])
                ends = np.cumsum([0] + [len(x) // 4 for x in found])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
                part = b.slice(i, j - i)
                back = [pa.array([p.decode(np.frombuffer(x, "<i4").tolist()) for x in found], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [ids] + back,
                                                 names=kept + ["ids"] + ["decoded"] * decoded)
        p.cache.clear()  # the worker lives on; it should not keep this task's units

    return cols.mapInArrow(run, plus(cols.drop("__text").schema, "ids array<int>" + ", decoded string" * decoded))


def decode(encoded: DataFrame, keep: list[str], ids_col: str = "ids", pieces=None, model: str = MODEL) -> DataFrame:
    """``keep`` columns and the ``text`` that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast((model, pieces or load_pieces(model)))
    cols = encoded.select(*keep, F.col(ids_col).alias("__ids"))
    kept = list(keep)

    def run(batches):
        p = cached(("pieces", shared.value[0]), lambda: Pieces(shared.value[1]))
        for b in batches:
            ids = b.column("__ids")
            size = ids.value_lengths().fill_null(0).to_numpy()
            for i, j in slices(size.tolist(), CHUNK):
                text = [p.decode(x or ()) for x in ids.slice(i, j - i).to_pylist()]
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(text, pa.string())], names=kept + ["text"])

    return cols.mapInArrow(run, plus(cols.drop("__ids").schema, "text string"))


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids, space-joined), text_sha256 (of the decoded text) and
    exact: whether decoding gives the text back."""
    pieces = load_pieces(model)
    want = F.sha2(F.translate(F.coalesce("text", F.lit("")), MARK, " "), 256)
    enc = encode(docs.select("doc_id", "text", want.alias("want")), ["doc_id", "want"], pieces=pieces, decoded=True)
    got = F.sha2("decoded", 256)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      got.alias("text_sha256"), (got == F.col("want")).alias("exact"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
