"""Token counts by offset-mapped attribution.

A document is encoded once, whole; tokens of a byte-level vocabulary are byte strings whose
lengths add up to the text, so a running sum maps every token to its character span.  Sections (or
fields) are character spans too, and both lists are ordered, so the interval join is a merge: a
binary search of the section bounds in the token bounds.  A token that crosses a boundary is counted
by an explicit rule:

``majority``  for the section that holds most of its bytes, the earlier one on a tie (default)
``start``     for the section where its first byte lies
``share``     for every section it touches, in proportion to its bytes

With the first two every token is counted exactly once; with ``share`` the shares of a token add up to one, so the sections of a
document always add up to the document.

Defined results: a null or empty text has one empty section with no tokens; the white space after a section
belongs to it; repeated rows are counted alike; an empty table gives an empty result; other columns are
kept where named in ``keep``.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cached, plus, slices, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
RULES = ("majority", "start", "share")
CHUNK = 1_000_000
SENTENCE_END = re.compile(rb"[.!?]+\s+|\n+")


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """The tokenizer and the byte length of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)

    def bounds(self, text: str) -> np.ndarray:
        """Byte offsets of the token ends, 0 first."""
        ids = np.array(self.encoding.encode_ordinary(text), np.int64)
        return np.concatenate([[0], np.cumsum(self.length[ids])])


def sentence_sections(data: bytes) -> np.ndarray:
    """Byte bounds of the sentences of a text: each ends after its marks and the white space that
    follows, or with its line."""
    at = np.array([m.end() for m in SENTENCE_END.finditer(data)], np.int64)
    at = at[at < len(data)]
    return np.concatenate([[0], at, [len(data)]])


def character_offsets(data: bytes, at: np.ndarray) -> np.ndarray:
    """Code points before each byte offset."""
    first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(first)])[at]


def attribute(tokens: np.ndarray, sections: np.ndarray, rule: str = "majority") -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, tokens that cross a boundary) from ordered bounds of both."""
    n = len(sections) - 1
    start, end = tokens[:-1], tokens[1:]
    if not len(start):
        return np.zeros(n), np.zeros(n, np.int64)
    first = np.searchsorted(sections, start, side="right") - 1
    last = np.searchsorted(sections, end, side="left") - 1
    first, last = np.clip(first, 0, n - 1), np.clip(last, 0, n - 1)
    count = np.bincount(first[last == first], minlength=n).astype(float)
    touched = np.zeros(n, np.int64)
    for i in np.flatnonzero(last > first + 1):  # three sections or more
        part = np.arange(first[i], last[i] + 1)
        _give(count, touched, part, np.minimum(sections[part + 1], end[i]) - np.maximum(sections[part], start[i]), rule)
    at = np.flatnonzero(last == first + 1)
    if len(at):
        a, edge = first[at], sections[first[at] + 1]
        left, right = edge - start[at], end[at] - edge
        touched += np.bincount(a, minlength=n) + np.bincount(a + 1, minlength=n)
        if rule == "share":
            count += np.bincount(a, left / (left + right), n) + np.bincount(a + 1, right / (left + right), n)
        else:
            count += np.bincount(a if rule == "start" else np.where(right > left, a + 1, a), minlength=n)
    return count, touched


def _give(count, touched, part, held, rule) -> None:
    part, held = part[held > 0], held[held > 0]
    touched[part] += 1
    if rule == "share":
        count[part] += held / held.sum()
    else:
        count[part[0 if rule == "start" else held.argmax()]] += 1


def section_tokens(docs: DataFrame, keep: list[str], text_col: str = "text", rule: str = "majority",
                   sections=sentence_sections, ranks_path: str = RANKS) -> DataFrame:
    """A row per section of every row: ``keep`` columns, section (from 0), start and end (code points),
    n_tokens and n_crossing (tokens shared with a neighbour).  ``sections`` maps the UTF-8 bytes of
    a text to ordered byte bounds from 0 to its length."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast((ranks_path, load_ranks(ranks_path)))
    cols = docs.select(*keep, F.col(text_col).alias("__text"))
    kept = list(keep)

    def run(batches):
        path, ranks = shared.value
        enc = cached(("ranks", path), lambda: Encoder(ranks))
        for b in batches:
            text = b.column("__text").to_pylist()
            for i, j in slices([len(t or "") for t in text], CHUNK):
                rows, number, at, count, crossing = [], [], [], [], []
                for k in range(i, j):
                    t = text[k] or ""
                    data = t.encode()
                    bounds = sections(data)
                    c, x = attribute(enc.bounds(t), bounds, rule)
                    rows.append(np.full(len(c), k - i))
                    number.append(np.arange(len(c)))
                    at.append(np.stack([character_offsets(data, bounds[:-1]), character_offsets(data, bounds[1:])]))
                    count.append(c)
                    crossing.append(x)
                rows, span = pa.array(np.concatenate(rows)), np.concatenate(at, axis=1)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(rows) for c in kept]
                    + [pa.array(np.concatenate(number).astype(np.int32)), pa.array(span[0].astype(np.int64)), pa.array(span[1].astype(np.int64)),
                       pa.array(np.concatenate(count)), pa.array(np.concatenate(crossing))],
                    names=kept + ["section", "start", "end", "n_tokens", "n_crossing"])

    return cols.mapInArrow(run, plus(cols.drop("__text").schema,
                                     "section int, start long, end long, n_tokens double, n_crossing long"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every sentence of ``documents``, boundary-crossing tokens to the line with most of their bytes."""
    found = section_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"])
    return found.withColumn("n_tokens", F.col("n_tokens").cast("long"))
