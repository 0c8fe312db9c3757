"""Personal data: base rules, and a character-level bidirectional LSTM with CRF transitions.

The tagger (``bilstm_crf``) is trained in numpy from labelled spans: those that the rules' shapes find
in a hash sample of documents, in ``TRAIN_WINDOWS`` windows at most, each also in ``RESPELLINGS`` altered copies
(other digits and separators, no leading plus, spaces about the at sign) so that it learns more than the rules.

Texts are read in windows of ``WINDOW`` characters every ``STRIDE``.  A span must hold a digit or an at sign,
so a window with neither can't hold one and isn't run.  Every window is decoded by Viterbi; then each
document is reconciled globally: pieces of one kind that two windows cut apart are joined, and of
overlapping spans the set with the largest total score stays (weighted interval scheduling over the document).  A span
that remains must pass its kind's check (digits, Luhn, octets) and touch no base span.

Defined results: null and empty texts have no spans; positions are code points, end exclusive; spans are
listed by kind, then start; texts of any length are read whole; ``keep`` may not name an output; repeated rows are tagged alike; with no labelled span to learn from only
the base rules speak; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bilstm_crf import BiLstmCrf
from .common import plus, slices, table

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 96, 48
TRAIN_DOCS = 3000  # expected size of the hash sample that is searched for labelled spans
TRAIN_WINDOWS = 4000
RESPELLINGS = 6  # altered copies of a labelled window
CHUNK = 2_000_000
RUN_WINDOWS = 4096
LEAST_SCORE = 0.8  # mean probability of the tags of a span that the method adds

HOT = re.compile(r"[0-9@]")
MAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping matches of local@domain, walked once."""
    for m in MAIL_RUN.finditer(text):
        run, free, at = m.group(), 0, -1
        while (p := run.find("@", at + 1)) >= 0:
            start, at = max(free, at + 1), p
            if start < p and (d := DOMAIN.match(run, p + 1)):
                yield m.start() + start, m.start() + d.end()
                free = d.end()
                at = max(at, free - 1)


def shapes(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether the check holds) of all matches of the base rules."""
    if not HOT.search(text):
        return []
    out = [(0, a, b, True) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        out.append((1, m.start(), m.end(), all(int(x) <= 255 if len(x) < 9 else False for x in _parts(m.group()))))
    for m in CARD.finditer(text):
        d = NOT_DIGIT.sub("", m.group())
        out.append((2, m.start(), m.end(), 16 <= len(d) <= 19 and luhn(d)))
    for m in PHONE.finditer(text) if "+" in text else ():
        out.append((3, m.start(), m.end(), 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15))
    return out


def _parts(ip: str) -> list[str]:
    return [x.lstrip("0") or "0" for x in ip.split(".")]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    return sorted((k, a, b) for k, a, b, ok in shapes(text) if ok)


def plausible(kind: int, s: str) -> bool:
    """The check of a span that the method adds."""
    digits = NOT_DIGIT.sub("", s)
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s*@\s*[A-Za-z0-9-]+(\s*\.\s*[A-Za-z0-9-]+)+", s))
    if kind == 1:
        parts = re.split(r"[^0-9]+", s)
        return len(parts) == 4 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(digits) < len(s)


# ---------------------------------------------------------------- windows
def characters(text: str) -> np.ndarray:
    """Ids: 0 padding, 1 letters and 2 other signs beyond ASCII, 3 + code for ASCII."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    far = np.flatnonzero(codes > 127)
    out = np.where(codes > 127, 2, codes + 3).astype(np.int16)
    for i in far:
        if text[i].isalpha():
            out[i] = 1
    return out


VOCABULARY = 131


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign."""
    found = set()
    for m in HOT.finditer(text):
        k = m.start() // STRIDE
        found.add(k * STRIDE)
        found.add(max(0, k - 1) * STRIDE)
    return sorted(found)


def window_ids(text: str, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int16)
    c = characters(text[start:start + WINDOW])
    out[:len(c)] = c
    return out


def tag_spans(tags: np.ndarray, chance: np.ndarray):
    """(kind, start, end, score) of B I* runs; tag 0 is outside, 1 + 2k begins kind k, 2 + 2k goes on."""
    t, n = 0, len(tags)
    while t < n:
        if tags[t] and (tags[t] % 2 or t == 0):  # a window may begin inside a span
            k, a = (int(tags[t]) - 1) // 2, t
            t += 1
            while t < n and tags[t] == 2 + 2 * k:
                t += 1
            yield k, a, t, float(chance[a:t].mean())
        else:
            t += 1


def reconcile(spans: list[tuple[int, int, int, float, bool, bool]]) -> list[tuple[int, int, int, float]]:
    """One document's spans (kind, start, end, score, cut at the left / right edge of its window) made
    one set: cut pieces grow together with what they overlap or meet, then the set of disjoint spans with the
    largest sum of score times length is chosen."""
    joined: list[list] = []
    for k, a, b, s, left, right in sorted(spans, key=lambda x: (x[0], x[1], x[2])):
        last = joined[-1] if joined else None
        if last and last[0] == k and a <= last[2] and (left or last[5] or (a, b) == (last[1], last[2])):
            last[3], last[5] = max(last[3], s), right if b >= last[2] else last[5]
            last[2] = max(last[2], b)
        else:
            joined.append([k, a, b, s, left, right])
    items = sorted({(b, a, k, s) for k, a, b, s, _, _ in joined})
    ends = [x[0] for x in items]
    best, pick = [0.0], []
    for i, (b, a, _, s) in enumerate(items):
        j = bisect.bisect_right(ends, a, 0, i)
        take = best[j] + s * (b - a)
        pick.append((take > best[i], j))
        best.append(max(best[i], take))
    out, i = [], len(items)
    while i:
        took, j = pick[i - 1]
        if took:
            b, a, k, s = items[i - 1]
            out.append((k, a, b, s))
        i = j if took else i - 1
    return out[::-1]


def added_spans(texts: list[str], base: list[list], model: BiLstmCrf | None) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger adds to the base spans of each text."""
    out: list[list] = [[] for _ in texts]
    if model is None:
        return out
    todo = [(i, s) for i, t in enumerate(texts) for s in (window_starts(t) if t else ())]
    spans: dict[int, list] = {}
    for at in range(0, len(todo), RUN_WINDOWS):
        part = todo[at:at + RUN_WINDOWS]
        ids, which = np.unique(np.stack([window_ids(texts[i], s) for i, s in part]), axis=0, return_inverse=True)
        tags, chance = model.decode(ids)
        live = tags.any(1)
        for (i, s), w in zip(part, which.ravel()):
            if live[w]:
                stop = min(WINDOW, len(texts[i]) - s)
                spans.setdefault(i, []).extend(
                    (k, s + a, s + min(b, stop), score, a == 0 and s > 0, b >= WINDOW and s + WINDOW < len(texts[i]))
                    for k, a, b, score in tag_spans(tags[w], chance[w]) if a < stop)
    for i, found in spans.items():
        taken = sorted((a, b) for _, a, b in base[i])
        starts = [a for a, _ in taken]
        reach = list(itertools.accumulate((b for _, b in taken), max))  # furthest end so far
        for k, a, b, score in reconcile(found):
            piece = texts[i][a:b]
            lead = len(piece) - len(piece.lstrip(" .,;:"))
            a, b = a + lead, a + len(piece.rstrip(" .,;:("))
            j = bisect.bisect_left(starts, b)
            free = not j or reach[j - 1] <= a
            if free and score >= LEAST_SCORE and a < b and plausible(k, texts[i][a:b]):
                out[i].append((k, a, b))
    return out


# ---------------------------------------------------------------- training
def labelled_window(text: str, start: int, spans) -> tuple[str, str]:
    """A window's text and its tags, one digit each."""
    piece = text[start:start + WINDOW]
    tags = [0] * len(piece)
    for k, a, b in spans:
        for p in range(max(a, start), min(b, start + len(piece))):
            tags[p - start] = 1 + 2 * k if p == a else 2 + 2 * k
    return piece, "".join(map(str, tags))


def respelt(kind: int, s: str, words: list[str], draw: np.random.Generator) -> str:
    """Another spelling of a labelled span, with other digits."""
    def fresh(n: int) -> str:
        return "".join(draw.choice(list("0123456789"), n))

    if kind == 0:
        # names and hosts from the words about it, so that the spelling is learned and not the names
        local = str(draw.choice(words)).lower() + fresh(draw.integers(0, 3)) if draw.random() < 0.8 else s.rpartition("@")[0]
        domain = str(draw.choice(words)).lower() + draw.choice([".com", ".org", ".net", ".de", ".io"]) if draw.random() < 0.8 else s.rpartition("@")[2]
        return draw.choice([f"{local} @ {domain}", f"{local} @ {domain.replace('.', ' . ')}", f"{local} @ {domain.replace('.', ' . ')}",
                            f"{local}@ {domain}", f"{local} @{domain}"])
    if kind == 1:
        parts = [str(draw.integers(0, 256)) for _ in range(4)]
        return draw.choice([" . ", ". ", " ."]).join(parts)
    if kind == 2:
        d = fresh(16)
        return draw.choice([".", "_", "/", " - "]).join(d[i:i + 4] for i in range(0, len(d), 4))
    a, b, c = fresh(3), fresh(3), fresh(4)
    return draw.choice([f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"{a}.{b}.{c}", f"00{fresh(2)} {a} {b}{c}", f"{a} {b} {c}",
                        f"1 ({a}) {b}-{c}", f"00{fresh(2)}-{a}-{b}-{c}"])


def constrained(model: BiLstmCrf) -> BiLstmCrf:
    """The model with moves into the middle of a span that hasn't begun ruled out."""
    move = model.p["move"].copy()
    for k in range(len(KINDS)):
        for t in range(len(move)):
            if t not in (1 + 2 * k, 2 + 2 * k):
                move[t, 2 + 2 * k] = -1e4
    return BiLstmCrf(model.p | {"move": move})


def training_windows(text: str):
    """Labelled windows about every shape of a text, as it stands and respelt."""
    # the checks are made after decoding: what looks like a card is one to the tagger
    labels = [(k, a, b) for k, a, b, ok in shapes(text) if ok or k == 2 and 16 <= sum(c.isdigit() for c in text[a:b]) <= 19]
    free, chosen = 0, []
    for k, a, b in sorted(labels, key=lambda x: (x[1], x[0] == 2)):
        if a >= free:
            chosen.append((k, a, b))
            free = b
    for start in window_starts(text):
        near = [x for x in chosen if x[1] < start + WINDOW and x[2] > start]
        if any(x[1] < start for x in near):
            continue  # a span without its beginning teaches nothing
        piece, tags = labelled_window(text, start, near)
        yield piece, tags
        words = [w for w in piece.split() if w.isalpha()] or ["name"]
        for i in range(RESPELLINGS if near else 0):
            draw = np.random.default_rng(zlib.crc32(f"{i}:{piece}".encode()))
            out, out_tags, at = [], [], 0
            for k, a, b in near:
                new = respelt(k, text[a:b], words, draw)
                out += [piece[at:a - start], new]
                out_tags += [tags[at:a - start], str(1 + 2 * k) + str(2 + 2 * k) * (len(new) - 1)]
                at = b - start
            yield ("".join(out) + piece[at:])[:WINDOW], ("".join(out_tags) + tags[at:])[:WINDOW]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS,
          train_windows: int = TRAIN_WINDOWS, epochs: int = 10) -> BiLstmCrf | None:
    """A tagger from the documents' own labelled spans; None if there are none."""
    total = docs.count()
    at = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.where(at < train_docs / max(total, 1)).select(F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            rows = [x for t in b.column("text").to_pylist() if t for x in training_windows(t)]
            yield pa.record_batch({"piece": pa.array([p for p, _ in rows], pa.string()), "tags": pa.array([t for _, t in rows], pa.string())})

    rows = sample.mapInArrow(run, "piece string, tags string").distinct() \
        .orderBy(F.xxhash64("piece", "tags"), "piece", "tags").limit(train_windows).collect()
    if not any(set(r["tags"]) - {"0"} for r in rows):
        return None
    x = np.stack([window_ids(r["piece"], 0) for r in rows])
    y = np.stack([np.pad(np.array(list(r["tags"]), int), (0, WINDOW - len(r["tags"]))) for r in rows])
    model = BiLstmCrf.new(VOCABULARY, 1 + 2 * len(KINDS))
    model.fit(x.astype(int), y, epochs, batch=128, rate=0.03)
    return constrained(model)


def find(docs: DataFrame, model: BiLstmCrf | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``base`` and ``spans`` (arrays of kind, start, end) of every row."""
    if clash := {"base", "spans"} & {c.lower() for c in keep}:
        raise ValueError(f"kept columns clash with results: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(
        None if model is None else {k: v.astype(np.float32) for k, v in model.p.items()})
    cols = docs.select(*keep, F.col(text_col).alias("__text"))
    kept = list(keep)
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans):
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in spans], kind)

    def run(batches):
        m = BiLstmCrf(shared.value) if shared.value else None
        for b in batches:
            text = [t or "" for t in b.column("__text").to_pylist()]
            for i, j in slices([len(t) for t in text], CHUNK):
                base = [base_spans(t) for t in text[i:j]]
                more = added_spans(text[i:j], base, m)
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [rows(base), rows([sorted(x + y) for x, y in zip(base, more)])],
                    names=kept + ["base", "spans"])

    span = "array<struct<kind:int,start:int,end:int>>"
    return cols.mapInArrow(run, plus(cols.drop("__text").schema, f"base {span}, spans {span}"))


def listed(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, train(docs), ["doc_id"])

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
