"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text is the sequence of its code points that are not white space.  A k-mer of ``K`` code points is an anchor if the
smallest hash among its inner substrings of ``S`` stands at its first or last place.  The choice looks at nothing
outside the k-mer, so an unchanged passage of ``K`` code points or more keeps its anchors wherever it moves, in any
script, with or without spaces.  A fingerprint is the ``SKETCH`` smallest distinct anchor hashes (32 bits each, in
hexadecimal digits); the likeness of two fingerprints is the share of their joint smallest hashes that both hold.
``add_anchors`` gives the anchors with their positions, for positional matching; the sketches hold hashes only.

Overlapping substrings of ``S`` come out of one pass of a look-ahead pattern, without white space, and are hashed once each.  Sliding minima come from pairwise minima over doubling spans, array by array, so the work per code point doesn't
grow with ``K``.  The edited text (the head of a text, then that of the next) shares the anchors of its first part with
the text, so only its second part, with the ``K`` - 1 code points before it, is walked anew.

The document that follows in descending order of id is found without a global window.  Rows are ordered by id, then a hash
of their text; a first pass over these keys alone (no texts) range-partitions them, which cuts one id with
many texts too, and gives the lowest key of each range.  Texts are then dealt to these ranges in one shuffle, every
range's first row also to the range before it.

Defined results: a null text is empty; an empty text has an empty fingerprint, like (1.0) to another empty
one and unlike (0.0) any other; a text without anchors has one, its whole; null ids come last; rows with
equal ids are ordered by a hash of their text, and equal rows lie in one range; a single row follows itself; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import table

K = 12
S = 5
SKETCH = 64
RANGE_ROWS = 2000
MOST_RANGES = 16_384  # so that their lowest keys stay below 1 MB; a larger range is sorted on disk


def _pairs(a: Column, d: int, f) -> Column:
    """f(a[i], a[i + d]) for all i that have both."""
    n = F.greatest(F.size(a) - d, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(d + 1), n), f)


def _hits(df: DataFrame, text_col: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Adds ``name``: for every k-mer its hash, or null where it is no anchor."""
    w = k - s + 1
    df = df.withColumn("__p", F.regexp_replace(F.col(text_col), r"\s+", ""))
    # overlapping substrings of s code points; among surrogate pairs a match must not start on a second half
    plain, pairs = (F.regexp_extract_all("__p", F.lit(f"(?s){guard}(?=(.{{{s}}}))"), F.lit(1)) for guard in ("", r"(?![\x{DC00}-\x{DFFF}])"))
    grams = F.when(F.col("__p").rlike(r"[\x{10000}-\x{10FFFF}]"), pairs).otherwise(plain)
    df = df.withColumn("__m1", F.transform(grams, lambda x: F.xxhash64(x)))
    made, inner, span = ["__p", "__m1", "__low"], F.col("__m1"), 1
    while span * 2 <= w:
        made.append(f"__m{span * 2}")
        df = df.withColumn(made[-1], _pairs(F.col(f"__m{span}"), span, lambda x, y: F.least(x, y)))
        span *= 2
    low = F.col(f"__m{span}") if span == w else _pairs(F.col(f"__m{span}"), w - span, lambda x, y: F.least(x, y))
    df = df.withColumn("__low", low)
    steps = sorted({*range(0, w, s), w - 1})  # inner substrings that cover the k-mer
    return df.withColumn(name, F.transform("__low", lambda x, i: F.when(
        (x == F.get(inner, i)) | (x == F.get(inner, i + w - 1)),
        F.xxhash64(*[F.get(inner, i + j) for j in steps]).bitwiseAND(F.lit(0xFFFFFFFF))))).drop(*made)


def add_anchors(df: DataFrame, text_col: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Adds ``name``: array<struct<pos, hash>> of the closed syncmers; pos counts code points that aren't white space, from 0."""
    found = F.array_compact(F.transform("__hits", lambda x, i: F.when(x.isNotNull(), F.struct(i.alias("pos"), x.alias("hash")))))
    return _hits(df, text_col, "__hits", k, s).withColumn(name, found).drop("__hits")


def _lowest(hits: Column) -> Column:
    """The smallest distinct hashes; nulls, of which one is left, sort first."""
    return F.slice(F.array_compact(F.slice(F.sort_array(F.array_distinct(hits)), 1, SKETCH + 1)), 1, SKETCH)


def _or_whole(sketch: Column, text_col: str) -> Column:
    """``sketch``, or that of a text without anchors."""
    whole = F.when(F.length(text_col) > 0, F.array(F.xxhash64(text_col).bitwiseAND(F.lit(0xFFFFFFFF)))) \
        .otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(sketch) > 0, sketch).otherwise(whole)


def with_sketch(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Adds ``name``: the sorted smallest anchor hashes of a text that is not null."""
    found = _hits(df, text_col, "__hits").withColumn(name, _lowest(F.col("__hits")))
    return found.withColumn(name, _or_whole(F.col(name), text_col)).drop("__hits")


def with_head_sketch(df: DataFrame, text_col: str, head: Column, name: str, head_name: str) -> DataFrame:
    """``with_sketch``, and ``head_name``: the smallest hashes of the anchors that lie in the first ``head`` code points."""
    pieces = F.char_length(F.regexp_replace(F.substring(F.col(text_col), F.lit(1), head), r"\s+", ""))
    found = _hits(df, text_col, "__hits")
    found = found.withColumn(head_name, _lowest(F.slice("__hits", F.lit(1), F.least(F.size("__hits"), F.greatest(pieces - (K - 1), F.lit(0)))))) \
        .withColumn(name, _lowest(F.col("__hits")))
    return found.withColumn(name, _or_whole(F.col(name), text_col)).drop("__hits")


def fingerprint(sketch: Column) -> Column:
    """Eight hexadecimal digits a hash; a leading 1 keeps the zeros and is then cut off."""
    digits = F.array_join(F.transform(sketch, lambda x: F.hex(x + F.lit(1 << 32))), "")
    return F.lower(F.regexp_replace(digits, "1(.{8})", "$1"))


def likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds ``name``: the likeness of two sketches."""
    df = df.withColumn("__joint", F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH))
    both = F.size(F.array_intersect("__joint", F.array_intersect(a, b)))
    return df.withColumn(name, F.when(F.size("__joint") > 0, both / F.size("__joint")).otherwise(F.lit(1.0))).drop("__joint")


def _order(id_col: Column, text_col: str) -> Column:
    """Ascends where rows come in descending order of id, null ids last, equal ids by a hash of the text."""
    return F.struct(id_col.isNull().alias("none"), F.coalesce(F.bitwise_not(id_col.cast("long")), F.lit(0)).alias("back"),
                    F.xxhash64(text_col).alias("tie"))


KEY = "struct<none:boolean,back:bigint,tie:bigint>"


def _literal(value, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def with_next(df: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds next_<column> of the row that follows in descending order of id; the first follows the last."""
    keys = df.select(_order(F.col(id_col), text_col).alias("key"))
    ranges = max(1, min(keys.count() // RANGE_ROWS, MOST_RANGES))
    parts = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("low"))
    lows = [r["low"].asDict() for r in parts.orderBy("low").collect()]
    # two levels, so that a row is compared with about 2 * sqrt(ranges) keys
    wide = max(1, round(len(lows) ** 0.5))
    groups = [lows[i:i + wide] for i in range(0, len(lows), wide)] or [[]]
    tops, nested = _literal([g[0] for g in groups if g], f"array<{KEY}>"), _literal(groups, f"array<array<{KEY}>>")
    dealt = df.withColumn("__key", _order(F.col(id_col), text_col))
    dealt = dealt.withColumn("__group", F.greatest(F.size(F.filter(tops, lambda x: x <= F.col("__key"))) - 1, F.lit(0)))
    dealt = dealt.withColumn("__mine", F.get(nested, F.col("__group")))
    dealt = dealt.withColumn("__at", F.greatest(F.size(F.filter("__mine", lambda x: x <= F.col("__key"))) - 1, F.lit(0)))
    first = F.col("__key") == F.get("__mine", F.col("__at"))
    own = (F.col("__group") * wide + F.col("__at")).cast("long")
    n = max(1, len(lows))
    places = F.when(first, F.array(F.struct(own.alias("b"), F.lit(0).alias("guest")), F.struct(F.pmod(own - 1, F.lit(n)).alias("b"), F.lit(1).alias("guest")))) \
        .otherwise(F.array(F.struct(own.alias("b"), F.lit(0).alias("guest"))))
    dealt = dealt.withColumn("__place", F.explode(places)).select(*df.columns, "__key", F.col("__place.b").alias("__range"), F.col("__place.guest").alias("__guest"))
    # one struct, so that there is one window and the texts are shuffled once
    order = Window.partitionBy("__range").orderBy("__guest", "__key")
    dealt = dealt.repartition(n, "__range").withColumn("__next", F.lead(F.struct(*columns)).over(order)).where("__guest = 0")
    return dealt.select(*df.columns, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns])


def op9_syncmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = with_next(with_head_sketch(docs, "text", n - half, "sketch", "head_sketch"), ["text", "sketch"])
    head, added = F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)
    pieces = F.regexp_replace(head, r"\s+", "")
    before = F.substring(pieces, F.greatest(F.char_length(pieces) - (K - 2), F.lit(1)), F.lit(K - 1))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", "head_sketch",
                       F.concat(head, added).alias("edited"), F.concat(before, added).alias("walked"))
    both = _hits(both, "walked", "hits").withColumn("edited_sketch", _lowest(F.concat("head_sketch", "hits")))
    both = both.withColumn("edited_sketch", _or_whole(F.col("edited_sketch"), "edited"))
    both = likeness(likeness(both, "sketch", "edited_sketch", "near_edited"), "sketch", "next_sketch", "near_next")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
