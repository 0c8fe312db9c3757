"""Exact, reproducible stratified hold-out splits and k-fold assignment.

Rows of each class are ordered by ``md5("<id>:<seed>")`` (then id) -- the
same order in Spark and DuckDB -- and ranked.  A flat
``row_number() over (partition by label ...)`` would put a whole class (half
the data for a binary label) in one task, so the rank is computed in two
levels:

* bucket = first ``prefix_len`` hex digits of the hash (16**prefix_len
  buckets per class, uniformly filled because md5 is uniform);
* per-(class, bucket) row counts -> running offsets (a small frame, at most
  classes * 16**prefix_len rows);
* row_number inside (class, bucket) + offset = the flat rank, exactly,
  because the bucket is a prefix of the sort key.

Rows with equal ids are ordered by a hash of the whole row, so a split doesn't depend on
how rows lie in files; a row without an id is placed by that hash alone, so such rows
spread over the buckets too.  Only rows that are equal throughout may change places.

Test rows: rank <= ceil(test_size * class_count).  That takes no rank of every row: buckets before the one in which
this rank lies are test rows, buckets behind it are not, and only the rows of that bucket are ranked, so a split shuffles
bucket counts and that bucket, and no other row.  Fold: (rank - 1) % k, which keeps every class's share per fold within one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_PREFIX = 4


def hash_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _keyed(df: DataFrame, id_col: str, seed: int, prefix_len: int) -> DataFrame:
    """``df`` with the hash ``_hk`` that orders rows, its prefix ``_bk`` and the row's own hash ``_tie``."""
    hashed = [F.col(f"`{c}`") for c, t in sorted(df.dtypes) if "map<" not in t and "variant" not in t]  # Spark hashes no maps
    return df.withColumn("_tie", F.xxhash64(*hashed)) \
        .withColumn("_hk", F.coalesce(hash_key(id_col, seed), F.md5(F.concat(F.col("_tie").cast("string"), F.lit(f":{seed}"))))) \
        .withColumn("_bk", F.substring("_hk", 1, prefix_len))


def _offsets(keyed: DataFrame, label: str, count_col: str) -> DataFrame:
    """Per (class, bucket): rows of the class in buckets before, and in all."""
    counts = keyed.groupBy(label, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    wo = Window.partitionBy(label).orderBy("_bk")
    return counts.select(
        label, "_bk",
        (F.sum("_bn").over(wo.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_bn")).alias("_off"),
        F.sum("_bn").over(Window.partitionBy(label)).alias(count_col))


def stratified_rank(df: DataFrame, label: str, id_col: str, seed: int = 42,
                    prefix_len: int = DEFAULT_PREFIX, rank_col: str = "_rank",
                    count_col: str = "_class_n") -> DataFrame:
    """Adds the exact per-class rank (1-based) and the class size."""
    keyed = _keyed(df, id_col, seed, prefix_len)
    offsets = _offsets(keyed, label, count_col)
    wl = Window.partitionBy(label, "_bk").orderBy("_hk", id_col, "_tie")
    ranked = keyed.withColumn("_local", F.row_number().over(wl))
    # null-safe: a NULL label is a class of its own, a NULL id sorts into a bucket of its own
    offsets = offsets.withColumnsRenamed({label: "_label", "_bk": "_bucket"})
    same = F.col(label).eqNullSafe(F.col("_label")) & F.col("_bk").eqNullSafe(F.col("_bucket"))
    return (ranked.join(offsets, same)
            .withColumn(rank_col, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_hk", "_bk", "_tie", "_local", "_off", "_label", "_bucket"))


def assign_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.2,
                 seed: int = 42, stratify: bool = True, prefix_len: int = DEFAULT_PREFIX,
                 out_col: str = "is_test") -> DataFrame:
    """Stratified (or plain) exact hold-out split; adds boolean ``out_col``."""
    if not stratify:
        tmp = "_all_one"
        return assign_split(df.withColumn(tmp, F.lit(1)), tmp, id_col, test_size, seed, True, prefix_len, out_col).drop(tmp)
    keyed = _keyed(df, id_col, seed, prefix_len)
    n_test = F.ceil(F.lit(float(test_size)) * F.col("_class_n"))
    last = F.struct("_bk", (n_test - F.col("_off")).alias("left"))
    cuts = _offsets(keyed, label, "_class_n").where(F.col("_off") < n_test) \
        .groupBy(F.col(label).alias("_label")).agg(F.max(last).alias("_cut"))
    # one row per class; null-safe: a NULL label is a class of its own
    cut = keyed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_label")), "left")
    inside = F.coalesce(F.col("_bk") == F.col("_cut._bk"), F.lit(False))
    whole = cut.where(~inside).withColumn(out_col, F.coalesce(F.col("_bk") < F.col("_cut._bk"), F.lit(False)))
    place = F.row_number().over(Window.partitionBy(label).orderBy("_hk", id_col, "_tie"))
    shared = cut.where(inside).withColumn(out_col, place <= F.col("_cut.left"))
    columns = [F.col(f"`{c}`") for c in df.columns if c != out_col] + [F.col(out_col)]
    return whole.select(*columns).unionAll(shared.select(*columns))


def assign_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                 prefix_len: int = DEFAULT_PREFIX, out_col: str = "fold") -> DataFrame:
    """Stratified k-fold id per row: (rank - 1) % k within each class."""
    r = stratified_rank(df, label, id_col, seed, prefix_len)
    return r.withColumn(out_col, ((F.col("_rank") - 1) % k).cast("int")).drop(
        "_rank", "_class_n")
