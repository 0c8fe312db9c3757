"""Exact quantiles and modes that never gather a whole group in one task.

Spark's exact ``percentile``/``median`` merge a value->count map per group in
a single task; for a continuous column and a hot group (say a third of all
rows) that map is as large as the group.  ``exact_quantiles`` collapses rows to
(group, value, count), numbers them with ``running_totals`` (range partitions and
offsets, so a hot group lies in many partitions) and reads the two order statistics
around rank (n-1)*p off the rows that hold them, interpolated linearly like
``percentile_cont`` / ``numpy.quantile``.  One path for all sizes: no sketch, no band,
no join of base rows.  The NULL group is a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.functions.ranges import running_totals


def _clean_value(value: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("double")


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
                    names: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Exact ``percentile_cont`` of ``value`` at ``probs`` per ``by`` group.

    NULL and NaN values are skipped.  Returns one row per group with the
    group columns and one double column per probability.
    """
    by = list(by)
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    values = df.select(*by, _clean_value(value).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ranked = running_totals(values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")), by, "_v", ["_c"])

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_c_before") <= rank) & (rank < F.col("_c_before") + F.col("_c")), F.col("_v")))

    picks = []
    for i, p in enumerate(probs):
        h = (F.col("_c_total") - 1).cast("double") * F.lit(float(p))
        picks += [at(F.floor(h)).alias(f"_low{i}"), at(F.ceil(h)).alias(f"_high{i}"), F.max(h - F.floor(h)).alias(f"_part{i}")]
    found = ranked.groupBy(*by).agg(*picks)
    return found.select(*by, *[(F.col(f"_low{i}") + F.col(f"_part{i}") * (F.col(f"_high{i}") - F.col(f"_low{i}"))).alias(n)
                               for i, n in enumerate(names)])


def mode_of(df: DataFrame, value: str, name: str = "mode", by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    Two partial/final hash aggregates: (group, value) counts, then
    ``min_by`` over (-count, value) -- no group is ever gathered.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(*by).agg(
        F.min_by(F.col(value), F.struct((-F.col("_c")).alias("_nc"), F.col(value).alias("_v")))
        .alias(name))
