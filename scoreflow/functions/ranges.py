"""Running totals over an order, for any number of rows and any groups.

One window over all rows (or over one hot group) would put them into one task.  Here the rows are range-partitioned by
group and value and written once; totals of every (group, partition) pair, a handful of rows per partition,
are summed up in order, and a window inside each pair does the rest.  There is one path for all
sizes, no sketch and no cap; groups are matched null-safely, so the NULL group stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreflow.session import written


def running_totals(df: DataFrame, by: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    """``df`` with ``<c>_before`` (total of c over the group's rows before this one in ``order``) and
    ``<c>_total`` (over the whole group) for every c in ``sums``.  ``order`` values are distinct within a
    group; NULL comes first."""
    by = list(by)
    dealt = written(df.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in sums])
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_part").alias("_p"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *[F.sum(c).over(group).alias(f"{c}_total") for c in sums])
    inside = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{c}") for c in sums])
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, same).select(
        *df.columns, *[(F.col(f"_off_{c}") + F.col(f"_in_{c}")).alias(f"{c}_before") for c in sums],
        *[f"{c}_total" for c in sums])
