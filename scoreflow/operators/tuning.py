"""Parameter search: reproducible trial draws and the search loop helpers.

A trial's value for a parameter comes from one uniform number
u = int(first 8 hex digits of md5("<model>:<trial>:<param>:<seed>"), 16) / 2**32
-- the same formula in Python (driver loop) and in Spark/DuckDB SQL
(``trials_frame``), so a search is reproducible and checkable.
int: low + floor(u * (high - low + 1)); float: low + u * (high - low);
log-float: exp(ln low + u * (ln high - ln low)); categorical: choices[floor(u * k)].
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(model: str, trial: int, param: str, seed: int) -> float:
    h = hashlib.md5(f"{model}:{trial}:{param}:{seed}".encode()).hexdigest()
    return int(h[:8], 16) / 4294967296.0


def draw(spec: tuple, u: float):
    kind = spec[0]
    if kind == "categorical":
        choices = spec[1]
        return choices[min(int(math.floor(u * len(choices))), len(choices) - 1)]
    _, low, high, log = spec
    if kind == "int":
        return int(low + min(math.floor(u * (high - low + 1)), high - low))
    if log:
        return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
    return low + u * (high - low)


def sample_params(model: str, space: dict, n_trials: int, seed: int = 42) -> list[dict]:
    return [{p: draw(spec, uniform(model, t, p, seed)) for p, spec in space.items()}
            for t in range(n_trials)]


def trials_frame(spark: SparkSession, model: str, space: dict, n_trials: int,
                 seed: int = 42) -> DataFrame:
    """The same draws as a DataFrame: one row per (trial, numeric param)."""
    specs = [(p, s) for p, s in space.items() if s[0] != "categorical"]
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.lit(s[0]).alias("kind"),
                             F.lit(float(s[1])).alias("low"), F.lit(float(s[2])).alias("high"),
                             F.lit(bool(s[3])).alias("log")) for p, s in specs])
    t = spark.range(n_trials).select(F.col("id").cast("int").alias("trial"),
                                     F.explode(arr).alias("s")).select("trial", "s.*")
    key = F.concat_ws(":", F.lit(model), F.col("trial").cast("string"), F.col("param"), F.lit(str(seed)))
    u = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    val = (F.when(F.col("kind") == "int", F.col("low") + F.least(
               F.floor(u * (F.col("high") - F.col("low") + 1)), F.col("high") - F.col("low")))
            .when(F.col("log"), F.exp(F.log(F.col("low")) + u * (F.log(F.col("high"))
                                                                  - F.log(F.col("low")))))
            .otherwise(F.col("low") + u * (F.col("high") - F.col("low"))))
    return t.select("trial", "param", u.alias("u"), val.cast("double").alias("value"))
