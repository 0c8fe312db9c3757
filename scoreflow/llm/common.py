"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from scoreflow.session import ensure_checkpoint_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the location that ``spark.checkpoint.dir`` names, one per call."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost
    executors, and keeps an expensive scan from running twice."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(sizes, limit: int):
    """(start, stop) runs of consecutive items whose sizes add up to ``limit`` at most (one item
    may be larger): bounds the memory of the numpy work inside one Arrow batch."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over uint64 (wraps)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cached(key, make):
    """``make()`` once per Python worker: functions shipped by value get fresh globals in every task,
    so what is costly to build is kept on a module of its own."""
    store = sys.modules.setdefault("_scoreflow_llm_cache", types.ModuleType("_scoreflow_llm_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def plus(schema: StructType, ddl: str) -> StructType:
    """``schema`` followed by the columns of ``ddl``."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)
