"""Run tracking and model registry as ordinary tables.

``runs``: one row per training/evaluation run with map columns for params,
metrics and tags; ``model_versions``: one row per registered version.  Both
are small (one row per run) parquet tables under a shared directory.  A run
lies in a folder of its own key, so writing it again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.functions import scalars as S

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("stage", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("parent_run_id", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("duration_sec", T.DoubleType()),
    T.StructField("model_path", T.StringType()),
])
VERSIONS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
])
MISSING = "—"  # shown for a model absent from one stage


def run_key(stage: str, model: str):
    return S.model_key(stage, model)


def append_runs(runs: DataFrame, path: str) -> None:
    """Adds runs; a run that is there already (same run_id) is replaced, so a repeated write changes nothing."""
    rows = runs.select(*[F.col(f.name).cast(f.dataType) for f in RUNS_SCHEMA.fields]).withColumn("run_key", F.sha2("run_id", 256))
    rows.repartition("run_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_key").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def best_run(runs: DataFrame, metric: str = "test_roc_auc") -> DataFrame:
    """Highest ``metrics[metric]`` across all runs (ties: smallest run_id)."""
    m = F.col("metrics")[metric]
    return runs.orderBy(m.desc_nulls_last(), F.col("run_id")).limit(1)


def latest_versions(versions: DataFrame) -> DataFrame:
    """Latest version per model name, ordered numerically (10 > 9)."""
    v = F.col("version").cast("long")
    return versions.groupBy("name").agg(
        F.max_by(F.struct(*[F.col(c) for c in versions.columns]), v).alias("_l")
    ).select("_l.*")


def next_version(versions: DataFrame, name: str) -> DataFrame:
    """One-row frame with the next numeric version for ``name``."""
    return versions.where(F.col("name") == name).agg(
        (F.coalesce(F.max(F.col("version").cast("long")), F.lit(0)) + 1).cast("string")
        .alias("version"))


def promote_latest(versions: DataFrame, stage: str = "Production",
                   archived: str = "Archived") -> DataFrame:
    """Latest version of each name -> ``stage``; versions previously in
    ``stage`` -> ``archived``; others unchanged."""
    w = Window.partitionBy("name")
    latest = F.max(F.col("version").cast("long")).over(w)
    return versions.withColumn(
        "stage", F.when(F.col("version").cast("long") == latest, F.lit(stage))
        .when(F.col("stage") == stage, F.lit(archived)).otherwise(F.col("stage")))


def resolve_model(versions: DataFrame, runs: DataFrame, name: str,
                  preference: Sequence[str] = ("Production", "tuned", "base")) -> DataFrame:
    """Model lookup order: production version, then best tuned run, then best
    base run.  Returns at most one row with ``model_path``, ``version`` (registered models) and ``source``."""
    prod = latest_versions(versions.where((F.col("name") == name) &
                                          (F.col("stage") == "Production")))
    prod = prod.join(runs.select("run_id", "model_path"), "run_id").select(
        "model_path", "version", F.lit("Production").alias("source"), F.lit(0).alias("_pref"))
    tuned = runs.where(F.col("stage").isin("stage2", "ensemble")).select(
        "model_path", F.lit(None).cast("string").alias("version"), F.lit("tuned").alias("source"), F.lit(1).alias("_pref"),
        F.col("metrics")["test_roc_auc"].alias("_m"))
    base = runs.where(F.col("stage") == "stage1").select(
        "model_path", F.lit(None).cast("string").alias("version"), F.lit("base").alias("source"), F.lit(2).alias("_pref"),
        F.col("metrics")["test_roc_auc"].alias("_m"))
    allowed = [i for i, p in enumerate(("Production", "tuned", "base")) if p in preference]
    cand = prod.withColumn("_m", F.lit(None).cast("double")).unionByName(tuned).unionByName(base)
    return cand.where(F.col("_pref").isin(allowed)).orderBy(
        "_pref", F.col("_m").desc_nulls_last(), "model_path").limit(1).drop("_pref", "_m")


def stage_results(stage1: DataFrame, stage2: DataFrame, metric1: str, metric2: str) -> DataFrame:
    """Full outer join of two per-model result tables on ``model``, sorted;
    a model missing from one side shows the placeholder text."""
    a = stage1.select("model", F.col(metric1).alias("stage1_value"))
    b = stage2.select("model", F.col(metric2).alias("stage2_value"))
    j = a.join(b, "model", "full_outer")

    def shown(c):
        return F.when(F.col(c).isNull(), F.lit(MISSING)).otherwise(
            F.format_string("%.4f", F.col(c)))

    return j.select("model", "stage1_value", "stage2_value",
                    shown("stage1_value").alias("stage1_text"),
                    shown("stage2_value").alias("stage2_text")).orderBy("model")


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots of the versions table, oldest first; a missing folder has none, and any
    other failure to read it is raised."""
    fs, p = _files(spark, path)
    if not fs.exists(p):
        return []
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith("snapshot-") and fs.exists(marker(f"{path}/{n}/_SUCCESS")))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot, or no rows where nothing was ever registered."""
    found = _snapshots(spark, path.rstrip("/"))
    if not found:
        return spark.createDataFrame([], VERSIONS_SCHEMA)
    return spark.read.schema(VERSIONS_SCHEMA).parquet(f"{path.rstrip('/')}/{found[-1]}")


def register_and_promote(spark: SparkSession, versions_path: str, name: str, run_id: str) -> str:
    """The version of ``run_id``, registered as the next numeric one if it has none yet, and promoted.

    The table (one row per registration) is written as a new snapshot folder, which readers see once its
    job has committed; earlier snapshots stay.  A retry finds the run registered and adds nothing.  One
    writer at a time is assumed.
    """
    path = versions_path.rstrip("/")
    current = read_versions(spark, path)
    mine = current.where((F.col("name") == name) & (F.col("run_id") == run_id)).collect()
    version = mine[0]["version"] if mine else next_version(current, name).collect()[0]["version"]
    if not mine:
        current = current.unionByName(spark.createDataFrame([(name, version, run_id, "None")], VERSIONS_SCHEMA))
    number = len(_snapshots(spark, path))
    promote_latest(current).write.mode("overwrite").parquet(f"{path}/snapshot-{number:012d}")
    return version
