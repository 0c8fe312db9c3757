"""Spark session helpers.

The library never creates machine-local scratch space on a cluster: lineage
is cut with ``DataFrame.checkpoint()`` or a written table in the directory the
cluster names in ``spark.checkpoint.dir``.  Only a session on a ``local``
master may do without that setting; elsewhere its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "scoreflow") -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    given = SparkConf()  # what spark-submit and the defaults file set
    if master and not given.contains("spark.master"):
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if given.get("spark.master", master or "local").startswith("local"):
        conf |= {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                 "spark.driver.memory": os.environ.get("SCOREFLOW_DRIVER_MEMORY", "8g")}
    for k, v in conf.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only when unset."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="scoreflow-ckpt-")  # one machine: it is shared
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, name: str) -> str:
    """The folder ``name`` of this application in the shared checkpoint location; two applications
    never share one."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{spark.sparkContext.applicationId}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new shared folder and read back: evaluated once, lineage cut."""
    path = f"{shared_dir(df.sparkSession, name)}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
