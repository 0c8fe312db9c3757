"""CSV / catalog-table sources and sinks.

* CSV is read with an explicit schema (never inferred): every column comes
  in as text, the usual missing-value tokens become NULL, then ``try_cast``
  applies the schema -- a bad cell becomes NULL instead of failing the job.
* Table loads are full refreshes by column name (not by position): the rows are
  written to a new folder, then the catalog table is pointed at it, so a reader
  sees the old rows or the new ones, and a failed write leaves the old ones; the
  row count is read back from the table.  Earlier folders stay for readers that
  still use them.
* Row ids for files without one are contiguous 0..n-1 in line order, files in order of
  their path: a table of the blocks (file, start) with their first id, no
  single-partition step and no copy of the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text tokens read as missing (the pandas CSV defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Fixed DDL of the two catalog tables (scoring input and predictions).
TEST_DATA_DDL = ("subject_id BIGINT, tier INT, full_name STRING, sex STRING, age DOUBLE, "
                 "sibsp INT, parch INT, ticket STRING, fare DOUBLE, cabin STRING, port STRING")
PREDICTIONS_DDL = ("subject_id BIGINT, tier INT, sex STRING, age DOUBLE, fare DOUBLE, pred INT, "
                   "prob DOUBLE, confidence STRING, model_name STRING, model_version STRING, "
                   "predicted_at TIMESTAMP")


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             na_tokens: Sequence[str] = NA_TOKENS, add_missing: bool = False, row_id: str | None = None) -> DataFrame:
    """Columns are matched to the schema by header name (a schema given to
    the CSV reader would be applied by position); every column is read as
    text (no inference), NA tokens -> NULL, then cast; numbers may have spaces
    around them, NA tokens may not.  Schema fields absent from the file are left
    out, or added as NULL with ``add_missing``; ``row_id`` names a column of ids to put first."""
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("nullValue", "\u0000").option("emptyValue", "").csv(path))
    present = set(raw.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f"`{f.name}`")
            c = F.when(c.isNull() | c.isin(*na_tokens), F.lit(None)).otherwise(c)
            cols.append(c.try_cast(f.dataType).alias(f.name))
        elif add_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if row_id is None:
        return raw.select(*cols)
    return _with_line_ids(raw, row_id, cols)


def _with_line_ids(raw: DataFrame, id_col: str, cols) -> DataFrame:
    """Ids 0..n-1 in line order over a set of files.  A block (a stretch of one file) is read by one task, its rows one after
    the other, so a row's place in it is the distance from the block's first row; how files are cut into blocks depends
    on the files and the settings only, so both passes see the same blocks."""
    at = raw.select(*cols, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
                    F.monotonically_increasing_id().alias("_mid"))
    blocks = at.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = blocks.select("_path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    keep = [c for c in at.columns if c not in ("_path", "_start", "_mid")]
    return at.join(offsets, ["_path", "_start"]).select((F.col("_off") + F.col("_mid") - F.col("_first")).cast("long").alias(id_col), *keep)


def read_labelled(spark: SparkSession, path: str, schema: T.StructType, label: str) -> DataFrame:
    """Labelled training rows; features and label stay in one frame."""
    df = read_csv(spark, path, schema)
    if label not in df.columns:
        raise ValueError(f"label column {label!r} missing from {path}")
    return df


def read_for_scoring(spark: SparkSession, path: str, schema: T.StructType, label: str,
                     id_col: str) -> DataFrame:
    """Scoring input: label dropped if present; ids added if absent."""
    fields = [f for f in schema.fields if f.name != label]
    df = read_csv(spark, path, T.StructType(fields))
    if id_col not in df.columns:
        df = read_csv(spark, path, T.StructType(fields), row_id=id_col)
    return df


def write_csv(df: DataFrame, path: str, cols: Sequence[str] | None = None) -> None:
    (df.select(*(cols or df.columns)).write.mode("overwrite").option("header", True).csv(path))


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


def table_root(spark: SparkSession) -> str:
    """Shared folder for table data: ``scoreflow.table.dir`` if set, else a
    sub-folder of the cluster's checkpoint directory."""
    from scoreflow.session import shared_dir

    root = spark.conf.get("scoreflow.table.dir", None)
    return root.rstrip("/") if root else shared_dir(spark, "tables")


def ensure_tables(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the two tables if absent, as external parquet tables at a
    shared location (re-registering over existing data is allowed)."""
    root = (location or table_root(spark)).rstrip("/")
    for name, ddl in (("test_data", TEST_DATA_DDL), ("predictions", PREDICTIONS_DDL)):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({ddl}) USING parquet "
                  f"LOCATION '{root}/{db}/{name}'")


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def full_refresh(spark: SparkSession, df: DataFrame, table: str) -> int:
    """Replace a table's rows with ``df`` (matched by column name): written to a folder of its own beside the present
    one, then made the table's location in one catalog change."""
    target = spark.table(table).schema
    src = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                      .cast(f.dataType).alias(f.name) for f in target.fields])
    present = table_location(spark, table)
    home = present.rsplit("/version-", 1)[0]
    fresh = f"{home}/version-{uuid.uuid4().hex}"
    src.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(table)
    return spark.table(table).count()


def ingest_csv(spark: SparkSession, csv_path: str, schema: T.StructType, table: str,
               conform=None) -> int:
    """CSV -> (conform) -> table full refresh; returns the loaded row count."""
    df = read_csv(spark, csv_path, schema)
    if conform is not None:
        df = conform(df)
    return full_refresh(spark, df, table)


def sample_rows(df: DataFrame, id_col: str, cols: Sequence[str], n: int = 3) -> DataFrame:
    """First ``n`` rows by id (a top-n, not a full sort)."""
    return df.select(*cols).orderBy(id_col).limit(n)
