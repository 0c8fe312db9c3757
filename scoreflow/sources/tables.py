"""Driver tables and the passenger-shaped ``subjects`` view.

``subjects`` is an adapter over ``orders`` joined to ``customer`` that has
the shape of the labelled passenger table (id, label, tier, full name, sex,
age, sibsp, parch, fare, port) with deterministic nulls, so every feature,
split, metric and scoring operator runs on data that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUBJECT_COLUMNS = ["subject_id", "label", "tier", "full_name", "sex", "age",
                   "sibsp", "parch", "fare", "port"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _title_word(key: Column) -> Column:
    # Honorific chosen by o_orderkey % 9 (0..8), in order.
    words = ["Mr", "Miss", "Mrs", "Master", "Dr", "Mlle", "Countess", "Zzz", "Capt"]
    return F.element_at(F.array(*[F.lit(w) for w in words]), (key % 9 + 1).cast("int"))


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer re-shaped as labelled subjects.

    The join is an equi-join on the customer key; Spark picks broadcast only
    when AQE measures the customer side under the broadcast threshold,
    otherwise a shuffle join on ``o_custkey``.  Only the 4 + 3 needed
    columns are read from parquet.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    key = F.col("o_orderkey")
    female = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    score = (F.col("o_totalprice") / F.lit(500000.0)
             + F.when(female, F.lit(0.3)).otherwise(F.lit(0.0))
             + (key * 37 % 101).cast("double") / F.lit(202.0))
    prio = F.substring("o_orderpriority", 1, 1)
    return j.select(
        key.alias("subject_id"),
        F.when(score > 0.9, 1).otherwise(0).cast("int").alias("label"),
        (F.lit(1) + F.col("o_custkey") % 3).cast("int").alias("tier"),
        F.concat(F.lit("Doe, "), _title_word(key), F.lit(". "), F.col("c_name")).alias("full_name"),
        F.when(female, "female").otherwise("male").alias("sex"),
        F.when(key % 5 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(1) + (key * 13) % 80).cast("double")).alias("age"),
        (key % 4).cast("int").alias("sibsp"),
        ((key * 7) % 3).cast("int").alias("parch"),
        F.when(key % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("fare"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
         .when(prio.isin("1", "2"), "S")
         .when(prio == "3", "C")
         .otherwise("Q").alias("port"),
    )


# The same view as ANSI SQL; used as a CTE by every oracle query.
SUBJECTS_SQL = """
select
  o_orderkey as subject_id,
  cast(case when o_totalprice / 500000.0
          + case when c_mktsegment in ('BUILDING','MACHINERY') then 0.3 else 0.0 end
          + cast(o_orderkey * 37 % 101 as double) / 202.0 > 0.9 then 1 else 0 end as integer) as label,
  cast(1 + o_custkey % 3 as integer) as tier,
  concat('Doe, ', case o_orderkey % 9
      when 0 then 'Mr' when 1 then 'Miss' when 2 then 'Mrs' when 3 then 'Master'
      when 4 then 'Dr' when 5 then 'Mlle' when 6 then 'Countess' when 7 then 'Zzz'
      else 'Capt' end, '. ', c_name) as full_name,
  case when c_mktsegment in ('BUILDING','MACHINERY') then 'female' else 'male' end as sex,
  case when o_orderkey % 5 = 0 then null
       else cast(1 + (o_orderkey * 13) % 80 as double) end as age,
  cast(o_orderkey % 4 as integer) as sibsp,
  cast((o_orderkey * 7) % 3 as integer) as parch,
  case when o_orderkey % 11 = 0 then null else o_totalprice end as fare,
  case when o_orderkey % 17 = 0 then null
       when substr(o_orderpriority, 1, 1) in ('1','2') then 'S'
       when substr(o_orderpriority, 1, 1) = '3' then 'C'
       else 'Q' end as port
from orders join customer on o_custkey = c_custkey
"""


def with_subjects(sql_body: str) -> str:
    """Prefix an oracle query with the ``subjects`` CTE."""
    return f"with subjects as ({SUBJECTS_SQL})\n{sql_body}"


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, unvalidated records (orders ⋈ customer) for the intake path.

    Same people as ``subjects`` but as they would arrive from outside: mixed
    case, blank ports, out-of-range tiers, ages, counts and fares, and no
    ticket/cabin columns, so every validation and conformance rule has work
    to do on data that grows with the tables.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    key = F.col("o_orderkey")
    seg = F.col("c_mktsegment")
    prio = F.substring("o_orderpriority", 1, 1)
    return j.select(
        key.alias("subject_id"),
        F.when(F.col("o_custkey") % 23 == 0, 4)
         .otherwise(F.lit(1) + F.col("o_custkey") % 3).cast("int").alias("tier"),
        F.concat(F.lit("Doe, "), _title_word(key), F.lit(". "), F.col("c_name")).alias("full_name"),
        F.when(key % 29 == 0, "unknown")
         .when(seg == "BUILDING", "Female").when(seg == "MACHINERY", "FEMALE")
         .when(seg == "AUTOMOBILE", "male").when(seg == "HOUSEHOLD", "Male")
         .otherwise("MALE").alias("sex"),
        F.when(key % 5 == 0, F.lit(None).cast("double"))
         .otherwise(((key * 13) % 125 - 2).cast("double")).alias("age"),
        F.when(key % 31 == 0, -1).otherwise(key % 4).cast("int").alias("sibsp"),
        ((key * 7) % 4).cast("int").alias("parch"),
        F.when(key % 11 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") - F.lit(2000.0)).alias("fare"),
        F.when(key % 17 == 0, F.lit(None).cast("string"))
         .when(key % 37 == 0, "X")
         .when(prio == "1", "s").when(prio == "2", "S").when(prio == "3", "c")
         .when(prio == "4", "").otherwise("q").alias("port"),
    )


def table_version(spark: SparkSession, sf_dir: str) -> tuple:
    """Files, sizes and write times behind ``subjects``, so that a changed table is noticed."""
    found = []
    for name in ("orders", "customer"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        s = fs.getFileStatus(path)
        parts = list(fs.listStatus(path)) if s.isDirectory() else [s]
        found += sorted((str(x.getPath()), x.getLen(), x.getModificationTime()) for x in parts)
    return tuple(found)


INTAKE_SQL = """
select
  o_orderkey as subject_id,
  cast(case when o_custkey % 23 = 0 then 4 else 1 + o_custkey % 3 end as integer) as tier,
  concat('Doe, ', case o_orderkey % 9
      when 0 then 'Mr' when 1 then 'Miss' when 2 then 'Mrs' when 3 then 'Master'
      when 4 then 'Dr' when 5 then 'Mlle' when 6 then 'Countess' when 7 then 'Zzz'
      else 'Capt' end, '. ', c_name) as full_name,
  case when o_orderkey % 29 = 0 then 'unknown'
       else case c_mktsegment when 'BUILDING' then 'Female' when 'MACHINERY' then 'FEMALE'
       when 'AUTOMOBILE' then 'male' when 'HOUSEHOLD' then 'Male' else 'MALE' end end as sex,
  case when o_orderkey % 5 = 0 then null
       else cast((o_orderkey * 13) % 125 - 2 as double) end as age,
  cast(case when o_orderkey % 31 = 0 then -1 else o_orderkey % 4 end as integer) as sibsp,
  cast((o_orderkey * 7) % 4 as integer) as parch,
  case when o_orderkey % 11 = 0 then null else o_totalprice - 2000.0 end as fare,
  case when o_orderkey % 17 = 0 then null
       when o_orderkey % 37 = 0 then 'X'
       when substr(o_orderpriority, 1, 1) = '1' then 's'
       when substr(o_orderpriority, 1, 1) = '2' then 'S'
       when substr(o_orderpriority, 1, 1) = '3' then 'c'
       when substr(o_orderpriority, 1, 1) = '4' then ''
       else 'q' end as port
from orders join customer on o_custkey = c_custkey
"""
