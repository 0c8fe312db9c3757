import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from scoreflow.operators.splits import assign_folds, assign_split, hash_key, stratified_rank
from scoreflow.sources.tables import subjects
from tests.conftest import SF_MID


def test_two_level_rank_equals_flat_rank(spark):
    s = subjects(spark, SF_MID)
    two = stratified_rank(s, "label", "subject_id", prefix_len=2).select("subject_id", "_rank")
    flat = s.select("subject_id", F.row_number().over(
        Window.partitionBy("label").orderBy(hash_key("subject_id", 42), "subject_id")
    ).alias("flat"))
    assert two.join(flat, "subject_id").where(F.col("_rank") != F.col("flat")).count() == 0


def test_split_sizes_and_known_values(spark):
    s = assign_split(subjects(spark, SF_MID), "label", "subject_id")
    per = {r["label"]: (r["n"], r["t"]) for r in s.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for n, t in per.values():
        assert t == math.ceil(0.2 * n)
    test = s.where("is_test")
    r = test.agg(F.count("*"), F.sum("label"), F.sum("subject_id")).collect()[0]
    assert tuple(r) == (3001, 1424, 22616658)


def test_folds_partition_and_balance(spark):
    tr = assign_split(subjects(spark, SF_MID), "label", "subject_id").where(~F.col("is_test"))
    f = assign_folds(tr, "label", "subject_id", k=5)
    assert f.count() == tr.count() == f.select("subject_id").distinct().count()
    shares = f.groupBy("label", "fold").count().groupBy("label").agg(
        (F.max("count") - F.min("count")).alias("spread")).collect()
    assert all(r["spread"] <= 1 for r in shares)


def test_null_labels_and_ids_stay(spark):
    df = spark.createDataFrame([(None if i % 10 == 0 else i % 2, None if i % 17 == 3 else i) for i in range(100)],
                               "label int, id long")
    s = assign_split(df, "label", "id")
    assert s.count() == 100
    per = {r["label"]: (r["n"], r["t"]) for r in s.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert per[None] == (10, 2) and all(t == math.ceil(0.2 * n) for n, t in per.values())
    assert assign_folds(df, "label", "id").count() == 100


def test_split_does_not_depend_on_layout(spark):
    """Half of the rows share one id, half have none."""
    rows = [(i % 2, 7 if i < 50 else None, f"row {i}") for i in range(100)]
    found = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows if parts == 1 else rows[::-1], "label int, id long, text string").repartition(parts)
        found.append((sorted(r["text"] for r in assign_split(df, "label", "id").where("is_test").collect()),
                      sorted((r["text"], r["fold"]) for r in assign_folds(df, "label", "id").collect())))
    assert found[0] == found[1] and len(found[0][0]) == 20
    from scoreflow.operators.splits import stratified_rank
    spread = stratified_rank(spark.createDataFrame(rows, "label int, id long, text string"), "label", "id")
    assert spread.count() == 100


def test_split_shuffles_counts_and_one_bucket_but_no_other_row(spark):
    """Rows that repeat throughout, shares of none and all, and a plan in which no shuffle carries the rows' columns
    but the one of the shared bucket, behind its filter."""
    rows = [(i % 3 if i % 3 else None, i // 4, f"text {i // 4}") for i in range(400)]
    df = spark.createDataFrame(rows, "label int, id long, text string").repartition(3)
    for share in (0.0, 0.2, 0.33, 1.0):
        s = assign_split(df, "label", "id", test_size=share, prefix_len=1)
        n = stratified_rank(df, "label", "id", prefix_len=1)
        want = n.withColumn("is_test", F.col("_rank") <= F.ceil(F.lit(share) * F.col("_class_n")))
        assert sorted(map(str, s.collect())) == sorted(map(str, want.select("label", "id", "text", "is_test").collect()))
    plan = s._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [i for i, line in enumerate(plan) if "Window [row_number()" in line]
    assert len(windows) == 1 and any("Filter" in line and "_cut" in line for line in plan[windows[0]:])
