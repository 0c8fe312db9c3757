import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.operators.ensemble import select_members
from scoreflow.plans import batch as B
from scoreflow.plans import tracking as TR
from scoreflow.sources import files as FS
from scoreflow.session import shared_dir

SCHEMA = T.StructType([T.StructField("subject_id", T.LongType()),
                       T.StructField("label", T.IntegerType()),
                       T.StructField("tier", T.IntegerType()),
                       T.StructField("age", T.DoubleType()),
                       T.StructField("port", T.StringType())])


def _csv(tmp_path, text):
    p = tmp_path / "in.csv"
    p.write_text(text)
    return str(p)


def test_csv_na_tokens_and_schema(spark, tmp_path):
    path = _csv(tmp_path, "subject_id,label,tier,age,port\n1,1,3,22.5,S\n2,0,1,NA,\n"
                          "3,0,2,n/a,nan\n4,1,x,NaN,C\n")
    rows = {r["subject_id"]: r for r in FS.read_labelled(spark, path, SCHEMA, "label").collect()}
    assert rows[1]["age"] == 22.5 and rows[1]["port"] == "S"
    assert rows[2]["age"] is None and rows[2]["port"] is None
    assert rows[3]["age"] is None and rows[3]["port"] is None
    assert rows[4]["tier"] is None and rows[4]["port"] == "C"


def test_scoring_csv_drops_label_and_numbers_rows(spark, tmp_path):
    lines = ["label,tier,age,port"] + [f"{i % 2},{1 + i % 3},{20 + i},S" for i in range(50)]
    path = _csv(tmp_path, "\n".join(lines) + "\n")
    df = FS.read_for_scoring(spark, path, SCHEMA, "label", "subject_id")
    assert "label" not in df.columns
    ids = sorted(r[0] for r in df.select("subject_id").collect())
    assert ids == list(range(50))
    # scan order is kept: age = 20 + id
    assert df.where(F.col("age") != F.col("subject_id") + 20).count() == 0


def test_ingest_and_full_refresh(spark, tmp_path):
    path = _csv(tmp_path, "subject_id,label,tier,age,port\n1,1,3,22.5,S\n2,0,1,,C\n")
    FS.ensure_database(spark, "sf_test_db")
    FS.ensure_tables(spark, "sf_test_db", location=str(tmp_path / "tables"))
    n = FS.ingest_csv(spark, path, SCHEMA, "sf_test_db.test_data")
    assert n == 2
    assert FS.ingest_csv(spark, path, SCHEMA, "sf_test_db.test_data") == 2  # refresh, not append
    out = str(tmp_path / "preds_csv")
    FS.write_csv(spark.table("sf_test_db.test_data"), out, ["subject_id", "age"])
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["subject_id", "age"] and back.count() == 2


def test_line_ids_over_many_files(spark, tmp_path):
    """Three files, each read in several splits; ids are line numbers, files in order of their names."""
    folder = tmp_path / "many"
    folder.mkdir()
    line = 0
    for name in ("b.csv", "a.csv", "c.csv"):
        (folder / name).write_text("")
    for name in ("a.csv", "b.csv", "c.csv"):
        text = "tier,age,port\n"
        for _ in range(400):
            text += f"{line % 3 + 1},{line}.0,S\n"
            line += 1
        (folder / name).write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = FS.read_for_scoring(spark, str(folder), SCHEMA, "label", "subject_id")
        rows = df.collect()
        assert sorted(r["subject_id"] for r in rows) == list(range(1200))
        assert all(r["age"] == r["subject_id"] for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_readers_see_old_or_new_rows(spark, tmp_path):
    FS.ensure_database(spark, "sf_refresh_db")
    FS.ensure_tables(spark, "sf_refresh_db", location=str(tmp_path / "tables"))
    table = "sf_refresh_db.test_data"
    one = spark.createDataFrame([(1, 2)], "subject_id long, tier int")
    assert FS.full_refresh(spark, one, table) == 1
    before = spark.table(table).select("subject_id")  # resolved before the refresh
    assert FS.full_refresh(spark, one.union(one.selectExpr("5L", "3")), table) == 2
    assert [r[0] for r in before.collect()] in ([1], [1, 5])
    assert spark.read.parquet(FS.table_location(spark, table)).count() == 2
    bad = one.withColumn("tier", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        FS.full_refresh(spark, bad, table)
    assert spark.table(table).count() == 2  # a failed write leaves the rows


def test_na_tokens_are_not_trimmed(spark, tmp_path):
    path = _csv(tmp_path, "subject_id,label,tier,age,port\n1,1,3,22.5, NA \n2,0,1,NA,NA\n")
    rows = {r["subject_id"]: r for r in FS.read_labelled(spark, path, SCHEMA, "label").collect()}
    assert rows[1]["port"] == " NA " and rows[2]["port"] is None and rows[2]["age"] is None


def test_responses_json_and_share_text(spark):
    rows = [(7, 1, 1, 0.91), (7, 2, 0, 0.30), (7, 3, 0, 0.55), (8, 1, 1, 0.62)]
    df = spark.createDataFrame(rows, "request_id long, idx long, pred int, prob double")
    r = {x["request_id"]: x for x in B.responses(df, "request_id", "idx", "pred", "prob",
                                                 "m1").collect()}
    body = json.loads(r[7]["body"])
    assert body["total_passengers"] == 3 and body["survived_count"] == 1
    assert [p["passenger_index"] for p in body["predictions"]] == [1, 2, 3]
    assert [p["confidence"] for p in body["predictions"]] == ["High", "Medium", "Low"]
    assert body["model_name"] == "m1"
    t = B.share_text(df).collect()[0][0]
    assert t == "2/4 positive (50.0%)"


def test_surrogate_probability_and_predictions_columns(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "subject_id long, pred int")
    s = df.withColumn("prob", B.surrogate_probability("pred"))
    out = B.predictions_table(s, "subject_id", "pred", "prob", "m", "3").collect()
    assert [r["prob"] for r in out] == [0.85, 0.15]
    assert all(r["confidence"] == "High" and r["model_version"] == "3" for r in out)
    assert out[0]["predicted_at"] is not None


def test_member_selection():
    assert select_members(["a", "b", "c"], ["b", "x", "c"]) == ["b", "c"]
    assert select_members(["a"], ["a", "x"]) == []


def test_resolve_model_order(spark):
    runs = spark.createDataFrame([
        ("stage1__lr", "stage1", "lr", None, {}, {"test_roc_auc": 0.8}, {}, 1.0, "/m/lr"),
        ("stage2__rf", "stage2", "rf", None, {}, {"test_roc_auc": 0.7}, {}, 1.0, "/m/rf"),
        ("stage2__gb", "stage2", "gb", None, {}, {"test_roc_auc": 0.9}, {}, 1.0, "/m/gb"),
    ], TR.RUNS_SCHEMA)
    versions = spark.createDataFrame([("best", "9", "stage1__lr", "Archived"),
                                      ("best", "10", "stage2__rf", "Production")], TR.VERSIONS_SCHEMA)
    assert TR.resolve_model(versions, runs, "best").collect()[0]["model_path"] == "/m/rf"
    none = versions.where("false")
    r = TR.resolve_model(none, runs, "best").collect()[0]
    assert (r["model_path"], r["source"]) == ("/m/gb", "tuned")
    r = TR.resolve_model(none, runs.where("stage = 'stage1'"), "best").collect()[0]
    assert r["source"] == "base"
    assert TR.latest_versions(versions).collect()[0]["version"] == "10"
    promoted = {r["version"]: r["stage"] for r in TR.promote_latest(
        versions.unionByName(spark.createDataFrame([("best", "11", "x", "None")],
                                                   TR.VERSIONS_SCHEMA))).collect()}
    assert promoted == {"9": "Archived", "10": "Archived", "11": "Production"}


def test_runs_table_roundtrip(spark):
    from scoreflow.plans.training import RunResult, runs_frame
    path = shared_dir(spark, "runs-test")
    r = [RunResult("stage1__lr", "stage1", "lr", {"C": 1.0}, {"test_roc_auc": 0.81}, None, 2.0)]
    for _ in range(3):  # a repeated write changes nothing
        TR.append_runs(runs_frame(spark, r), path)
    TR.append_runs(runs_frame(spark, [RunResult("stage1__mlp", "stage1", "mlp", {}, {}, None, 1.0)]), path)
    assert sorted(r["run_id"] for r in TR.read_runs(spark, path).collect()) == ["stage1__lr", "stage1__mlp"]
    back = TR.read_runs(spark, path).where("run_id = 'stage1__lr'").collect()
    assert back and back[-1]["metrics"]["test_roc_auc"] == 0.81 and back[-1]["params"]["C"] == "1.0"


def test_run_report(spark):
    import re
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 0, 0.55)], "subject_id long, pred int, prob double")
    t = B.predictions_table(df, "subject_id", "pred", "prob", "m", "2")
    r = B.run_report(t, "m", "2").collect()[0]
    assert (r["total"], r["positive"], r["negative"]) == (3, 1, 2)
    assert (r["n_high"], r["n_medium"], r["n_low"]) == (2, 0, 1)
    assert r["positive_rate_pct"] == 33.33 and re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2} UTC", r["run_time"])
