import json

import pytest

from pyspark.sql import functions as F

from scoreflow import cli
from scoreflow.operators.ensemble import load_model
from scoreflow.plans import catalog as C
from scoreflow.plans import tracking as TR
from scoreflow.sources import files as FS
from tests.conftest import SF_SMALL


def test_train_then_score(spark, tmp_path, capsys):
    home = str(tmp_path / "home")
    cli.main(["train", "--sf-dir", SF_SMALL, "--home", home, "--learners", "logistic_regression",
              "--folds", "2"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["best_run"].startswith("stage1__logistic_regression__") and out["version"] == "1"
    csv = str(tmp_path / "in_csv")
    FS.write_csv(C.subjects(spark, SF_SMALL).drop("label"), csv)
    cli.main(["score", "--input", csv, "--home", home, "--out", str(tmp_path / "preds"),
              "--csv", str(tmp_path / "preds_csv")])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    preds = spark.read.parquet(str(tmp_path / "preds"))
    assert summary["total"] == preds.count() == 1500
    raw = C.subjects(spark, SF_SMALL).select("subject_id", F.col("fare").alias("raw_fare"))
    assert preds.join(raw, "subject_id").where(~F.col("fare").eqNullSafe(F.col("raw_fare"))).count() == 0
    assert {r["model_version"] for r in preds.select("model_version").distinct().collect()} == {"1"}
    back = spark.read.option("header", True).csv(str(tmp_path / "preds_csv"))
    assert back.columns == ["subject_id", "pred", "prob"] and back.count() == 1500
    # a second train leaves the files of the first alone
    first = TR.read_runs(spark, f"{home}/runs").first()["model_path"]
    before = load_model(first, spark).stages[-1].coefficients
    cli.main(["train", "--sf-dir", SF_SMALL, "--home", home, "--learners", "logistic_regression", "--folds", "2"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert load_model(first, spark).stages[-1].coefficients == before
    runs = TR.read_runs(spark, f"{home}/runs")
    assert runs.count() == 2 == runs.select("run_id").distinct().count()
    # registering the same run again adds no version
    same = TR.register_and_promote(spark, f"{home}/model_versions", "best-model", out["best_run"])
    assert same == out["version"] == str(TR.read_versions(spark, f"{home}/model_versions").count())


def test_unreadable_registry_raises(spark, tmp_path):
    (tmp_path / "v" / "snapshot-000000000000").mkdir(parents=True)
    (tmp_path / "v" / "snapshot-000000000000" / "_SUCCESS").touch()
    (tmp_path / "v" / "snapshot-000000000000" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        TR.register_and_promote(spark, str(tmp_path / "v"), "m", "r")
    assert TR.read_versions(spark, str(tmp_path / "none")).count() == 0
