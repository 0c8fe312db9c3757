"""Command line: train, score a file, or run the streaming scorer.

  python -m scoreflow.cli train  --sf-dir /root/testdata/sf0.01 --home /shared/scoreflow
  python -m scoreflow.cli score  --input data.csv --home /shared/scoreflow --out preds
  python -m scoreflow.cli stream --source in/ --home /shared/scoreflow --out preds --rejects rej

``--home`` holds the runs table, the model_versions table and saved
pipelines (a shared folder on a cluster).
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import functions as F


def _train(args, spark):
    from scoreflow.operators import ensemble as E
    from scoreflow.plans import catalog as C
    from scoreflow.plans import tracking as TR
    from scoreflow.plans import training as TRN

    split = C.split_subjects(spark, args.sf_dir)
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    cfg = TRN.TrainConfig(folds=args.folds, n_trials=args.trials, parallelism=args.parallelism)
    results, trials = TRN.stage1(train, test, args.learners, cfg), []
    if args.trials > 0:
        results += TRN.stage2(train, test, args.learners, cfg, trials)
    params = {r.model: r.params for r in results}  # tuned ones where there are any
    for kind, wanted in (("voting", args.voting), ("stacking", args.stacking)):
        members = E.select_members(list(params), wanted or [])
        if members:
            results.append(TRN.ensemble_run(kind, {m: params[m] for m in members}, train, test, cfg))
    # ids are unique per train, so folders are written once and older versions keep their files
    train_id = uuid.uuid4().hex[:12]
    for r in results + trials:
        r.run_id = f"{r.run_id}__{train_id}"
        r.parent_run_id = f"{r.parent_run_id}__{train_id}" if r.parent_run_id else None
        if r.fitted is not None:
            r.model_path = f"{args.home}/models/{r.run_id}"
            E.save_model(r.fitted, r.model_path, spark)
    TR.append_runs(TRN.runs_frame(spark, results + trials), f"{args.home}/runs")
    mine = TR.read_runs(spark, f"{args.home}/runs").where(F.col("model_path").isNotNull())
    best = TR.best_run(mine, "test_roc_auc").collect()[0]
    version = TR.register_and_promote(spark, f"{args.home}/model_versions", args.name,
                                      best["run_id"])
    print(json.dumps({"best_run": best["run_id"], "version": version,
                      "test_roc_auc": best["metrics"].get("test_roc_auc")}))


def _model(args, spark):
    from scoreflow.plans import tracking as TR

    row = TR.resolve_model(TR.read_versions(spark, f"{args.home}/model_versions"),
                           TR.read_runs(spark, f"{args.home}/runs"), args.name).collect()
    if not row:
        raise SystemExit("no model found (production, tuned or base)")
    from scoreflow.operators.ensemble import load_model

    path = row[0]["model_path"]
    return load_model(path, spark), path.rsplit("/", 1)[-1], row[0]["version"] or row[0]["source"]


def _score(args, spark):
    from scoreflow.operators import quality as Q
    from scoreflow.plans import batch as B
    from scoreflow.sources import files as FS

    model, run_id, version = _model(args, spark)
    src = FS.read_for_scoring(spark, args.input, FS_SCHEMA(), "label", "subject_id")
    src = Q.conform(src, keep_extra=True)
    summary = B.run_batch(spark, src, model, "subject_id", args.out, run_id, version)
    if args.csv:
        FS.write_csv(spark.read.parquet(args.out).select("subject_id", "pred", "prob"), args.csv)
    spark.read.parquet(args.out).orderBy("subject_id").show(20, truncate=False)
    print(json.dumps(summary.drop("last_run").collect()[0].asDict()))


def FS_SCHEMA():
    from scoreflow.plans.catalog import SUBJECT_SCHEMA
    return SUBJECT_SCHEMA


def _stream(args, spark):
    from scoreflow.operators.learners import positive_probability
    from scoreflow.plans import batch as B
    from scoreflow.streaming import scoring as STR

    model, run_id, version = _model(args, spark)

    from scoreflow.operators.features import PASS_PREFIX

    def score(records):
        tagged = records.select("*", F.col("request_id").alias(PASS_PREFIX + "request_id"),
                                F.lit(None).cast("int").alias("label"))
        s = positive_probability(model.transform(tagged)).select(
            F.col(PASS_PREFIX + "request_id").alias("request_id"),
            (F.col("subject_id") - 1).alias("passenger_index"), "pred", "prob")
        return B.predictions_table(s, "passenger_index", "pred", "prob", run_id,
                                   version, source_cols=["request_id", "passenger_index"])

    qs = STR.start_scoring(spark, args.source, score, args.out, args.rejects,
                           f"{args.home}/stream_checkpoints", available_now=not args.continuous)
    STR.run_to_completion(qs)


def main(argv=None):
    from scoreflow.session import get_session

    p = argparse.ArgumentParser(prog="scoreflow")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--sf-dir", required=True)
    t.add_argument("--home", required=True)
    t.add_argument("--learners", nargs="+", default=["logistic_regression", "random_forest"])
    t.add_argument("--trials", type=int, default=0)
    t.add_argument("--folds", type=int, default=5)
    t.add_argument("--parallelism", type=int, default=2)
    t.add_argument("--name", default="best-model")
    t.add_argument("--voting", nargs="*", help="members of a soft-voting ensemble")
    t.add_argument("--stacking", nargs="*", help="members of a stacked ensemble")
    s = sub.add_parser("score")
    s.add_argument("--input", required=True)
    s.add_argument("--home", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--csv", help="also write id, class and probability as CSV to this folder")
    s.add_argument("--name", default="best-model")
    st = sub.add_parser("stream")
    st.add_argument("--source", required=True)
    st.add_argument("--home", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--rejects", required=True)
    st.add_argument("--name", default="best-model")
    st.add_argument("--continuous", action="store_true")
    args = p.parse_args(argv)
    spark = get_session(args.master)
    {"train": _train, "score": _score, "stream": _stream}[args.cmd](args, spark)


if __name__ == "__main__":
    main()
