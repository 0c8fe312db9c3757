"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver); the ``train_*`` queries return one metrics
row, which is reported under "quality" (test-split metrics of the model).
The feature model is fit once up front ("fit_features") and reused by the
scoring queries, as a user would.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stratified_split", "stratified_folds", "age_median_by_title", "fare_bins", "feature_matrix",
    "native_cat_features", "standard_scale", "title_score_summary", "binary_metrics", "roc_auc",
    "classification_report", "cv_summary", "predictions_table", "prediction_summary",
    "top10_predictions", "validate_records", "reject_reasons", "json_records", "run_metrics",
    "best_run", "soft_vote", "stream_scores", "response_totals", "csv_roundtrip",
    "train_logistic_regression", "train_adaboost",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from scoreflow.session import get_session
    from scoreflow.plans import catalog as C

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="scoreflow-bench")
    only = [q for q in sys.argv[1:]] or HEADLINE
    times: dict[str, float] = {}
    t0 = time.time()
    C.fitted_features(spark, sf_dir)
    times["fit_features"] = round(time.time() - t0, 3)
    quality: dict[str, dict] = {}
    for name in only:
        t = time.time()
        df = C.REGISTRY[name](spark, sf_dir)
        if name.startswith("train_"):  # one metrics row: keep it as model quality
            row = df.collect()[0].asDict()
            quality[row.pop("model")] = row
        else:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": int(cpus), "quality": quality}))


if __name__ == "__main__":
    main()
