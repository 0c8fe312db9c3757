"""Training: stage 1 (base parameters), stage 2 (search), ensembles, registry.

Every fit is a ``pyspark.ml`` Pipeline whose first stage is the feature
estimator, so cross-validation refits the imputation/binning statistics on
each fold's training rows (no leakage).  Folds come from the exact
stratified fold assignment; test rows never reach a fit.  Independent fits
run concurrently from a small driver thread pool (Spark schedules their
jobs side by side); rows never leave the executors -- only fitted models and
metric rows do.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreflow.operators import ensemble as E
from scoreflow.operators import metrics as M
from scoreflow.operators.features import persisted
from scoreflow.operators.learners import (BASE_PARAMS, acting_params, build_stages, positive_probability,
                                          search_space)
from scoreflow.operators.newton_logistic import NewtonLogistic
from scoreflow.operators.splits import assign_folds
from scoreflow.operators.tuning import sample_params


@dataclass
class TrainConfig:
    id_col: str = "subject_id"
    label: str = "label"
    folds: int = 5
    seed: int = 42
    n_trials: int = 5
    metric: str = "roc_auc"
    parallelism: int = 4
    timeout_sec: float | None = None  # stop starting new trials after this long
    overrides: dict = field(default_factory=dict)  # learner -> params merged over base


def fit_learner(name: str, params: dict, train: DataFrame, n_train: int,
                cfg: TrainConfig) -> PipelineModel:
    stages = build_stages(name, params, n_train=n_train, id_col=cfg.id_col, label=cfg.label,
                          seed=cfg.seed)
    return Pipeline(stages=stages).fit(train)


def test_metrics(model: PipelineModel, test: DataFrame, cfg: TrainConfig) -> dict:
    s = positive_probability(model.transform(test))
    return M.binary_metrics(s, cfg.label, "pred", "prob").collect()[0].asDict()


def _fold_sizes(folded: DataFrame) -> dict[int, int]:
    return {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count("*").alias("n")).collect()}


def validate_folds(fit, folded: DataFrame, cfg: TrainConfig) -> list[dict]:
    """``fit(train rows, their number)`` once per fold on the other folds, features refit too; metrics
    per fold.  Folds are fitted side by side."""
    sizes = _fold_sizes(folded)
    total = sum(sizes.values())

    def one(i):
        m = fit(folded.where(F.col("fold") != i), total - sizes.get(i, 0))
        return positive_probability(m.transform(folded.where(F.col("fold") == i))).select("fold", cfg.label, "prob", "pred")

    with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
        parts = list(pool.map(one, range(cfg.folds)))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return [r.asDict() for r in
            M.binary_metrics(allp, cfg.label, "pred", "prob", by=["fold"]).collect()]


def cross_validate(name: str, params: dict, folded: DataFrame, cfg: TrainConfig) -> list[dict]:
    """k refits of one learner."""
    return validate_folds(lambda tr, n: fit_learner(name, params, tr, n, cfg), folded, cfg)


def summarise(fold_rows: list[dict]) -> dict:
    import statistics
    out = {}
    for m in M.METRIC_NAMES:
        vals = [r[m] for r in fold_rows if r.get(m) is not None]
        if vals:
            out[f"cv_{m}_mean"] = round(statistics.fmean(vals), 6)
            out[f"cv_{m}_std"] = round(statistics.pstdev(vals), 6)
    return out


@dataclass
class RunResult:
    run_id: str
    stage: str
    model: str
    params: dict
    metrics: dict
    fitted: PipelineModel | None = None
    duration_sec: float = 0.0
    parent_run_id: str | None = None
    model_path: str | None = None


def _one_run(stage: str, name: str, params: dict, train: DataFrame, folded: DataFrame,
             test: DataFrame, n_train: int, cfg: TrainConfig) -> RunResult:
    t0 = time.time()
    cv = summarise(cross_validate(name, params, folded, cfg))
    model = fit_learner(name, params, train, n_train, cfg)
    tm = {f"test_{k}": v for k, v in test_metrics(model, test, cfg).items()}
    key = f"{stage}__{name.lower().replace(' ', '_')}"
    return RunResult(key, stage, name, acting_params(name, params), {**cv, **tm}, model, time.time() - t0)


def stage1(train: DataFrame, test: DataFrame, learners: Sequence[str],
           cfg: TrainConfig) -> list[RunResult]:
    """Base parameters, CV for every learner, test metrics."""
    with persisted(test) as test, persisted(assign_folds(train, cfg.label, cfg.id_col, cfg.folds, cfg.seed)) as fo:
            tr, n = fo.drop("fold"), fo.count()
            with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
                futs = [pool.submit(_one_run, "stage1", name,
                                    {**BASE_PARAMS.get(name, {}), **cfg.overrides.get(name, {})},
                                    tr, fo, test, n, cfg) for name in learners]
                return [f.result() for f in futs]


def stage2(train: DataFrame, test: DataFrame, learners: Sequence[str],
           cfg: TrainConfig, trial_runs: list | None = None) -> list[RunResult]:
    """Random search: n trials per learner scored by mean CV metric; the best
    trial is refit on the full training rows and tested once.  Trials are
    appended to ``trial_runs`` as child runs of the learner's stage-2 run;
    with ``timeout_sec`` no new trial starts after the deadline."""
    out = []
    with persisted(test) as test, persisted(assign_folds(train, cfg.label, cfg.id_col, cfg.folds, cfg.seed)) as fo:
            tr, n = fo.drop("fold"), fo.count()
            for name in learners:
                trials = sample_params(name, search_space(name), cfg.n_trials, cfg.seed)
                base = {**BASE_PARAMS.get(name, {}), **cfg.overrides.get(name, {})}
                parent = f"stage2__{name}"
                deadline = time.time() + cfg.timeout_sec if cfg.timeout_sec else None

                def score(i_t, base=base, name=name, deadline=deadline, parent=parent):
                    i, t = i_t
                    if deadline is not None and time.time() > deadline:
                        return None
                    t0 = time.time()
                    p = {**base, **t}
                    cv = summarise(cross_validate(name, p, fo, cfg))
                    run = RunResult(f"{parent}__trial_{i}", "stage2_trial", name, acting_params(name, p), cv, None,
                                    time.time() - t0, parent)
                    return cv.get(f"cv_{cfg.metric}_mean", float("-inf")), p, run

                with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
                    results = [r for r in pool.map(score, enumerate(trials)) if r is not None]
                if not results:
                    continue
                if trial_runs is not None:
                    trial_runs.extend(r[2] for r in results)
                best_i = max(range(len(results)), key=lambda i: (results[i][0], -i))
                best_score, best_p, _ = results[best_i]
                t0 = time.time()
                model = fit_learner(name, best_p, tr, n, cfg)
                tm = {f"test_{k}": v for k, v in test_metrics(model, test, cfg).items()}
                out.append(RunResult(parent, "stage2", name, acting_params(name, best_p),
                                     {f"best_cv_{cfg.metric}": best_score, **tm}, model,
                                     time.time() - t0))
    return out


def fit_voting(specs: dict[str, dict], train: DataFrame, n: int, cfg: TrainConfig) -> E.EnsembleModel:
    return E.EnsembleModel({nm: fit_learner(nm, p, train, n, cfg) for nm, p in specs.items()})


def out_of_fold(specs: dict[str, dict], folded: DataFrame, n: int, cfg: TrainConfig) -> DataFrame:
    """Every row of ``folded`` (with ``fold``) scored by members that were fitted on the other folds: id, fold, label and one
    column per member."""
    sizes = _fold_sizes(folded)

    def one(i):
        ms = fit_voting(specs, folded.where(F.col("fold") != i), n - sizes.get(i, 0), cfg)
        return ms.member_columns(folded.where(F.col("fold") == i)).select(cfg.id_col, "fold", cfg.label, *ms.member_names)

    with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
        parts = list(pool.map(one, range(cfg.folds)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_stacking(specs: dict[str, dict], train: DataFrame, n: int, cfg: TrainConfig) -> E.EnsembleModel:
    """Out-of-fold member probabilities -> logistic meta-learner; members refit on all rows."""
    inner = train.drop("fold")
    with persisted(assign_folds(inner, cfg.label, cfg.id_col, cfg.folds, cfg.seed)) as folded:
        oof = out_of_fold(specs, folded, n, cfg)
        names = [f"_member_{i}" for i in range(len(specs))]
        meta = Pipeline(stages=[NewtonLogistic(featureCols=names, labelCol=cfg.label)]).fit(oof)
    return E.EnsembleModel(fit_voting(specs, train, n, cfg).members, meta)


def ensemble_run(kind: str, specs: dict[str, dict], train: DataFrame, test: DataFrame, cfg: TrainConfig) -> RunResult:
    """``voting`` or ``stacking`` of members (learner -> parameters): cross-validated with all members
    refit per fold, fitted on all training rows, tested once."""
    fit = {"voting": fit_voting, "stacking": fit_stacking}[kind]
    t0 = time.time()
    with persisted(assign_folds(train, cfg.label, cfg.id_col, cfg.folds, cfg.seed)) as folded:
        cv = summarise(validate_folds(lambda tr, n: fit(specs, tr, n, cfg), folded, cfg))
        model = fit(specs, folded.drop("fold"), folded.count(), cfg)
    tm = {f"test_{k}": v for k, v in test_metrics(model, test, cfg).items()}
    return RunResult(f"ensemble__{kind}", "ensemble", kind, {"members": ",".join(specs)}, {**cv, **tm}, model, time.time() - t0)


def runs_frame(spark: SparkSession, results: Sequence[RunResult]) -> DataFrame:
    rows = [(r.run_id, r.stage, r.model, r.parent_run_id, {k: str(v) for k, v in r.params.items()},
             {k: float(v) for k, v in r.metrics.items() if v is not None}, {"stage": r.stage},
             float(r.duration_sec), r.model_path) for r in results]
    from scoreflow.plans.tracking import RUNS_SCHEMA
    return spark.createDataFrame(rows, RUNS_SCHEMA)
