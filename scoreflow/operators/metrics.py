"""Classification metrics as DataFrame aggregates (exact, distributed).

* accuracy / precision / recall / F1 come from one confusion-count
  aggregation (partial/final hash aggregate, any data size);
* ROC-AUC is exact with ties counted half.  Scores are first collapsed to
  (score, positives, negatives); the running count of negatives below each
  score comes from ``running_totals`` (range partitions and their offsets), on one
  path for all sizes.  A NULL or NaN score ranks below every other score.  The
  numerator is a decimal(38, 0), so it neither overflows nor depends on the order
  of summation;
* log loss clips probabilities to [eps, 1 - eps] with eps = float64 machine
  epsilon.

Every function accepts ``by`` columns (fold, model ...) and returns one row
per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreflow.functions.ranges import running_totals

EPS = 2.220446049250313e-16
DIGITS = 6
METRIC_NAMES = ["accuracy", "recall", "precision", "f1", "roc_auc", "log_loss"]

def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _counts(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [F.sum(c.cast("long")).alias(n) for n, c in (
        ("tp", (y == 1) & (p == 1)), ("fp", (y != 1) & (p == 1)), ("fn", (y == 1) & (p != 1)), ("tn", (y != 1) & (p != 1)))]


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (positive class 1) per group."""
    return df.groupBy(*by).agg(*_counts(label, pred))


def rates_from_confusion(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Zero-division -> 0, like the reference's scorers."""
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return {
        "accuracy": _safe_div(tp + tn, tp + fp + fn + tn),
        "recall": recall,
        "precision": precision,
        "f1": _safe_div(2 * tp, 2 * tp + fp + fn),
    }


def _score(score: str) -> Column:
    s = F.col(score).cast("double")
    return F.when(F.isnan(s), F.lit(None)).otherwise(s)


def _ranked_auc(ranked: DataFrame, by: Sequence[str]) -> tuple[Column, Column, Column]:
    """Aggregates of the rows of ``running_totals``: twice the pairs won, positives, negatives."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    won = (wide("_pos") * (2 * F.col("_neg_before") + F.col("_neg")).cast("decimal(18,0)")).cast("decimal(38,0)")
    return F.sum(won), F.sum("_pos"), F.sum("_neg")


def _auc(won: Column, pos: Column, neg: Column) -> Column:
    """NULL when a group has one class only."""
    return F.when((pos == 0) | (neg == 0), F.lit(None).cast("double")).otherwise(
        won.cast("double") / (F.lit(2.0) * pos.cast("double") * neg.cast("double")))


def _classes(label: str) -> list[Column]:
    y = F.col(label)
    return [F.coalesce(F.sum((y == 1).cast("long")), F.lit(0)).alias("_pos"),
            F.coalesce(F.sum((y != 1).cast("long")), F.lit(0)).alias("_neg")]


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), name: str = "roc_auc") -> DataFrame:
    """Exact ROC-AUC per group (NULL when a group has one class only; rows without a label don't
    count).  ``df`` is evaluated once; the NULL group is a group."""
    by = list(by)
    g = df.groupBy(*by, _score(score).alias("_s")).agg(*_classes(label))
    ranked = running_totals(g, by, "_s", ["_neg"])
    won, pos, neg = _ranked_auc(ranked, by)
    out = ranked.groupBy(*by).agg(won.alias("_won"), pos.alias("_P"), neg.alias("_N"))
    return out.select(*by, _auc(F.col("_won"), F.col("_P"), F.col("_N")).alias(name))


def _row_loss(label: str, prob: str) -> Column:
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(EPS)), F.lit(1.0 - EPS))
    return -F.log(F.when(F.col(label) == 1, p).otherwise(F.lit(1.0) - p))


def log_loss(df: DataFrame, label: str, prob: str, by: Sequence[str] = (),
             name: str = "log_loss") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(_row_loss(label, prob)).alias(name))


def binary_metrics(df: DataFrame, label: str, pred: str, prob: str | None = None,
                   by: Sequence[str] = (), prefix: str = "", digits: int = DIGITS,
                   score: str | None = None) -> DataFrame:
    """accuracy, recall, precision, f1 (+ roc_auc, log_loss with ``prob``).

    ``score`` (default ``prob``) ranks rows for ROC-AUC; any strictly
    increasing function of the probability (e.g. the margin) gives the same
    AUC without depending on the last bit of ``exp``.
    """
    by = list(by)
    counts = ["tp", "fp", "fn", "tn"]
    rates = rates_from_confusion(*[F.col(c) for c in counts])
    rounded = [F.round(e, digits).alias(prefix + k) for k, e in rates.items()]
    if prob is None:
        return confusion(df, label, pred, by).select(*by, *rounded)
    # every measure but the rank adds up, so one pass collapses the rows to distinct scores
    loss = _row_loss(label, prob)
    g = df.groupBy(*by, _score(score or prob).alias("_s")).agg(
        *_classes(label), *_counts(label, pred), F.sum(loss).alias("_loss"), F.count(loss).alias("_losses"))
    ranked = running_totals(g, by, "_s", ["_neg"])
    won, pos, neg = _ranked_auc(ranked, by)
    out = ranked.groupBy(*by).agg(won.alias("_won"), pos.alias("_P"), neg.alias("_N"), *[F.sum(c).alias(c) for c in counts],
                                  (F.sum("_loss") / F.sum("_losses")).alias("_mean_loss"))
    return out.select(*by, *rounded, F.round(_auc(F.col("_won"), F.col("_P"), F.col("_N")), digits).alias(prefix + "roc_auc"),
                      F.round("_mean_loss", digits).alias(prefix + "log_loss"))


def classification_report(df: DataFrame, label: str, pred: str,
                          class_names: Sequence[str] = ("negative", "positive"),
                          digits: int = DIGITS) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted avg."""
    c = confusion(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    pos = rates_from_confusion(tp, fp, fn, tn)
    neg = rates_from_confusion(tn, fn, fp, tp)  # class 0 as the positive class
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1

    def row(name, p, r, f, s):
        rr = lambda e: F.round(e, digits) if e is not None else F.lit(None).cast("double")
        return F.struct(F.lit(name).alias("row"), rr(p).alias("precision"), rr(r).alias("recall"),
                        rr(f).alias("f1_score"), s.cast("long").alias("support"))

    w0, w1 = _safe_div(s0, n), _safe_div(s1, n)
    rows = F.array(
        row(class_names[0], neg["precision"], neg["recall"], neg["f1"], s0),
        row(class_names[1], pos["precision"], pos["recall"], pos["f1"], s1),
        row("accuracy", None, None, pos["accuracy"], n),
        row("macro avg", (neg["precision"] + pos["precision"]) / 2,
            (neg["recall"] + pos["recall"]) / 2, (neg["f1"] + pos["f1"]) / 2, n),
        row("weighted avg", w0 * neg["precision"] + w1 * pos["precision"],
            w0 * neg["recall"] + w1 * pos["recall"], w0 * neg["f1"] + w1 * pos["f1"], n))
    return c.select(F.explode(rows).alias("r")).select("r.*")


def cv_summary(fold_metrics: DataFrame, metric_cols: Sequence[str], fold_col: str = "fold",
               by: Sequence[str] = (), digits: int = DIGITS) -> DataFrame:
    """Mean and population std of each metric over folds (``cv_<m>_mean/std``)."""
    aggs = []
    for m in metric_cols:
        aggs += [F.round(F.avg(m), digits).alias(f"cv_{m}_mean"),
                 F.round(F.stddev_pop(m), digits).alias(f"cv_{m}_std")]
    return fold_metrics.groupBy(*by).agg(*aggs)


def metric_map(df: DataFrame, metric_cols: Sequence[str], prefix: str = "",
               keep: Sequence[str] = ()) -> DataFrame:
    """Pack metric columns into ``map<string,double>`` with prefixed keys."""
    m = F.create_map(*[x for c in metric_cols for x in (F.lit(c), F.col(c).cast("double"))])
    if prefix:
        m = F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix), k))
    return df.select(*keep, m.alias("metrics"))
