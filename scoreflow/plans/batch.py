"""Batch scoring: read -> conform -> transform -> predictions -> summary.

The predictions table keeps a few source columns, the class, the rounded
probability, the confidence band (from the unrounded probability), model
name/version and the write time.  Summaries are single global aggregates
over the written table (partial aggregation on every partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions import scalars as S

SOURCE_COLS = ["subject_id", "tier", "sex", "age", "fare"]


def predictions_table(df: DataFrame, id_col: str, pred: str, prob: str, model_name: str,
                      model_version: str, source_cols=None, with_time: bool = True) -> DataFrame:
    src = list(source_cols or [c for c in SOURCE_COLS if c in df.columns])
    if id_col not in src:
        src = [id_col] + src
    cols = [*src,
            F.col(pred).cast("int").alias("pred"),
            F.round(F.col(prob).cast("double"), 4).alias("prob"),
            S.confidence(F.col(prob)).alias("confidence"),
            F.lit(model_name).alias("model_name"),
            F.lit(str(model_version)).alias("model_version")]
    if with_time:
        cols.append(F.current_timestamp().alias("predicted_at"))
    return df.select(*cols)


def surrogate_probability(pred: str, positive: float = 0.85) -> F.Column:
    """Class-only models: fixed surrogate probability (opt-in)."""
    return F.when(F.col(pred) == 1, F.lit(positive)).otherwise(F.lit(1.0 - positive))


def prediction_summary(pred_table: DataFrame, pred: str = "pred", prob: str = "prob") -> DataFrame:
    n = F.count(F.lit(1))
    pos = F.sum(F.col(pred)).cast("long")
    cols = [n.alias("total"), pos.alias("positive"), (n - pos).alias("negative"),
            F.round(F.avg(prob) * 100, 2).alias("avg_prob_pct"),
            F.round(pos * F.lit(100.0) / F.nullif(n, F.lit(0)), 2).alias("positive_rate_pct")]
    if "predicted_at" in pred_table.columns:
        cols.append(F.max("predicted_at").alias("last_run"))
    return pred_table.agg(*cols)


def confidence_distribution(pred_table: DataFrame, band: str = "confidence") -> DataFrame:
    """Always three rows (High, Medium, Low), zero counts included."""
    b = F.col(band)
    one = pred_table.agg(*[F.sum((b == lvl).cast("long")).alias(lvl)
                           for lvl in ("High", "Medium", "Low")])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(lvl).alias("confidence"), F.coalesce(F.col(lvl), F.lit(0)).alias("n"))
        for lvl in ("High", "Medium", "Low")])).alias("r")).select("r.*")


def run_report(pred_table: DataFrame, model_name: str, model_version: str,
               pred: str = "pred", prob: str = "prob", band: str = "confidence") -> DataFrame:
    """One-row run summary: totals, rates, band counts, run time (UTC text).

    A single global aggregate over the predictions table; the row is what a
    report renders (the rendering itself is a few driver-side lines).
    """
    n = F.count(F.lit(1))
    pos = F.sum(F.col(pred)).cast("long")
    b = F.col(band)
    return pred_table.agg(
        n.alias("total"), pos.alias("positive"), (n - pos).alias("negative"),
        F.round(pos * F.lit(100.0) / F.nullif(n, F.lit(0)), 2).alias("positive_rate_pct"),
        F.round(F.avg(prob) * 100, 2).alias("avg_prob_pct"),
        *[F.sum((b == lvl).cast("long")).alias(f"n_{lvl.lower()}") for lvl in ("High", "Medium", "Low")]
    ).select("*", F.lit(model_name).alias("model_name"), F.lit(str(model_version)).alias("model_version"),
             F.concat(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm"), F.lit(" UTC"))
             .alias("run_time"))


def top_predictions(pred_table: DataFrame, id_col: str, k: int = 10) -> DataFrame:
    """Top-k by probability (ties by id): TakeOrderedAndProject, no full sort."""
    cols = [c for c in (id_col, "sex", "tier", "pred", "prob", "confidence")
            if c in pred_table.columns]
    return pred_table.orderBy(F.col("prob").desc(), F.col(id_col)).limit(k).select(*cols)


def share_text(pred_table: DataFrame, pred: str = "pred") -> DataFrame:
    """'n/N positive (x.y%)' line of the run log, as a one-row frame."""
    n = F.count(F.lit(1))
    pos = F.sum(F.col(pred))
    return pred_table.agg(F.format_string("%d/%d positive (%s)", pos, n,
                                          S.percent_text(pos / F.nullif(n, F.lit(0)))).alias("text"))


def responses(scored: DataFrame, request_id: str, index_col: str, pred: str, prob: str,
              model_name: str, model_source: str = "local_fallback") -> DataFrame:
    """Per request: sorted prediction items, totals and the JSON body.

    ``collect_list`` is per request, so its size is bounded by the request's
    record count (a client payload), never by the data.
    """
    item = F.struct(F.col(index_col).cast("long").alias("passenger_index"),
                    F.col(pred).cast("int").alias("survived"),
                    F.round(F.col(prob).cast("double"), 4).alias("probability"),
                    S.confidence(F.col(prob)).alias("confidence"))
    g = scored.groupBy(request_id).agg(
        F.sort_array(F.collect_list(item)).alias("predictions"),
        F.count(F.lit(1)).alias("total_passengers"),
        F.sum(F.col(pred).cast("long")).alias("survived_count"))
    body = F.to_json(F.struct("predictions", "total_passengers", "survived_count",
                              F.lit(model_name).alias("model_name"), F.lit(model_source).alias("model_source")))
    return g.select(request_id, "total_passengers", "survived_count", body.alias("body"))


def run_batch(spark, source: DataFrame, model, id_col: str, out_path: str, model_name: str,
              model_version: str, prob_col: str = "probability") -> DataFrame:
    """Score ``source`` with a fitted PipelineModel and overwrite ``out_path``.

    Spark's overwrite deletes first, so a reader of the folder may see a gap (``files.full_refresh`` leaves none);
    a retry writes the same rows.  The summary is recomputed from the written table.
    """
    from pyspark.ml.functions import vector_to_array

    from scoreflow.operators.features import PASS_PREFIX

    # raw source columns ride through the pipeline under a prefix (no join back)
    src_cols = [c for c in SOURCE_COLS if c in source.columns and c != id_col]
    tagged = source.select("*", *[F.col(c).alias(PASS_PREFIX + c) for c in src_cols])
    scored = model.transform(tagged)
    p1 = vector_to_array(F.col(prob_col))[1]
    scored = scored.select(id_col, *[F.col(PASS_PREFIX + c).alias(c) for c in src_cols],
                           p1.alias("_p1"), F.col("prediction").cast("int").alias("_pred"))
    table = predictions_table(scored, id_col, "_pred", "_p1", model_name, model_version)
    table.write.mode("overwrite").parquet(out_path)
    return prediction_summary(spark.read.parquet(out_path))
