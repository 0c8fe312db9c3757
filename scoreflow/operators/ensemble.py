"""Ensembles over member probabilities.

Member outputs are kept in long format (id, member, prob): the soft vote is
then a grouped mean -- a partial/final hash aggregate on the id -- instead of
a chain of wide joins, and a missing member for some id simply does not
contribute.  Stacking builds out-of-fold member probabilities (every row is
scored by members that never saw it) and fits a logistic meta-learner on
them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.operators.features import PASS_PREFIX
from scoreflow.operators.learners import positive_probability


def select_members(available: Sequence[str], wanted: Sequence[str], minimum: int = 2) -> list[str]:
    """Wanted members that exist; fewer than ``minimum`` -> no ensemble."""
    have = set(available)
    chosen = [m for m in wanted if m in have]
    return chosen if len(chosen) >= minimum else []


def soft_vote(long_probs: DataFrame, id_col: str, prob_col: str = "prob",
              member_col: str = "member", members: Sequence[str] | None = None,
              threshold: float = 0.5) -> DataFrame:
    """Mean member probability per id; class 1 only when the mean exceeds
    ``threshold`` (a tie goes to class 0, like argmax over [p0, p1])."""
    src = long_probs if members is None else long_probs.where(F.col(member_col).isin(*members))
    agg = src.groupBy(id_col).agg(F.avg(F.col(prob_col).cast("double")).alias("vote_prob"),
                                  F.count(F.lit(1)).alias("n_members"))
    return agg.withColumn("vote_pred", (F.col("vote_prob") > threshold).cast("int"))


class EnsembleModel:
    """Fitted members scored side by side: their mean probability, or a logistic meta-learner on their
    probabilities.  Members run one after another on the same rows, whose columns ride along under a
    prefix, so scoring needs no join.  Saved as a folder of Spark models and a one-row description."""

    def __init__(self, members: dict, meta=None):
        self.members, self.meta = dict(members), meta

    @property
    def member_names(self) -> list[str]:
        return [f"_member_{i}" for i in range(len(self.members))]

    def member_columns(self, df: DataFrame) -> DataFrame:
        """``df`` with the probability of every member."""
        raw = df.columns
        cur = df.select(*[F.col(c).alias(PASS_PREFIX + c) for c in raw])
        probs = []
        for i, model in enumerate(self.members.values()):
            restored = cur.select("*", *[F.col(PASS_PREFIX + c).alias(c) for c in raw])
            scored = positive_probability(model.transform(restored))
            carried = [c for c in scored.columns if c.startswith(PASS_PREFIX)]
            probs.append(f"{PASS_PREFIX}_p{i}")
            cur = scored.select(*carried, F.col("prob").alias(probs[-1]))
        return cur.select(*[F.col(PASS_PREFIX + c).alias(c) for c in raw],
                          *[F.col(p).alias(n) for p, n in zip(probs, self.member_names)])

    def transform(self, df: DataFrame) -> DataFrame:
        out, names = self.member_columns(df), self.member_names
        if self.meta is not None:
            return self.meta.transform(out).drop(*names)
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
        return out.withColumn("probability", array_to_vector(F.array(1 - mean, mean))) \
            .withColumn("prediction", (mean > 0.5).cast("double")).drop(*names)

    def save(self, path: str, spark) -> None:
        for i, m in enumerate(self.members.values()):
            m.write().save(f"{path}/member-{i}")
        if self.meta is not None:
            self.meta.write().save(f"{path}/meta")
        spark.createDataFrame([(list(self.members), self.meta is not None)], "members array<string>, meta boolean") \
            .coalesce(1).write.json(f"{path}/ensemble")

    @staticmethod
    def load(path: str, spark) -> "EnsembleModel":
        d = spark.read.schema("members array<string>, meta boolean").json(f"{path}/ensemble").first()
        members = {n: PipelineModel.load(f"{path}/member-{i}") for i, n in enumerate(d["members"])}
        return EnsembleModel(members, PipelineModel.load(f"{path}/meta") if d["meta"] else None)


def save_model(model, path: str, spark) -> None:
    """A pipeline or an ensemble to a folder that must not exist yet."""
    if isinstance(model, EnsembleModel):
        model.save(path, spark)
    else:
        model.write().save(path)


def load_model(path: str, spark):
    """What ``save_model`` wrote."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/ensemble")
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return EnsembleModel.load(path, spark)
    return PipelineModel.load(path)
