"""Leakage-free feature estimators (fit on training rows, apply anywhere).

``EncodedFeatures`` (12 numeric features) and ``NativeCategoricalFeatures``
(9 columns, strings kept for a categorical learner) are ``pyspark.ml``
Estimator/Model pairs.  ``fit`` runs a few distributed aggregations and keeps
only fitted statistics (a handful of numbers per title group), never rows;
``transform`` is a single projection of built-in expressions, so it is
pipelined into whatever scan or join feeds it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.functions import scalars as S
from scoreflow.functions.quantiles import exact_quantiles, mode_of

ENCODED_FEATURES = ["tier", "sex", "age", "sibsp", "parch", "fare", "port", "title",
                    "family_size", "alone", "age_band", "fare_cat"]
NATIVE_FEATURES = ["tier", "sex", "age", "sibsp", "parch", "fare", "port",
                   "family_size", "alone"]
NATIVE_CATEGORICAL = ["sex", "port", "tier"]
FARE_QUANTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
PASS_PREFIX = "_pass_"  # columns with this prefix ride through the feature stage unchanged


@contextmanager
def persisted(df: DataFrame):
    """Keep a projected input cached while several fit passes read it.

    MEMORY_AND_DISK: blocks of a lost executor are recomputed from lineage.
    """
    if df.storageLevel != StorageLevel(False, False, False, False, 1):
        yield df
        return
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()


class _InputCols(Params):
    tierCol = Param(Params._dummy(), "tierCol", "class / tier column", TypeConverters.toString)
    nameCol = Param(Params._dummy(), "nameCol", "full name column", TypeConverters.toString)
    sexCol = Param(Params._dummy(), "sexCol", "sex column", TypeConverters.toString)
    ageCol = Param(Params._dummy(), "ageCol", "age column", TypeConverters.toString)
    sibspCol = Param(Params._dummy(), "sibspCol", "siblings/spouses", TypeConverters.toString)
    parchCol = Param(Params._dummy(), "parchCol", "parents/children", TypeConverters.toString)
    fareCol = Param(Params._dummy(), "fareCol", "fare column", TypeConverters.toString)
    portCol = Param(Params._dummy(), "portCol", "port column", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "columns passed through (id, label)",
                     TypeConverters.toListString)
    float32 = Param(Params._dummy(), "float32", "cast features to float", TypeConverters.toBoolean)
    fallbackAge = Param(Params._dummy(), "fallbackAge", "age when nothing was learned",
                        TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(tierCol="tier", nameCol="full_name", sexCol="sex", ageCol="age",
                         sibspCol="sibsp", parchCol="parch", fareCol="fare", portCol="port",
                         keepCols=[], float32=False, fallbackAge=0.0)

    def _c(self, p):
        return F.col(self.getOrDefault(p))

    def _keep(self, df: DataFrame):
        keep = set(self.getOrDefault(self.keepCols))
        return [c for c in df.columns if c in keep or c.startswith(PASS_PREFIX)]


class _EncodedState(Params):
    titleKeys = Param(Params._dummy(), "titleKeys", "title groups with a learned age",
                      TypeConverters.toListString)
    titleAges = Param(Params._dummy(), "titleAges", "median age per title group",
                      TypeConverters.toListFloat)
    ageMedian = Param(Params._dummy(), "ageMedian", "global median age", TypeConverters.toFloat)
    fareMedian = Param(Params._dummy(), "fareMedian", "median fare", TypeConverters.toFloat)
    portMode = Param(Params._dummy(), "portMode", "most frequent port", TypeConverters.toString)
    fareEdges = Param(Params._dummy(), "fareEdges", "distinct fare quartile edges",
                      TypeConverters.toListFloat)


def _fit_medians(df: DataFrame, title, age, fare) -> dict:
    """All medians in one job: per-title age, global age, global fare.

    Rows are unpivoted to (key, value) and quantiles are computed per key;
    the number of keys is bounded by the title groups (+2).
    """
    long = df.select(F.explode(F.array(
        F.struct(F.concat(F.lit("age|"), title).alias("k"), age.cast("double").alias("v")),
        F.struct(F.lit("age").alias("k"), age.cast("double").alias("v")),
        F.struct(F.lit("fare").alias("k"), fare.cast("double").alias("v")))).alias("kv")
    ).select("kv.*")
    rows = exact_quantiles(long, "v", [0.5], ["m"], by=["k"]).collect()
    return {r["k"]: r["m"] for r in rows}


class EncodedFeaturesModel(Model, _InputCols, _EncodedState, DefaultParamsReadable,
                           DefaultParamsWritable):
    """Applies learned imputations, bins and codes; 12 named features."""

    def __init__(self):
        super().__init__()

    def fitted(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in
                (self.titleKeys, self.titleAges, self.ageMedian, self.fareMedian,
                 self.portMode, self.fareEdges) if self.isDefined(p)}

    def feature_exprs(self):
        title = S.title_group(self._c(self.nameCol))
        keys, ages = self.getOrDefault(self.titleKeys), self.getOrDefault(self.titleAges)
        learned = S.map_literal(dict(zip(keys, ages)))[title] if keys else F.lit(None)
        global_age = self.getOrDefault(self.ageMedian) if self.isDefined(self.ageMedian) else None
        age = F.coalesce(S.nan_to_null(self._c(self.ageCol)), learned.cast("double"),
                         F.lit(global_age).cast("double"),
                         F.lit(self.getOrDefault(self.fallbackAge)))
        fare_med = self.getOrDefault(self.fareMedian) if self.isDefined(self.fareMedian) else None
        fare = F.coalesce(S.nan_to_null(self._c(self.fareCol)), F.lit(fare_med).cast("double"))
        port = F.coalesce(self._c(self.portCol), F.lit(self.getOrDefault(self.portMode)))
        fam = S.family_size(self._c(self.sibspCol), self._c(self.parchCol))
        return {
            "tier": self._c(self.tierCol).cast("int"),
            "sex": S.encode(self._c(self.sexCol), S.SEX_CODES),
            "age": age,
            "sibsp": self._c(self.sibspCol).cast("int"),
            "parch": self._c(self.parchCol).cast("int"),
            "fare": fare,
            "port": S.encode(port, S.PORT_CODES),
            "title": S.encode(title, S.TITLE_CODES),
            "family_size": fam,
            "alone": S.alone(fam),
            "age_band": S.age_band(age),
            "fare_cat": S.fare_category(fare, self.getOrDefault(self.fareEdges)),
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = self.feature_exprs()
        f32 = self.getOrDefault(self.float32)
        cols = [(e.cast("float") if f32 else e).alias(n) for n, e in exprs.items()]
        return df.select(*self._keep(df), *cols)


class EncodedFeatures(Estimator, _InputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns per-title median age, medians, port mode and fare quartile edges."""

    @keyword_only
    def __init__(self, *, tierCol=None, nameCol=None, sexCol=None, ageCol=None, sibspCol=None,
                 parchCol=None, fareCol=None, portCol=None, keepCols=None, float32=None,
                 fallbackAge=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> EncodedFeaturesModel:
        needed = df.select(S.title_group(self._c(self.nameCol)).alias("_title"),
                           self._c(self.ageCol).alias("_age"),
                           self._c(self.fareCol).alias("_fare"),
                           self._c(self.portCol).alias("_port"))
        with persisted(needed) as d:
            med = _fit_medians(d, F.col("_title"), F.col("_age"), F.col("_fare"))
            port_rows = mode_of(d, "_port", "m").collect()
            fare_median = med.get("fare")
            filled = d.select(F.coalesce(S.nan_to_null("_fare"),
                                         F.lit(fare_median).cast("double")).alias("f"))
            edge_row = exact_quantiles(filled, "f", FARE_QUANTILES,
                                       [f"e{i}" for i in range(5)]).collect()
        edges = []
        if edge_row:
            for e in edge_row[0]:
                if e is not None and (not edges or e != edges[-1]):
                    edges.append(float(e))
        titles = sorted(k[4:] for k in med if k.startswith("age|") and med[k] is not None)
        m = EncodedFeaturesModel()
        self._copyValues(m)
        m._set(titleKeys=titles, titleAges=[float(med["age|" + t]) for t in titles],
               portMode=(port_rows[0]["m"] if port_rows else None) or "",
               fareEdges=edges)
        if med.get("age") is not None:
            m._set(ageMedian=float(med["age"]))
        if fare_median is not None:
            m._set(fareMedian=float(fare_median))
        return m


class NativeCategoricalFeaturesModel(Model, _InputCols, _EncodedState, DefaultParamsReadable,
                                     DefaultParamsWritable):
    """Light cleaning only: medians, port mode, strings kept, 9 columns."""

    def __init__(self):
        super().__init__()

    def feature_exprs(self):
        age_med = self.getOrDefault(self.ageMedian) if self.isDefined(self.ageMedian) else None
        fare_med = self.getOrDefault(self.fareMedian) if self.isDefined(self.fareMedian) else None
        fam = S.family_size(self._c(self.sibspCol), self._c(self.parchCol))
        return {
            "tier": self._c(self.tierCol).cast("string"),
            "sex": F.coalesce(self._c(self.sexCol).cast("string"), F.lit("nan")),
            "age": F.coalesce(S.nan_to_null(self._c(self.ageCol)), F.lit(age_med).cast("double")),
            "sibsp": self._c(self.sibspCol).cast("int"),
            "parch": self._c(self.parchCol).cast("int"),
            "fare": F.coalesce(S.nan_to_null(self._c(self.fareCol)),
                               F.lit(fare_med).cast("double")),
            "port": F.coalesce(self._c(self.portCol).cast("string"),
                               F.lit(self.getOrDefault(self.portMode))),
            "family_size": fam,
            "alone": S.alone(fam),
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*self._keep(df),
                         *[e.alias(n) for n, e in self.feature_exprs().items()])


class NativeCategoricalFeatures(Estimator, _InputCols, DefaultParamsReadable,
                                DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, tierCol=None, nameCol=None, sexCol=None, ageCol=None, sibspCol=None,
                 parchCol=None, fareCol=None, portCol=None, keepCols=None, float32=None,
                 fallbackAge=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> NativeCategoricalFeaturesModel:
        needed = df.select(self._c(self.ageCol).alias("_age"), self._c(self.fareCol).alias("_fare"),
                           self._c(self.portCol).alias("_port"))
        with persisted(needed) as d:
            long = d.select(F.explode(F.array(
                F.struct(F.lit("age").alias("k"), F.col("_age").cast("double").alias("v")),
                F.struct(F.lit("fare").alias("k"), F.col("_fare").cast("double").alias("v"))
            )).alias("kv")).select("kv.*")
            med = {r["k"]: r["m"] for r in
                   exact_quantiles(long, "v", [0.5], ["m"], by=["k"]).collect()}
            port_rows = mode_of(d, "_port", "m").collect()
        m = NativeCategoricalFeaturesModel()
        self._copyValues(m)
        m._set(portMode=(port_rows[0]["m"] if port_rows else None) or "nan")
        if med.get("age") is not None:
            m._set(ageMedian=float(med["age"]))
        if med.get("fare") is not None:
            m._set(fareMedian=float(med["fare"]))
        return m


def standard_scale_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std per column (one row); zero std -> scale 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return df.agg(*aggs)
