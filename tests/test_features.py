from pyspark.sql import functions as F

from scoreflow.functions import scalars as S
from scoreflow.operators.features import (ENCODED_FEATURES, EncodedFeatures, EncodedFeaturesModel,
                                          NativeCategoricalFeatures)

EXPECTED = {  # id -> tier sex age sibsp parch fare port title family alone age_band fare_cat
    1: (1, 0, 30, 0, 0, 10, 0, 0, 1, 1, 2, 0),
    2: (1, 1, 40, 1, 0, 20, 1, 2, 2, 0, 3, 1),
    3: (2, 1, 12, 0, 2, 30, 0, 1, 3, 0, 0, 1),
    4: (3, 0, 32.5, 0, 0, 40, 0, 0, 1, 1, 2, 2),
    5: (3, 0, 4, 3, 1, 50, 2, 3, 5, 0, 0, 3),
    6: (2, 0, 61, 0, 0, 30, 0, 4, 1, 1, 4, 1),
    7: (1, 1, 35, 0, 0, 80, 1, 0, 1, 1, 2, 3),
    8: (3, 0, 32.5, 1, 1, 8, 2, 0, 3, 0, 2, 0),
}


def test_learned_statistics(passengers):
    m = EncodedFeatures().fit(passengers)
    got = m.fitted()
    assert dict(zip(got["titleKeys"], got["titleAges"])) == {
        "Master": 4.0, "Miss": 12.0, "Mr": 32.5, "Mrs": 40.0, "Officer": 61.0}
    assert got["ageMedian"] == 32.5
    assert got["portMode"] == "S"
    assert got["fareMedian"] == 30.0
    assert got["fareEdges"] == [8.0, 17.5, 30.0, 42.5, 80.0]


def test_golden_matrix(passengers):
    m = EncodedFeatures(keepCols=["subject_id"]).fit(passengers)
    rows = {r["subject_id"]: tuple(r[c] for c in ENCODED_FEATURES)
            for r in m.transform(passengers).collect()}
    for k, exp in EXPECTED.items():
        assert rows[k] == tuple(float(x) if isinstance(x, float) else x for x in exp), k


def test_features_have_no_nulls_and_float32(passengers):
    m = EncodedFeatures(float32=True).fit(passengers)
    out = m.transform(passengers)
    assert all(t == "float" for _, t in out.dtypes)
    assert out.where(F.greatest(*[F.col(c).isNull().cast("int") for c in out.columns]) == 1).count() == 0
    assert len(out.columns) == 12


def test_train_only_statistics(passengers):
    """Changing held-out rows changes no statistic; changing a training row does."""
    def fitted(changed):
        rows = passengers.withColumn("is_test", F.col("subject_id") > 6)
        for c, v in (("age", 99.0), ("fare", 1e6), ("port", "Q")):
            rows = rows.withColumn(c, F.when(changed, F.lit(v)).otherwise(F.col(c)))
        return EncodedFeatures().fit(rows.where(~F.col("is_test"))).fitted()

    plain = fitted(F.lit(False))
    assert fitted(F.col("subject_id") > 6) == plain
    other = fitted(F.col("subject_id") == 2)
    assert all(other[k] != plain[k] for k in ("fareMedian", "titleAges"))


def test_fare_edges_collapse(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 5, 9]], "fare double")
    df = df.select(F.lit("Doe, Mr. A").alias("full_name"), F.lit(1).alias("tier"),
                   F.lit("male").alias("sex"), F.lit(20.0).alias("age"), F.lit(0).alias("sibsp"),
                   F.lit(0).alias("parch"), "fare", F.lit("S").alias("port"))
    assert EncodedFeatures().fit(df).fitted()["fareEdges"] == [1.0, 4.0, 9.0]


def test_bins_and_bands(spark):
    edges = [5.0, 10.0, 20.0, 30.0, 100.0]
    fares = [5.0, 4.9, 10.0, 10.1, 100.0, 500.0]
    df = spark.createDataFrame([(f,) for f in fares], "f double")
    got = [r[0] for r in df.select(S.fare_category("f", edges)).collect()]
    assert got == [0, 0, 0, 1, 3, 0]
    ages = [12.0, 12.5, 18.0, 35.0, 60.0, 120.0]
    df = spark.createDataFrame([(a,) for a in ages], "a double")
    assert [r[0] for r in df.select(S.age_band("a")).collect()] == [0, 1, 1, 2, 3, 4]


def test_confidence_boundaries(spark):
    ps = [0.75, 0.25, 0.60, 0.40, 0.7499, 0.5]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    assert [r[0] for r in df.select(S.confidence("p")).collect()] == [
        "High", "High", "Medium", "Medium", "Medium", "Low"]


def test_native_categorical(passengers):
    m = NativeCategoricalFeatures(keepCols=["subject_id"]).fit(passengers)
    out = {r["subject_id"]: r for r in m.transform(passengers).collect()}
    assert out[4]["age"] == 32.5 and out[4]["port"] == "S"
    assert out[6]["fare"] == 30.0 and out[1]["tier"] == "1" and out[1]["sex"] == "male"
    assert len(out[1]) == 10


def test_model_persistence(passengers, tmp_path):
    m = EncodedFeatures(keepCols=["subject_id"]).fit(passengers)
    path = str(tmp_path / "feat")
    m.write().overwrite().save(path)
    back = EncodedFeaturesModel.load(path)
    assert back.fitted() == m.fitted()
    a = sorted(m.transform(passengers).collect())
    b = sorted(back.transform(passengers).collect())
    assert a == b


def test_nan_counts_as_missing(spark, passengers):
    m = EncodedFeatures(keepCols=["subject_id"]).fit(passengers)
    nan_rows = passengers.withColumn("age", F.when(F.col("subject_id") == 4, F.lit(float("nan")))
                                     .otherwise(F.col("age")))
    r = {x["subject_id"]: x for x in m.transform(nan_rows).collect()}
    assert r[4]["age"] == 32.5 and r[4]["age_band"] == 2
    assert m.fitted() == EncodedFeatures().fit(nan_rows).fitted()
