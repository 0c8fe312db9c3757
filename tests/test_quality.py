import json

from pyspark.sql import functions as F

from scoreflow.operators import quality as Q


def _requests(spark, bodies):
    return spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)],
                                 "request_id long, body string")


def test_bad_record_has_exactly_four_violations(spark):
    bad = {"passengers": [{"Pclass": 5, "tier": 5, "sex": "alien", "age": -10, "sibsp": 0,
                           "parch": 0, "fare": 7.25, "port": "Z"}]}
    v = Q.validate_requests(Q.explode_requests(_requests(spark, [bad]))).collect()
    assert len(v) == 1
    assert sorted(v[0]["violations"]) == ["age_out_of_range", "port_invalid", "sex_invalid",
                                          "tier_out_of_range"]


def test_batch_request_ids_and_defaults(spark):
    recs = [{"tier": 1 + i % 3, "sex": "Female" if i % 2 else "male", "age": 20.0 + i,
             "fare": 10.0, "port": ["s", "C", "Q", None, "q"][i]} for i in range(5)]
    v = Q.validate_requests(Q.explode_requests(_requests(spark, [{"passengers": recs}])))
    rows = sorted(v.collect(), key=lambda r: r["subject_id"])
    assert [r["subject_id"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["passenger_index"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["port"] for r in rows] == ["S", "C", "Q", None, "Q"]
    assert rows[1]["sex"] == "female" and rows[0]["sibsp"] == 0
    assert rows[0]["full_name"] == "Doe, Mr. John" and rows[0]["ticket"] == "UNKNOWN"
    assert all(r["violations"] == [] for r in rows)


def test_empty_request_rejected(spark):
    v = Q.validate_requests(Q.explode_requests(_requests(spark, [{"passengers": []}]))).collect()
    assert v[0]["violations"] == ["empty_request"]


def test_conform_adds_and_orders(spark):
    df = spark.createDataFrame([(3, "x", 1)], "tier int, sex string, subject_id long")
    out = Q.conform(df)
    assert out.columns == [f.name for f in Q.RECORD_FIELDS]
    r = out.collect()[0]
    assert r["ticket"] == "UNKNOWN" and r["sibsp"] == 0 and r["cabin"] is None
    assert Q.drop_present(out, ["cabin", "nope"]).columns[-1] == "port"
    assert "sex" not in Q.drop_string_columns(out, keep=["port"]).columns


def _codes(spark, **record):
    body = {"passengers": [{"tier": 1, "sex": "male", **record}]}
    return Q.validate_requests(Q.explode_requests(_requests(spark, [body]))).collect()[0]["violations"]


def test_wrong_types_and_nulls(spark):
    assert _codes(spark, age="abc", sibsp="two", parch=1.5, fare="free") == [
        "age_type", "sibsp_type", "parch_type", "fare_type"]
    assert _codes(spark, sibsp=None, full_name=None) == ["sibsp_type", "full_name_type"]
    assert _codes(spark, age="31.5", sibsp="2", fare=None, port=None, cabin=None) == []
    assert _codes(spark, full_name=5) == ["full_name_type"]
    assert _codes(spark, port="") == ["port_invalid"] and _codes(spark, port=" s ") == ["port_invalid"]


def test_malformed_request(spark):
    df = spark.createDataFrame([(1, '{"passengers": [{"tier": 1'), (2, '{"other": 1}')], "request_id long, body string")
    got = {r["request_id"]: r["violations"] for r in Q.validate_requests(Q.explode_requests(df)).collect()}
    assert got == {1: ["malformed_json"], 2: ["empty_request"]}


def test_fields_are_read_by_two_casts_of_the_whole_request(spark):
    """However many fields and rules there are, the parsed request is read twice (values, and what kind they are)."""
    df = spark.createDataFrame([(1, '{"passengers": [{"tier": 1, "sex": "male"}]}')], "request_id long, body string")
    plan = Q.explode_requests(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 2


def test_odd_records(spark):
    """Records that are no objects, flags for numbers, counts that don't fit, and a valid sibling of each."""
    bodies = [{"passengers": [{"tier": 1, "sex": "male"}, r]} for r in
              (5, None, {"tier": True, "sex": "male"}, {"tier": 3e9, "sex": "male"}, {"tier": 1, "sex": "male", "port": None, "age": "NaN"})]
    got = Q.validate_requests(Q.explode_requests(_requests(spark, bodies))).collect()
    assert {r["request_id"]: r["violations"] for r in got if r["passenger_index"] == 1} == {
        0: ["tier_out_of_range", "sex_invalid"], 1: ["tier_out_of_range", "sex_invalid"], 2: ["tier_out_of_range", "tier_type"],
        3: ["tier_out_of_range", "tier_type"], 4: ["age_type"]}
    assert [r["violations"] for r in got if r["passenger_index"] == 0] == [["request_rejected"]] * 5


def test_a_request_is_judged_once_and_not_by_every_record(spark):
    requests = spark.createDataFrame([(1, '{"passengers":[{"tier":1,"sex":"male"},{"tier":9,"sex":"male"}]}')], "request_id long, body string")
    records = Q.accepted(Q.validate_requests(Q.explode_requests(requests)))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("exists(")
    assert records.collect() == []
