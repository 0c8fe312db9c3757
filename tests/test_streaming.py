import json

from pyspark.sql import functions as F

from scoreflow.operators import quality as Q
from scoreflow.plans import catalog as C
from scoreflow.streaming import scoring as STR
from tests.conftest import SF_SMALL


def _write_requests(path, first_id, n_requests, bad_every=0):
    lines = []
    for r in range(first_id, first_id + n_requests):
        recs = [{"tier": 1 + (r + i) % 3, "sex": "female" if (r + i) % 2 else "male",
                 "age": 20.0 + i, "fare": 100.0 * (i + 1), "port": "S"} for i in range(3)]
        if bad_every and r % bad_every == 0:
            recs[1]["tier"] = 7
        lines.append(json.dumps({"request_id": r, "passengers": recs}))
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_restart_is_incremental_and_equals_batch(spark, tmp_path):
    src, out, rej, ck = (str(tmp_path / d) for d in ("in", "out", "rej", "ck"))
    (tmp_path / "in").mkdir()
    model, _ = C.fitted_features(spark, SF_SMALL, keep=("subject_id", "request_id"))
    scorer = C.preset_stream_scorer(model)
    _write_requests(f"{src}/a.json", 0, 10, bad_every=4)
    STR.run_to_completion(STR.start_scoring(spark, src, scorer, out, rej, ck))
    first = spark.read.parquet(out).count() + spark.read.parquet(rej).count()
    assert first == 30
    _write_requests(f"{src}/b.json", 100, 5)
    STR.run_to_completion(STR.start_scoring(spark, src, scorer, out, rej, ck))
    accepted = spark.read.parquet(out)
    rejected = spark.read.parquet(rej)
    assert accepted.count() + rejected.count() == 45  # only the new file was processed
    # requests 0, 4, 8 hold one bad record: all 3 records of each are rejected
    assert sorted(r[0] for r in rejected.select("request_id").distinct().collect()) == [0, 4, 8]
    assert rejected.where(F.array_contains("violations", "request_rejected")).count() == 6
    # the same lines through the batch path give the same accepted rows
    lines = spark.read.text(src)
    batch = scorer(Q.accepted(STR.request_records(lines)))
    cols = ["request_id", "passenger_index", "pred", "prob", "confidence"]
    assert sorted(batch.select(*cols).collect()) == sorted(accepted.select(*cols).collect())


def test_stream_reads_a_line_once_and_a_batch_run_again_replaces_itself(spark, tmp_path):
    src, out, rej, ck = (str(tmp_path / d) for d in ("in", "out", "rej", "ck"))
    (tmp_path / "in").mkdir()
    _write_requests(f"{src}/a.json", 0, 12, bad_every=3)

    def scorer(records):
        return records.select("request_id", "passenger_index", "fare")
    qs = STR.start_scoring(spark, src, scorer, out, rej, ck)
    STR.run_to_completion(qs)
    assert sum(p["numInputRows"] for q in qs for p in q.recentProgress) == 12

    def rows():
        return [sorted(spark.read.parquet(d).select("request_id", "passenger_index").collect()) for d in (out, rej)]
    first = rows()
    assert [len(r) for r in first] == [24, 12]
    STR.write_batch(STR.request_records(spark.read.text(src)), 0, scorer, out, rej)
    assert rows() == first
