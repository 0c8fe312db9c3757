from scoreflow.llm import url_reputation as U
from tests.llm.conftest import SF, same_rows


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, key long, host string, n int")


def test_query_equals_sql(spark, duck):
    same_rows(U.op1_host_reputation(spark, SF), duck, U.ORACLE)


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.Example.com/en/x?q#f", "https://www.example.com/en/1", "x://m.b.net/es/", "x://net/fr/a", "http://example.com#t",
            "ftp://B.Com/", "no scheme", None, "a://b://c/d", "http://notexample.com/en/1"]
    pages = _pages(spark, [(i, u, None, "clash", 1) for i, u in enumerate(urls)])
    labels = spark.createDataFrame([], "key long, bad boolean")
    got = {r["page_id"]: r for r in U.judge_urls(pages, labels).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == [
        ("a.example.com", "/en/x", "example.com/en/", "block"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("m.b.net", "/es/", "net/es/", "block"), ("net", "/fr/a", "net/fr/", "block"), ("example.com", "", None, "allow"),
        ("b.com", "/", "com/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"),
        ("notexample.com", "/en/1", "com/", "allow")]
    # nothing is labelled: every host keeps the prior and nothing is blocked by it
    assert {r["bad_rate"] for r in got.values()} == {0.5}


def test_shrinkage_and_bound(spark):
    rows, labels, i = [], [], 0
    for host, n, bad in (("bad.org", 200, 190), ("good.org", 200, 2), ("new.org", 1, 1), ("x.bad.org", 0, 0)):
        for j in range(max(n, 1)):
            rows.append((i, f"http://{host}/p", i, "", 0))
            if n:
                labels.append((i, j < bad))
            i += 1
    rows.append((None, "http://bad.org/q", None, "", 0))
    rows.append((0, "http://bad.org/p", 0, "", 0))  # a repeated row
    got = U.judge_urls(_pages(spark, rows), spark.createDataFrame(labels + labels[:5], "key long, bad boolean"), rules=[]).collect()
    assert len(got) == len(rows)
    by = {r["host"]: r for r in got}
    assert by["bad.org"]["verdict"] == "block" and by["good.org"]["verdict"] == "allow"
    # one bad label of one is pulled towards the domain's prior and its bound is loose
    assert by["new.org"]["bad_rate"] < by["bad.org"]["bad_rate"] and by["new.org"]["bad_low"] < by["bad.org"]["bad_low"] - 0.3
    assert by["x.bad.org"]["bad_rate"] > by["good.org"]["bad_rate"]  # takes its domain's estimate
    assert all(r["bad_low"] < r["bad_rate"] for r in got)


def test_empty(spark):
    assert U.judge_urls(_pages(spark, []), spark.createDataFrame([], "key long, bad boolean")).count() == 0
