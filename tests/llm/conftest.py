import duckdb
import pytest

SF = "/root/testdata/sf0.01"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture
def documents(spark):
    """Rows -> a documents table with an extra column whose name could clash."""
    def make(rows):
        rows = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]
        return spark.createDataFrame(rows, DOCUMENTS + ", score string")
    return make


def same_rows(df, con, sql):
    cols = sorted(df.columns)
    rel = con.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    mine = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert mine == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
