import base64
import hashlib
import io
import zipfile

import pytest

from scoreflow.llm import warc_zip as W
from scoreflow.llm.common import shared_path
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string, path string"


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    top = {}
    for r in pages:
        top[r["html"]] = max(top.get(r["html"], -1), r["page_id"])
    got = {r["page_id"]: r for r in W.op6_warc_zip(spark, SF).collect()}
    assert len(got) == len(pages)
    for r in pages:
        b = (r["html"] or "").encode()
        kept = top[r["html"]] == r["page_id"]
        assert tuple(got[r["page_id"]]) == (r["page_id"], len(b), digest(b), "response" if kept else "revisit",
                                            None if kept else top[r["html"]])


def test_copies_nulls_and_ties(spark):
    rows = [(1, "http://a/x", "aa", ""), (2, None, "aa", ""), (3, "u\r\nv", None, ""), (4, "x", "", ""), (None, "n", "aa", ""),
            (None, "m", "solo", ""), (2, "dup", "aa", ""), (7, "é", "é☃", ""), (8, "long", "z" * 300_000, "")]
    d = spark.createDataFrame(rows, PAGES)
    manifest = W.write_archives(d, shared_path(spark, "t"), archive_bytes=300)
    got = W.read_archives(manifest, range_bytes=200).collect()
    assert len(got) == len(rows) == sum(r["records"] for r in manifest.collect()) and manifest.count() > 1
    by = {(r["page_id"], r["url"]): r for r in got}
    assert by[1, "http://a/x"]["refers_to"] == by[None, "n"]["refers_to"] == 2 and by[1, "http://a/x"]["payload"] is None
    assert [by[2, u]["record_type"] for u in (None, "dup")] == ["response"] * 2
    assert by[3, "u%0D%0Av"]["refers_to"] == 4 and by[3, "u%0D%0Av"]["payload_digest"] == digest(b"")
    assert by[None, "m"]["record_type"] == "response" and by[7, "é"]["payload"] == "é☃".encode()
    assert by[8, "long"]["payload_bytes"] == 300_000 and by[1, "http://a/x"]["payload_bytes"] == 2
    # records smaller than the limit are never revisits
    apart = W.read_archives(W.write_archives(d, shared_path(spark, "t"), min_bytes=3)).collect()
    assert {r["record_type"] for r in apart} == {"response"}
    assert W.read_archives(W.write_archives(d.limit(0), shared_path(spark, "t"))).count() == 0


def _package(n):
    return W.package([(i, W.gzip_member(W.record(i, f"u{i}", b"p" * i))) for i in range(n)])


def test_zip64_directories(monkeypatch):
    plain = _package(5)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    wide = _package(5)
    assert b"PK\6\6" in wide and b"PK\6\6" not in plain
    for raw in (plain, wide):
        f = io.BytesIO(raw)
        found = list(W.package_ranges(f, len(raw), limit=1))
        assert len(found) == 5
        for i, (start, lengths) in enumerate(found):
            got = W.parse_record(W.zlib.decompress(raw[start:start + lengths[0]], 31))
            assert got["page_id"] == i and got["payload"] == b"p" * i
        assert set(W.directory(f, len(raw))) == {W.DATA, W.INDEX}


def test_a_comment_may_hold_the_signature():
    out = io.BytesIO(_package(2))
    with zipfile.ZipFile(out, "a") as z:
        z.comment = b"xx PK\5\6 yy" + b"\0" * 30
    raw = out.getvalue()
    assert len(list(W.package_ranges(io.BytesIO(raw), len(raw)))) == 1


def test_damage_is_reported():
    raw = _package(1)
    with pytest.raises(ValueError, match="not a ZIP"):
        W.directory(io.BytesIO(b"x" * 100), 100)
    with pytest.raises(ValueError):
        W.directory(io.BytesIO(raw[:-5]), len(raw) - 5)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(W.DATA, b"a" * 99)
    with pytest.raises(ValueError, match="compressed"):
        W.stored(out, W.directory(out, len(out.getvalue())), W.DATA)
    rec = W.record(1, "u", b"payload").replace(b"payload\r\n", b"pAyload\r\n")
    with pytest.raises(ValueError, match="digest"):
        W.parse_record(rec)


def test_ranges_are_read_by_many_tasks(spark, documents):
    """Adaptive execution must not put the few rows of the plan, which stand for all archives, into one task."""
    from pyspark.sql import functions as F
    from scoreflow.llm.common import shared_path
    rng = __import__("random").Random(1)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(3000))) for i in range(200)]
    d = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("http://a/"))
    manifest = W.write_archives(d, shared_path(spark, "many"), archive_bytes=60_000)
    got = W.read_archives(manifest, range_bytes=20_000).withColumn("task", F.spark_partition_id())
    assert got.count() == 200
    assert got.select("task").distinct().count() >= 8
