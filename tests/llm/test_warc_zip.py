import base64
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from sparkmart.llm import shared, warc_zip
from tests_llm_helpers import corpus, folder, tables  # noqa: F401


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_agree_with_zipfile(zip64):
    members = [("a/one", [b"xyz", "é".encode()]), ("two", [b""]), ("ü", [b"\0" * 5000])]
    blob = warc_zip.zip_stored(members, zip64)
    plain = zipfile.ZipFile(io.BytesIO(blob))
    assert plain.testzip() is None
    mine = warc_zip.StoredZip(pa.BufferReader(blob))
    for name, parts in members:
        assert plain.read(name) == mine.read(name) == b"".join(parts)
    assert mine.read("a/one", 1, 3) == b"yz\xc3"
    with pytest.raises(ValueError):
        mine.read("two", 0, 1)


def test_foreign_archives_and_errors():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("x"), b"stored")
        z.comment = b"PK\5\6 in a comment is no end record" * 3
    with pytest.raises((ValueError, KeyError)):
        warc_zip.StoredZip(pa.BufferReader(out.getvalue())).read("y")
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", b"a" * 999)
    with pytest.raises(ValueError):
        warc_zip.StoredZip(pa.BufferReader(packed.getvalue()))
    with pytest.raises(ValueError):
        warc_zip.StoredZip(pa.BufferReader(b"nothing"))


def test_pages_round_trip(spark, tables, folder, monkeypatch):
    from sparkmart.llm.queries import QUERIES

    rows = QUERIES["op10_warc_zip"](spark, tables).collect()
    pages = spark.read.parquet(f"{tables}/pages.parquet").collect()
    tops = {}
    for p in pages:
        tops[p.html or ""] = max(tops.get(p.html or "", -1), -1 if p.page_id is None else p.page_id)
    want = []
    for p in pages:
        raw, top = (p.html or "").encode(), tops[p.html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = p.page_id == top
        want.append((p.page_id, len(raw), digest, "response" if first else "revisit", None if first else top))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_payloads_come_back_by_small_ranges(spark, folder):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i % 7}</p>" * (i % 7) + "é") for i in range(60)], "page_id long, url string, html string")
    linked = warc_zip.link(pages, least=4)
    files = shared.staged(warc_zip.write(linked, folder, archive_bytes=500), folder, "manifest")
    assert files.count() > 2
    got = {r.page_id: r for r in warc_zip.read(files, window=300, with_payload=True).collect()}
    for p in pages.collect():
        r = got[p.page_id]
        assert r.url == p.url and r.payload_bytes == len(p.html.encode())
        if r.record_type == "response":
            assert bytes(r.payload).decode() == p.html
        else:
            assert bytes(got[r.refers_to].payload).decode() == p.html
    assert {r.record_type for r in got.values() if r.payload_bytes < 4} == {"response"}


def test_empty(spark, folder):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    files = shared.staged(warc_zip.write(warc_zip.link(none), folder), folder, "manifest")
    assert warc_zip.read(files).collect() == []


def test_reads_are_spread_over_tasks(spark, folder):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 20) for i in range(90)], "page_id long, url string, html string")
    files = shared.staged(warc_zip.write(warc_zip.link(pages, folder), folder, archive_bytes=500), folder, "manifest")
    back = warc_zip.read(files)
    assert files.count() > 8 and back.rdd.getNumPartitions() == -(-files.count() // warc_zip.TASK_ARCHIVES) and back.count() == 90


def test_a_payload_of_a_third_of_all_pages_is_split(spark, folder):
    rows = spark.range(6000).selectExpr("id AS page_id", "'u' AS url", "IF(id % 3 = 0, repeat('same ', 40), concat('<p>', id, repeat('x', 100))) AS html")
    extra = [("digest", "a"), ("payload", "b"), ("top", "c"), ("refers_to", "d")]  # names that clash
    rows = rows.selectExpr("*", *(f"'{v}' AS {k}" for k, v in extra)).repartition(12)
    small = {"autoBroadcastJoinThreshold": "-1", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "adaptive.advisoryPartitionSizeInBytes": "2k", "shuffle.partitions": "24"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in small}
    for k, v in small.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        linked = warc_zip.link(rows, folder)
        got = linked.select("page_id", "refers_to").collect()
        plan = linked._jdf.queryExecution().executedPlan()
        linked.collect()
        assert "skew=true" in plan.toString() or "isSkew=true" in linked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)
    assert {r.page_id: r.refers_to for r in got} == {i: 5997 if i % 3 == 0 and i != 5997 else None for i in range(6000)}
