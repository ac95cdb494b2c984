from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from contractflow.llm import warc_zip as Z

PAGES = [(0, "http://a/%25\n", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "u", None), (3, "u", ""), (4, "u", "é\r\n\r\nWARC/1.1\r\n\r\n"), (None, "n", "<p>same</p>"), (None, "n", "only null"), (None, "m", "only null"), (0, "http://a/", "<p>same</p>"), (9, "big", "x" * 9_000_000), (10, "big", "x" * 9_000_000)]


def wanted(pages):
    firsts = {}
    for page, _, html in pages:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    out = []
    for page, url, html in pages:
        body = (html or "").encode()
        first = firsts.get(html or "")
        again = page != first
        out.append((page, url, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("sent", [0, Z.SENT_DIGESTS])
def test_round_trip(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(Z, "SENT_DIGESTS", sent)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS payload", "1 AS record_type")
    path = f"file://{tmp_path}/out"
    Z.write_packages(df.repartition(3), path)
    rows = Z.read_packages(spark, path).collect()
    number = lambda x: None if x in (None, "<urn:page:>") else int(x[10:-1])
    got = sorted(((number(r["record_id"]), r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in rows), key=str)
    assert got == wanted(PAGES)
    assert all(r["intact"] for r in rows if r["record_type"] == "response")
    assert {bytes(r["payload"]).decode() for r in rows if r["payload"] is not None} == {h or "" for _, _, h in PAGES}
    for name in glob.glob(f"{tmp_path}/out/part-*"):
        with zipfile.ZipFile(name) as z:  # another reader agrees with the directory and the checksums
            assert z.testzip() is None
            assert [i.compress_type for i in z.infolist()] == [0, 0]


def test_empty_table(spark, tmp_path):
    Z.write_packages(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/none")
    assert Z.read_packages(spark, f"file://{tmp_path}/none").count() == 0


def foreign(path, packed, comment=b""):
    """A package made by another writer: several members, none indexed, some compressed."""
    records = [Z.page_record(str(i), f"u{i}", f"page {i}".encode(), None, False) for i in range(5)]
    data = b"".join(gzip.compress(r) if packed else r for r in records)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/one.warc.gz" if packed else "archive/one.warc", data)
        z.writestr("archive/two.warc", Z.page_record("7", None, b"seven", None, False))
        z.writestr(zipfile.ZipInfo("notes.txt"), b"PK\x05\x06 not a directory", zipfile.ZIP_DEFLATED)
        z.comment = comment


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment " * 4])
def test_other_writers(spark, tmp_path, packed, comment):
    foreign(tmp_path / "a.wacz", packed, comment)
    rows = Z.read_packages(spark, f"file://{tmp_path}").collect()
    assert sorted((r["record_id"], bytes(r["payload"]).decode()) for r in rows) == [*[(f"<urn:page:{i}>", f"page {i}") for i in range(5)], ("<urn:page:7>", "seven")]
    assert all(r["intact"] for r in rows)


def test_no_zip_file(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"nothing of the kind")
    with pytest.raises(Exception, match="no end of a ZIP directory"):
        Z.read_packages(spark, f"file://{tmp_path}").collect()


def test_compressed_members_raise(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/one.warc", Z.page_record("1", None, b"one", None, False))
    with pytest.raises(Exception, match="is compressed"):
        Z.read_packages(spark, f"file://{tmp_path}").collect()


def test_members_without_an_index_are_split_between_records(spark, tmp_path, monkeypatch):
    """Payloads that look like records, and blocks larger than what is read at a time."""
    pages = [b"x" * 70_000, b"\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello", b"", b"y" * 300] * 5
    data = b"".join(Z.page_record(str(i), None, p, None, False) for i, p in enumerate(pages))
    with zipfile.ZipFile(tmp_path / "a.wacz", "w") as z:
        z.writestr("data/one.WARC", data)
        z.writestr("archive/two.warc", Z.page_record("99", None, b"two", None, False))
    monkeypatch.setattr(Z, "RANGE", 100_000)
    found = list(Z.ranges_of(f"file://{tmp_path}/a.wacz", (tmp_path / "a.wacz").stat().st_size))
    assert len(found) > 4 and max(r[2] for r in found) <= 100_000 and sum(r[2] for r in found) > len(data)
    rows = Z.read_packages(spark, f"file://{tmp_path}")
    assert sorted((r["record_id"], bytes(r["payload"])) for r in rows.collect()) == sorted([*[(f"<urn:page:{i}>", p) for i, p in enumerate(pages)], ("<urn:page:99>", b"two")])


def test_reading_takes_as_many_tasks_as_there_are_bytes(spark, tmp_path):
    text = F.repeat(F.col("id").cast("string"), 250_000)
    pages = spark.range(100, 260, 1, 2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), text.alias("html"))
    Z.write_packages(pages, f"file://{tmp_path}/out")
    records = Z.read_packages(spark, f"file://{tmp_path}/out")
    assert records.select("payload_bytes").rdd.getNumPartitions() == 120_000_000 // Z.RANGE + 1
    assert records.agg(F.sum("payload_bytes")).first()[0] == 120_000_000


def test_odd_ids(spark, tmp_path):
    ids = ["", None, "a\nb", "%0A", "a+b %41", "é>", " x "]
    df = spark.createDataFrame([(x, "u", f"page {x!r}") for x in ids] + [("z", "u", "page ''"), ("z2", None, "page 'a\\nb'")], "page_id string, url string, html string")
    Z.write_packages(df, f"file://{tmp_path}/out")
    rows = Z.read_packages(spark, f"file://{tmp_path}/out").select(Z.page_of("record_id").alias("page"), Z.page_of("refers_to").alias("to")).collect()
    assert {r["page"] for r in rows} == {*ids, "z", "z2"}
    assert {(r["page"], r["to"]) for r in rows if r["to"] is not None} == {("z", ""), ("z2", "a\nb")}


def test_zip64_values():
    extra = struct.pack("<HHB", 9, 1, 0) + struct.pack("<HHQQ", 1, 16, 5 << 32, 6 << 32)
    assert Z.zip64_values(extra, [Z.FULL32, 17, Z.FULL32]) == [5 << 32, 17, 6 << 32]
    assert Z.zip64_values(b"", [1, 2, 3]) == [1, 2, 3]
