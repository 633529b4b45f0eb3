import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from candlewick.llm import warc


@pytest.fixture()
def pages(spark):
    big, other = "<p>x</p>" * 200, "é" * 600
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (4, "u v\r\nX: y", other), (5, "u5", other),
            (6, "u6", "short"), (7, "u7", "short"), (8, "u8", None), (8, "u8", None), (None, "n", "WARC/1.1\r\nfake: 1\r\n\r\nhi")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))


def back(spark, pages, folder, **kw):
    m = warc.write(pages, folder, **kw)
    return m, warc.read(m, folder)


def test_round_trip(spark, pages, tmp):
    m, rows = back(spark, pages, tmp + "/w")
    got = {(r.record_id, r.type, r.refers_to, r.payload_bytes) for r in warc.records(rows).collect()}
    big, other = 8 * 200, 1200
    assert got == {("<urn:page:1>", "revisit", "<urn:page:9>", big), ("<urn:page:2>", "revisit", "<urn:page:9>", big),
                   ("<urn:page:9>", "response", None, big), ("<urn:page:4>", "revisit", "<urn:page:5>", other),
                   ("<urn:page:5>", "response", None, other), ("<urn:page:6>", "response", None, 5),
                   ("<urn:page:7>", "response", None, 5), ("<urn:page:8>", "response", None, 0), ("<urn:page:>", "response", None, 23)}
    assert warc.records(rows).count() == 10 and warc.gaps(rows).count() == 0
    assert m.agg(F.sum("records")).first()[0] == 10
    assert warc.write(pages.limit(0), tmp + "/none").count() == 0


def test_archives_roll(spark, sf_dir, tmp):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").coalesce(1)
    m = warc.write(pages, tmp + "/w", roll_bytes=10_000).collect()
    assert len(m) > 3 and sum(r.records for r in m) == pages.count()
    assert all(r.bytes >= 10_000 for r in sorted(m, key=lambda r: r.bytes)[1:])
    assert warc.op5_warc_salvage(spark, sf_dir).count() == pages.count()


def rows_of(raw: bytes):
    return list(warc.salvage(warc.Source(io.BytesIO(raw), len(raw))))


def records(n=6, compress=True):
    out = []
    for i in range(n):
        body = (f"page {i} ".encode() * (50 * i + 1))
        r = warc.record("response", i, f"u{i}", body, len(body), __import__("hashlib").sha1(body).hexdigest())
        out.append(gzip.compress(r, mtime=0) if compress else r)
    return out


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "junk_before", "drop_head", "length"])
def test_salvage(compress, damage):
    parts = records(compress=compress)
    bad = bytearray(parts[2])
    if damage == "flip":
        bad[len(bad) // 2] ^= 0xFF
    elif damage == "cut":
        bad = bad[:len(bad) // 2]
    elif damage == "drop_head":
        bad = bad[12:]
    elif damage == "length":
        if compress:
            bad = bytearray(gzip.compress(gzip.decompress(parts[2]).replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1)))
        else:
            bad = bytearray(parts[2].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 99999", 1))
    parts[2] = b"\x1f\x8b\x08junk WARC/1.1\r\n" + parts[2] if damage == "junk_before" else bytes(bad)
    raw = b"".join(parts)
    rows = rows_of(raw)
    good = [r["record_id"] for r in rows if r["gap"] is None]
    lost = [] if damage == "junk_before" else [2]
    assert good == [f"<urn:page:{i}>" for i in range(6) if i not in lost]
    assert sum(r["gap"] is not None for r in rows) == 1
    # Records and gaps cover the archive without overlap.
    assert [r["offset"] for r in rows] == [0] + [r["end"] for r in rows][:-1] and rows[-1]["end"] == len(raw)


def test_damaged_end_and_start_and_small_buffer(monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 64)
    monkeypatch.setattr(warc, "STEP", 7)
    parts = records(4)
    rows = rows_of(b"garbage" + b"".join(parts)[:-5])
    assert [r["gap"] is None for r in rows] == [False, True, True, True, False]
    assert rows_of(b"") == [] and rows_of(b"x" * 500)[0]["end"] == 500


def test_unlisted_archives_are_not_read(spark, pages, tmp):
    m, rows = back(spark, pages, tmp + "/w")
    with open(os.path.join(tmp, "w", "part-lost.warc.gz"), "wb") as f:
        f.write(records(1)[0])
    assert warc.read(m, tmp + "/w").count() == 10
