from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from weftline.llm import warc, web_archive as W
from weftline.sources.tables import load

BIG = "<p>" + "é" * 600 + "</p>"
PAGES = [
    (1, "http://a/1", BIG), (5, "http://a/5\r\nX: y", BIG), (3, None, BIG), (5, "http://a/5b", BIG), (2, "http://a/2", "small"),
    (4, "http://a/4", "small"), (6, "", None), (7, "http://b/7", ""), (None, "http://b/n", BIG), (None, "http://b/n", "x" * 2000),
    (8, "http://b/8", "WARC/1.0\r\n\r\n" * 300 + "\x1f\x8b"), (9, "http://b/9", "z" * 3_000_000),
]
SHAPE = "page_id long, url string, html string, digest string, original string"


def brute(pages):
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        same = [p[0] for p in pages if (p[2] or "") == (html or "") and p[0] is not None]
        original = max(same) if same and len(data) >= 1000 else i
        revisit = original != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "clash", "clash") for p in pages], SHAPE)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"compress": "false"}, {"file_bytes": "2000", "split_bytes": "500"}])
def test_round_trip(spark, tmp_path, options):
    W.write_archive(frame(spark, PAGES).repartition(3), f"file://{tmp_path}/w", **options)
    archive = W.read_archive(spark, f"file://{tmp_path}/w")
    assert rows(W.pages_of(archive)) == brute(PAGES)
    html = {r["target_uri"]: r["payload"] for r in archive.where("record_type = 'response'").collect()}
    assert bytes(html["http://b/9"]) == b"z" * 3_000_000
    assert "http://a/5%0D%0AX: y" in html


def test_whole_table(spark, sf_dir, tmp_path):
    pages = load(spark, sf_dir, "pages")
    W.write_archive(pages, str(tmp_path / "w"))
    want = brute([(r["page_id"], None, r["html"]) for r in pages.collect()])
    assert rows(W.pages_of(W.read_archive(spark, str(tmp_path / "w")))) == want


def test_predicates_and_header_options(spark, tmp_path):
    W.write_archive(frame(spark, PAGES), str(tmp_path / "w"))
    archive = W.read_archive(spark, str(tmp_path / "w"))
    plan = archive.where("record_type = 'revisit'")
    assert plan.count() == 3
    assert archive.where(F.col("target_uri").startswith("http://b/") & F.col("record_type").isin("response", "other")).count() == 4
    assert W.read_archive(spark, str(tmp_path / "w"), **{"header.X-Page-Id": "4"}).count() == 1
    assert W.read_archive(spark, str(tmp_path / "w"), payload="false").where("payload IS NOT NULL").count() == 0


def test_pushed_predicates_skip_the_payload(spark, tmp_path, monkeypatch):
    """Reader run in this process: unwanted members are not inflated past their headers."""
    from pyspark.sql.datasource import EqualTo
    from pyspark.sql.types import StructType

    W.write_archive(frame(spark, PAGES).coalesce(1), str(tmp_path / "w"))
    reader = warc.WarcReader({"path": str(tmp_path / "w")}, StructType.fromDDL(warc.FIELDS))
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), other := EqualTo(("date",), "x")])) == [other]
    inflated = []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def decompress(self, data, most=0):
            out = self.inner.decompress(data, most)
            inflated.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.inner, name)

    real = warc.zlib.decompressobj
    monkeypatch.setattr(warc.zlib, "decompressobj", lambda bits: Counting(real(bits)))
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(got) == 3 and sum(inflated) < 12 * 8193


def test_foreign_files(spark, tmp_path):
    """Plain records and gzip members without a stated length, in a folder without manifest."""
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 3)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record) * 4)
    (tmp_path / "ignored.txt").write_text("x")
    got = W.read_archive(spark, str(tmp_path)).collect()
    assert [bytes(r["payload"]) for r in got] == [b"hello"] * 7
    assert W.read_archive(spark, str(tmp_path)).where("record_type = 'response'").count() == 0


def test_empty_table(spark, tmp_path):
    W.write_archive(frame(spark, []), str(tmp_path / "w"))
    assert W.read_archive(spark, str(tmp_path / "w")).count() == 0
