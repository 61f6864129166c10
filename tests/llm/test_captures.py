"""WARC round trip and index order."""

import gzip
import io
from collections import Counter
from pathlib import Path

import pytest

from compare import database, differences
from jobtide.llm import captures

FOLDER = "/root/testdata/sf0.01"
PAGES = [
    (1, "http://b.a.com/x", "h" * 150),
    (2, "http://b.a.com/x", "h" * 150),
    (2, "http://b.a.com/x", "h" * 150),
    (None, "http://www.a.com", "h" * 150),
    (None, None, "n" * 120),
    (None, None, "n" * 120),
    (3, None, None),
    (3, None, None),
    (4, "http://[bad", "s" * 99),
    (5, "http://b.a.com/x\r\nEvil: 1", "x\r\n\r\nWARC/1.1\r\n" * 20 + "é中"),
    (6, "http://a.com/y", "s" * 99),
    (7, "http://a.com/z?q=1", "é" * 50),
    (8, "http://a.com:8080/z", "é" * 50),
    (-9, "http://a.com/long", "w" * 300_000),
]
SCHEMA = "page_id long, url string, html string, offset int, kind string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, "x") for p in PAGES], SCHEMA).repartition(3)


def test_query_matches_sql(spark):
    assert differences(spark, FOLDER, "op10_warc", database(FOLDER)) == []


def test_types_and_references(pages):
    rows = captures.archive_and_index(pages).collect()
    assert len(rows) == len(PAGES)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str)
    want = []
    for page, _, html in PAGES:
        same = [p for p, _, h in PAGES if h == html and p is not None]
        size = len((html or "").encode())
        first = min(same, default=None)
        again = size >= 100 and first is not None and page != first
        want.append((page, size, "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("ranges", [1, 3, 1000])
def test_index_is_in_global_order(spark, pages, ranges):
    settings = captures.Settings(range_captures=ranges, archive_bytes=2000)
    for frame in (pages, spark.read.parquet(f"{FOLDER}/pages.parquet")):
        rows = captures.archive_and_index(frame, settings).orderBy("part", "place").collect()
        keys = [(r.url_key, r.captured_at, r.page_id is None, r.page_id or 0) for r in rows]
        assert keys == sorted(keys) and len(rows) == frame.count()
        assert [r.place for r in rows if r.part == rows[0].part][0] == 0


def test_archives_are_warc(spark, pages, tmp_path):
    captures.write_archives(pages, f"file://{tmp_path}/a", captures.Settings(archive_bytes=1000))
    found = {}
    for file in (tmp_path / "a").glob("part-*"):
        raw = gzip.decompress(file.read_bytes())
        with gzip.open(file) as opened:
            for offset, length, header, block in captures.read_records(opened):
                assert raw[offset : offset + 10] == b"WARC/1.1\r\n"
                assert raw[offset + length : offset + length + 4] == b"\r\n\r\n"
                if header[b"warc-type"] == b"response":
                    found.setdefault(header[b"warc-record-id"], []).append(block.partition(b"\r\n\r\n")[2])
    assert found[b"<urn:page:5>"] == [PAGES[9][2].encode()]
    assert found[b"<urn:page:3>"] == [b"", b""]
    assert b"<urn:page:2>" not in found


def test_damage_is_found(spark, pages, tmp_path):
    captures.write_archives(pages, f"file://{tmp_path}/b")
    file = next((tmp_path / "b").glob("part-*"))
    raw = gzip.decompress(file.read_bytes()).replace(b"hhh", b"hhj", 1)
    import io

    with pytest.raises(ValueError):
        for _, _, header, block in captures.read_records(io.BytesIO(raw[:-8] if b"hhj" not in raw else raw)):
            captures.capture(header, block)


def test_index_leads_to_single_records(spark, pages):
    rows = captures.archive_and_index(pages, captures.Settings(archive_bytes=4000, piece_bytes=500)).collect()
    folder = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("archives-*"), key=lambda p: p.stat().st_mtime)
    for row in rows:
        raw = (folder / row.archive).read_bytes()[row.offset : row.offset + row.length]
        ((_, _, header, block),) = captures.read_records(io.BytesIO(gzip.decompress(raw)))
        key, fields = captures.capture(header, block)
        assert fields == (row.page_id, row.payload_bytes, row.payload_digest, row.record_type, row.refers_to)
        assert key.startswith(row.url_key.encode())


def test_archives_are_cut_by_bytes(spark, tmp_path):
    """Many small pages, then large ones: no archive has more than its bytes and one record."""
    sizes = [0] * 300 + [700] * 100 + [9000] * 20
    html = [f"{i} ".ljust(size, "x") if size else None for i, size in enumerate(sizes)]
    rows = [(i, f"http://a.com/{i}", h) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    captures.write_archives(pages, f"file://{tmp_path}/c", captures.Settings(archive_bytes=8000, piece_bytes=1000))
    held = 0
    for file in (tmp_path / "c").glob("part-*"):
        records = [raw for _, _, raw in captures.members(memoryview(file.read_bytes()))]
        held += len(records)
        assert sum(map(len, records)) - max(map(len, records), default=0) <= 8000
    assert held == len(rows)


def test_large_ranges_are_cut_again(spark):
    """A sample for three first ranges only, a table for many: every range stays small, also of one URL."""
    rows = [(i, "http://hot.com/" if i % 3 else f"http://a{i % 40}.com/{i}", f"{i}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    settings = captures.Settings(range_captures=100, sample=30, archive_bytes=60_000, piece_bytes=5000)
    first, again, most = captures.splitters(pages, settings)
    assert len(first) <= 2 and again is not None and most >= 10
    got = captures.archive_and_index(pages, settings).orderBy("part", "place").collect()
    keys = [(r.url_key, r.captured_at, r.page_id) for r in got]
    assert keys == sorted(keys) and sorted(r.page_id for r in got) == list(range(3000))
    sizes = Counter(r.part for r in got)
    assert len(sizes) >= 15 and max(sizes.values()) <= 500


def test_clashing_names(spark, pages):
    other = pages.toDF("page_id", "url", "html", "PAGE_ID", "HTML")
    want = captures.archive_and_index(pages).drop("archive", "offset", "length")
    got = captures.archive_and_index(other).drop("archive", "offset", "length")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_empty_table(pages):
    assert captures.archive_and_index(pages.limit(0)).collect() == []
