import gzip
import hashlib
import heapq
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from userflow.llm import warc

SCHEMA = "page_id long, url string, captured timestamp, html string, digest int, holder int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)).map(sorted), max_size=9))
def test_loser_tree_merges(runs):
    numbered = [[(x, i, k) for k, x in enumerate(run)] for i, run in enumerate(runs)]
    assert list(warc.merged([iter(run) for run in numbered])) == list(heapq.merge(*numbered))


def pages(spark, rows):
    return spark.createDataFrame([(*row, 1, 1) for row in rows], SCHEMA)


@pytest.fixture
def rows():
    when, big = datetime(2024, 5, 1, 12), "é<p>" * 400
    return [
        (1, "http://b.Example.org/x?q#f", when, big), (2, "http://a.example.org/", when, big), (3, None, None, None),
        (4, "", when, ""), (5, "bad url\r\nX: y", when, "short"), (6, "http://a.example.org/", when, "short"),
        (7, "http://a.example.org/", datetime(2023, 1, 1), big), (7, "http://a.example.org/", when, big),
        (8, "http://é.org/" + "p" * 5000, when, "x" * 3_000_000), (None, "http://a.example.org/", when, big),
        (9, "http://z.org", when, "a" * 999), (10, "http://z.org", when, "a" * 999), (11, "http://z.org", when, "a\r\n\r\nb" * 200),
    ]


def test_archives_round_trip(spark, rows, tmp_path):
    index = warc.archived(pages(spark, rows), str(tmp_path)).collect()
    holder = {}
    for i, _, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and i is not None:
            holder[body] = max(i, holder.get(body, i))
    want = []
    for i, _, _, html in rows:
        body = (html or "").encode()
        held = holder.get(body) if len(body) >= 1000 else None
        refers = held if held is not None and held != i else None
        kind = "response" if refers is None else "revisit"
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), kind, refers))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index]
    assert sorted(map(str, got)) == sorted(map(str, want))
    order = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in index]
    assert order == sorted(order)
    # Each record can be read alone by its place, with any reader of the format.
    for r in index:
        with open(tmp_path / r.file, "rb") as archive:
            archive.seek(r.offset)
            content = gzip.decompress(archive.read(r.bytes))
        assert content.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())


def test_runs_are_merged_across_ranges_and_files(spark, tmp_path):
    captured = F.timestamp_seconds(F.col("id") % 50)
    url = F.concat(F.lit("http://h"), (F.col("id") % 3).cast("string"), F.lit(".org/"))
    table = spark.range(0, 900, 1, 6).select(F.col("id").alias("page_id"), url.alias("url"), captured.alias("captured"), F.lit("x").alias("html"))
    files = warc.write_archives(table, f"file://{tmp_path}", file_bytes=20_000)
    assert files.count() > 6
    runs = warc.read_runs(files, f"file://{tmp_path}")
    index = warc.merged_index(runs, range_rows=100).collect()
    order = [(r.url_key, r.captured, r.page_id) for r in index]
    assert len(order) == 900 and order == sorted(order)


def test_no_pages(spark, tmp_path):
    assert warc.archived(pages(spark, []), f"file://{tmp_path}").collect() == []


def test_damaged_archives_are_refused(tmp_path):
    record = warc._capture(1, "http://a/", None, "body", hashlib.sha1(b"body").hexdigest(), None)
    whole = gzip.decompress(record)
    with pytest.raises(ValueError, match="differs"):
        warc.parsed(whole.replace(b"body", b"bodz"))
    (tmp_path / "x").write_bytes(record[:-9])
    with open(tmp_path / "x", "rb") as stream, pytest.raises(ValueError, match="ends within"):
        list(warc.members(stream))
