"""WARC archives: exact round trips, revisits, damaged files."""

from __future__ import annotations

import collections
import gzip
import hashlib
import io
import os
import random

import pytest

from armorica.llm import warc

SMALL = {"segment_bytes": 60, "chunk_bytes": 7, "archive_bytes": 9_000}


def _pages():
    rng = random.Random(6)
    big = "".join(rng.choices("abcdé<>\r\n 0", k=30_000))
    copy = "the same page " * 20
    rows = [(i, f"http://a.example/{i}", "".join(rng.choices("xyz\r\n0é", k=rng.randrange(300)))) for i in range(60)]
    rows += [(100 + i, f"http://b.example/{i}", copy) for i in range(30)]
    rows += [(200, "u", big), (201, None, big), (None, "v", big), (None, None, copy), (None, "w", None), (202, "w", "")]
    rows += [(203, "line\r\nWARC/1.1", "0\r\n\r\nWARC/1.1\r\n"), (204, "é", "x" * 99), (205, "é", "x" * 99)]
    rows += [(300, "r", "a row that repeats " * 9)] * 5 + [(301, "r", "short")] * 3 + [(99, "r", copy)] * 2
    return rows


def _plainly(rows):
    first = {}
    for page_id, _, html in rows:
        first.setdefault(html or "", []).append(page_id)
    want = collections.Counter()
    stored = set()
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        ids = [x for x in first[html or ""] if x is not None]
        least = min(ids) if ids else None
        if len(payload) < 100 or (page_id == least and html not in stored):
            stored.add(html)
            want[page_id, len(payload), digest, "response", None] += 1
        else:
            want[page_id, len(payload), digest, "revisit", least] += 1
    return want


def _read(spark, folder):
    rows = warc.read_pages(spark, folder).collect()

    def number(text):
        return None if text is None else int(text)

    return collections.Counter((number(row.id), row.bytes, row.digest, row.record_type, number(row.refers_to)) for row in rows)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(_pages(), "page_id bigint, url string, html string").repartition(3).cache()


@pytest.mark.parametrize("options", [{}, SMALL, SMALL | {"compress": True, "sent_rows": 0}])
def test_round_trip(spark, pages, options):
    folder = warc.write_warc(pages, **options)
    assert _read(spark, folder) == _plainly(_pages())
    payloads = {row.id: bytes(row.payload).decode() for row in warc.read_records(spark, folder).collect() if row.record_type == "response"}
    assert payloads["200"] == next(html for page_id, _, html in _pages() if page_id == 200)


def test_records_are_unique_and_segments_small(spark, pages):
    folder = warc.write_warc(pages, **SMALL)
    names = [row["name"] for row in spark.read.parquet(f"{folder}/manifest").collect()]
    ids, kinds, files_of = [], collections.Counter(), collections.defaultdict(set)
    for name in names:
        with open(f"{folder}/{name}", "rb") as file:
            for fields, block in warc.records_of(file):
                assert len(block) <= max(60, len(warc.REVISIT_HEADER))
                ids.append(fields["warc-record-id"])
                kinds[fields["warc-type"]] += 1
                files_of[fields.get("warc-segment-origin-id") or fields["warc-record-id"]].add(name)
    assert len(set(ids)) == len(ids) and kinds["continuation"] > 1000 and kinds["revisit"] == sum(
        n for row, n in _plainly(_pages()).items() if row[3] == "revisit"
    )
    assert max(map(len, files_of.values())) > 3, "a block goes on in the next file"


def test_copies_in_blocks(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_AT_ONCE", 2)
    assert _read(spark, warc.write_warc(pages)) == _plainly(_pages())


def test_damaged_archives(spark):
    rows = [(i, "u", f"page {i} " * 100) for i in range(3)]
    folder = warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), **SMALL)
    names = [row["name"] for row in spark.read.parquet(f"{folder}/manifest").collect()]
    lost = None
    for name in names:  # a segment of one page goes
        path = os.path.join(folder, name)
        with open(path, "rb") as file:
            records = list(warc.records_of(file))
        for fields, block in records:
            if lost is None and fields.get("warc-segment-number") == "3":
                lost = block
                with open(path, "rb") as file:
                    data = file.read()
                start = data.rindex(b"WARC/1.1", 0, data.index(b"WARC-Segment-Number: 3\r\n"))
                end = data.index(b"\r\n\r\n", start) + 4 + len(block) + 4
                with open(path, "wb") as file:
                    file.write(data[:start] + data[end:])
    found = warc.read_records(spark, folder).collect()
    assert sorted(row.payload is None for row in found) == [False, False, True]
    assert len(warc.read_pages(spark, folder).collect()) == 3


def test_chunks():
    rng = random.Random(9)
    for size in [0, 1, 6, 7, 8, 1000]:
        payload = rng.randbytes(size)
        assert warc.dechunked(warc.chunked(payload, 7)) == payload
        assert warc.payload_of(warc.HTTP_HEADER + warc.chunked(payload)) == payload
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"zz\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_foreign_archives():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nX-Long: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (record * 2, gzip.compress(record) + gzip.compress(record)):
        found = list(warc.records_of(io.BytesIO(data)))
        assert [(fields["x-long"], block) for fields, block in found] == [("a b", b"abc")] * 2
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(record[:-6])))


def test_other_ids_and_empty_tables(spark, pages):
    rows = spark.createDataFrame(
        [("a\nb", "u", "x" * 500, 1, "z"), ("c", "u", "x" * 500, 1, "z")], "key string, url string, body string, number int, block string"
    )
    found = warc.read_pages(spark, warc.write_warc(rows, id_col="key", payload_col="body")).collect()
    assert sorted((row.id, row.record_type, row.refers_to) for row in found) == [("a%0Ab", "response", None), ("c", "revisit", "a%0Ab")]
    assert warc.read_pages(spark, warc.write_warc(pages.limit(0))).count() == 0
