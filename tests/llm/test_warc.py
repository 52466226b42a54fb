import base64
import glob
import gzip
import hashlib
import zlib
from collections import Counter

import pytest

from ledgerline.llm import warc

PAGES = [
    (5, "http://a.example/x", "<p>one</p>"), (3, "http://b.example/", "<p>one</p>"), (9, None, "<p>one</p>"),
    (1, "http://c.example/ä b\r\nc", None), (2, "u", ""), (7, "v", "é" * 3000), (8, "w", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (None, "n", "<p>one</p>"), (None, "n", "alone"), (4, "r", "twice"), (4, "r", "twice"), (6, "s", "z" * 3_000_000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(min_bytes=0):
    least = {}
    for k, _, t in PAGES:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    out = []
    for k, _, t in PAGES:
        n, first = len((t or "").encode()), least.get(t or "")
        response = n < min_bytes or k == first
        out.append((k, n, digest(t), "response" if response else "revisit", None if response else first))
    return Counter(out)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "c", 1) for p in PAGES], "page_id long, url string, html string, key string, size int").repartition(3)


@pytest.mark.parametrize(("min_bytes", "archive_bytes"), [(0, 1 << 24), (6, 500)])
def test_round_trip(pages, min_bytes, archive_bytes):
    found = warc.archive_pages(pages, min_bytes=min_bytes, archive_bytes=archive_bytes)
    assert Counter(map(tuple, found.collect())) == expected(min_bytes)


def test_empty_table(pages):
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_files_on_disk(spark, pages, tmp_path):
    root = str(tmp_path)
    warc.archive_pages(pages, folder=root).count()
    streams = b"".join(gzip.open(p).read() for p in sorted(glob.glob(f"{root}/streams/*.warc.gz")))
    records = []
    for side in glob.glob(f"{root}/records/*.idx"):
        data, end = open(side.removesuffix(".idx"), "rb").read(), 0
        for line in open(side):
            offset, length, key, kind = line.rstrip("\n").split("\t")
            assert int(offset) == end
            end += int(length)
            record = zlib.decompress(data[int(offset) : end], 31)  # one member, nothing after it
            fields, start = warc.head_of(record)
            assert fields["warc-type"] == kind and fields["warc-record-id"] == f"<urn:page:{key}>"
            assert len(record) == start + int(fields["content-length"]) + 4
            records.append(record)
        assert end == len(data)
    assert len(records) == len(PAGES) and sorted(map(len, records)) == sorted(len(r) for _, r in warc.records_of([streams]))


def test_a_cut_stream_is_an_error():
    whole = warc.record_bytes(1, "u", b"payload", None, False)
    parts = [whole[i : i + 7] for i in range(0, len(whole), 7)]
    assert [r for _, r in warc.records_of([*parts, *parts])] == [whole, whole]
    with pytest.raises(ValueError):
        list(warc.records_of([whole[:-9]]))
    with pytest.raises(ValueError):
        list(warc.records_of([b"nothing\r\n\r\n"]))
