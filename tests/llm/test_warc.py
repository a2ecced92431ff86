import base64
import gzip
import hashlib
import random

import pytest
from samples import make, prose  # noqa: F401 (fixtures)

from conform.llm.warc import LoserTree, archive_pages, capture_time, parse_archive, url_key, write_archives
from conform.session import scratch_path

SCHEMA = "page_id long, url string, html string"
SAME = "<p>é same</p>"
PAGES = [(1, "http://a.b.com/x?y#z", SAME), (2, "HTTP://A.B.Com", SAME), (3, None, None), (4, "no scheme", ""), (5, "https://c.org/\r\nq", "a\r\n\r\nWARC/1.0\r\n\r\nb"),
         (None, "http://a.b.com/", SAME), (6, "http://a.b.com/x?y", "unique"), (6, "http://a.b.com/x?y", "unique"), (None, None, "no id"), (None, None, "no id"),
         (-7, "http://ü.de/ß?ö", prose(1, 200_000)), (8, "://", "x"), (9, "http://a.b.com/x?y", SAME), (2 ** 60, "http://z.com", "far")]


def want(pages, least=0):
    best = {}
    for i, _, html in pages:
        if i is not None:
            best[html or ""] = max(best.get(html or "", i), i)
    rows = []
    for i, url, html in pages:
        raw = (html or "").encode()
        to = best.get(html or "") if len(raw) >= least else None
        to = None if to == i else to
        rows.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(rows, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(make, least):
    got = archive_pages(make(PAGES, SCHEMA), least_bytes=least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(PAGES, least)
    got.sort(key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, len(PAGES) + 1))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert keys == sorted(keys)
    assert {r.captured for r in got if r.page_id == 8} == {f"{capture_time(8):%Y%m%d%H%M%S}"}


def test_archives_are_warc_files_of_bounded_size(make, spark):
    path = scratch_path(spark, "warc-test")
    pages = [(i, f"http://h{i % 3}.com/{i}", prose(i, 300)) for i in range(60)]
    write_archives(make(pages, SCHEMA).coalesce(1), path, archive_bytes=20_000)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).collect()
    assert len(files) > 5
    seen = {}
    for f in files:
        raw = gzip.decompress(bytes(f.content))
        assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n") and len(raw) < 45_000
        for head, block in parse_archive(bytes(f.content)):
            assert len(block) == int(head["Content-Length"])
            seen[head["WARC-Record-ID"]] = block.split(b"\r\n\r\n", 1)[1].decode()
    assert seen == {f"<urn:x-page:{i}>": html for i, _, html in pages}


def test_broken_archive():
    record = b"WARC/1.0\r\nContent-Length: 5\r\n\r\nabc"
    with pytest.raises(ValueError):
        list(parse_archive(gzip.compress(record)))
    assert list(parse_archive(gzip.compress(b""))) == []


def test_empty_table(make):
    assert archive_pages(make([], SCHEMA)).collect() == []


def test_url_keys():
    assert url_key("http://Www.Example.COM/A?b=C#d") == "com,example,www)/A?b=C"
    assert url_key(None) == ")" and url_key("x#y") == ")x"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(k):
    r = random.Random(k)
    runs = [sorted((r.randint(0, 50),) for _ in range(r.randint(0, 30))) for _ in range(k)]
    got = [(runs[i][j], i, j) for i, j in LoserTree(runs)]
    assert [g[0] for g in got] == sorted(x for run in runs for x in run)
    assert len({g[1:] for g in got}) == len(got)
