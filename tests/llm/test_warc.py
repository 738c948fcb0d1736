import base64
import gzip
import hashlib
import random
from pathlib import Path

from tests.llm.frames import ids
from tidemark.llm import warc
from tidemark.llm.warc import LoserTree, archive, capture_order, read_archives, url_key, write_archives

PAGES = [
    (1, "http://www.Example.com/a?q=1#x", "<p>one</p>"),
    (2, "https://example.com:8080/A?q=1", "<p>one</p>"),
    (3, "http://b.example.org/", None),
    (4, None, ""),
    (5, "not a url\nwith a break", "has\r\n\r\nWARC/1.1\r\n\r\nContent-Length: 5\r\n\r\ninside ü 中"),
    (6, "http://[bad", "<p>one</p>"),
    (None, "http://c.example.org/x", "<p>one</p>"),
    (7, "http://b.example.org/", "x" * 200_000),
    (7, "http://b.example.org/", "x" * 200_000),
    (8, "http://b.example.org/", "x" * 200_000),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, None, None) for r in rows], "page_id long, url string, html string, key string, digest int")


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        revisit = page is not None and page != first
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_round_trip(spark):
    assert ids(archive(pages(spark).repartition(3)), *COLUMNS) == brute(PAGES)


def test_many_files_merge_in_global_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 20)
    rng = random.Random(3)
    rows = [(i, f"http://h{rng.randint(0, 3) if i % 3 else 0}.net/{rng.randint(0, 5)}", f"body {rng.randint(0, 60)}") for i in range(400)]
    folder = f"{tmp_path}/archives"
    write_archives(pages(spark, rows).repartition(4), folder)
    assert len(list(Path(folder).glob("part-*"))) >= 20
    found = read_archives(spark, folder).orderBy("range_no", "position").collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=repr) == brute(rows)
    order = [capture_order(tuple(r[c] for c in warc.FIELDS)) for r in found]
    assert order == sorted(order)
    whole = {p.name: gzip.decompress(p.read_bytes()) for p in Path(folder).glob("part-*")}
    for r in found:
        record = whole[r["archive"]][r["archive_offset"] : r["archive_offset"] + r["archive_length"]]
        assert record.startswith(b"WARC/1.1\r\n") and f"<urn:page:{r['page_id']}>".encode() in record and record.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    assert archive(pages(spark, [])).count() == 0


def test_url_keys():
    assert url_key("http://www.Example.com:80/A/b?Q=1#frag") == "com,example)/a/b?q=1"
    assert url_key("http://a.b.c") == "c,b,a)/" and url_key("") == ")/"


def test_loser_tree():
    rng = random.Random(8)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(((i, 0, "", "", None, f"u{rng.randint(0, 9)}", "t", "f", i, 1) for i in rng.sample(range(1000), rng.randint(0, 20))), key=capture_order) for _ in range(k)]
        merged = list(LoserTree([iter(r) for r in runs]))
        assert [capture_order(r) for r in merged] == sorted(capture_order(r) for run in runs for r in run)
