"""Web archives: writing deduplicated WARC files, reading them back, and merging their indexes.

Payload digests find equal payloads; the record with the smallest page_id is a response and the others revisit
it. Spark's own writers lay the records down (committed, retried and stored like any table). Each archive read
back is one capture run, sorted locally by URL key and timestamp. Splitters from a bounded sample of the runs cut
the key space; every range is merged by a loser tree over its slices of the runs, so capture histories come out in
global order without any task sorting or holding more than one range.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parallelism, stored
from tidemark.sources.workspace import fresh_folder

END = "\r\n"
#: Records in an archive file and in a merged range at most; index keys that the driver sees at most, about.
FILE_RECORDS, RANGE_RECORDS, SAMPLED_KEYS = 4000, 50_000, 1 << 16
# fixed values: base32 alphabet; profile of revisits of equal payloads
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "archive", "archive_offset", "archive_length"]
KINDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string, archive string, archive_offset long, archive_length long"


def base32_sha1(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in base32: four letters for every five hexadecimal digits."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    quads = [F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    letter = lambda v, shift: F.substring(F.lit(BASE32), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*(letter(v, shift) for v in quads for shift in (15, 10, 5, 0)))


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to: of equal payloads all but the smallest page_id refer to it."""
    page_id, html = F.col("page_id").cast("long"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(page_id.alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    narrow = stored(rows.select("page_id", F.sha2("html", 256).alias("key"), F.octet_length("html").alias("size")), "payloads")
    firsts = narrow.groupBy("key", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # a very common payload is split by the adaptive skew join
    revisits = narrow.join(firsts, ["key", "size"]).where("page_id <> first").select("page_id", "key", F.col("first").alias("refers_to")).distinct()
    keyed = rows.withColumn("key", F.sha2("html", 256))
    return keyed.join(revisits, ["page_id", "key"], "left").withColumn("digest", base32_sha1(F.col("html"))).drop("key")


def record(rows: DataFrame) -> Column:
    """A WARC record as text, without the two line ends that close it."""
    date = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31_536_000))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length("html"), F.lit(END * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    url = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    head = [
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", uri("page_id")),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(END)) for name, value in head]
    more = F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri("refers_to"), F.lit(f"{END}WARC-Profile: {PROFILE}{END}"))).otherwise(F.lit(""))
    return F.concat(F.lit(f"WARC/1.1{END}"), *lines, more, F.lit(END), block)


def write_archives(pages: DataFrame, folder: str) -> str:
    """Gzipped WARC 1.1 files of at most ``FILE_RECORDS`` records below ``folder``."""
    rows = decided(pages)
    writer = rows.select(record(rows).alias("value")).write.option("lineSep", END * 2).option("maxRecordsPerFile", FILE_RECORDS).option("compression", "gzip")
    writer.text(folder)
    return folder


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, in lower case; scheme, port, fragment and a leading www go."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/").lower() + ("?" + parts.query.lower() if parts.query else "")


def _number(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse_archive(name: str, data: bytes) -> list[tuple]:
    """Index rows of all records (offsets are those of the uncompressed archive), in ``FIELDS`` order; payloads are checked against their digests."""
    rows, at = [], 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split(END)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"{name}: no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        block = data[stop + 4 : stop + 4 + size]
        http, payload = block.split(b"\r\n\r\n", 1)
        stated = int(http.rpartition(b"Content-Length: ")[2])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        end = stop + 4 + size + 4
        if head["WARC-Type"] == "response" and (stated != len(payload) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest) or data[end - 4 : end] != b"\r\n\r\n":
            raise ValueError(f"{name}: the record at byte {at} is damaged")
        rows.append((_number(head["WARC-Record-ID"]), stated, digest, head["WARC-Type"], _number(head.get("WARC-Refers-To")), url_key(head["WARC-Target-URI"]), head["WARC-Date"], name, at, end - at))
        at = end
    return rows


def capture_order(row: tuple) -> tuple:
    """URL key, timestamp, page; the place in the archives makes it unique."""
    return row[5], row[6], row[0] is not None, row[0] or 0, row[7], row[8]


class LoserTree:
    """Merges k sorted iterators: the tournament keeps losers in its nodes, so a new leaf replays one path."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._replay(i)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (capture_order(row), row)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None and self.heads[a] is not None
        return self.heads[a][0] < self.heads[b][0]

    def _replay(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            if self.losers[node] < 0:  # while building: wait here for the other side
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner][1]
            self.heads[winner] = self._next(winner)
            self._replay(winner)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each archive's index as one locally sorted run."""
    for batch in batches:
        for name, data in zip(batch.column(0), batch.column(1)):
            rows = sorted(parse_archive(name.as_py().rpartition("/")[2], gzip.decompress(data.as_py())), key=capture_order)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([rows[0][7]]), pa.array([len(rows)], pa.int64()), pa.array([json.dumps(rows)])], ["run", "n", "rows"])


def merge_runs(runs: DataFrame) -> DataFrame:
    """All index rows in global capture order, which is that of (range_no, position)."""
    spark = runs.sparkSession
    total, n_runs = runs.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ranges = max(1, min(total, max(parallelism(spark), -(-total // RANGE_RECORDS))))
    per_run = max(1, SAMPLED_KEYS // max(1, n_runs))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column(0).to_pylist():
                rows = json.loads(text)
                keys += [json.dumps(capture_order(row)) for row in rows[:: -(-len(rows) // per_run)]]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    keys = sorted(tuple(json.loads(r["key"])) for r in runs.select("rows").mapInArrow(sampled, "key string").collect())
    splitters = spark.sparkContext.broadcast([keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else [])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = json.loads(text)
                order = [capture_order(row) for row in rows]
                cuts = [0, *(bisect.bisect_left(order, s) for s in splitters.value), len(rows)]
                found = [(i, run, json.dumps(rows[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.string(), pa.string()))], ["range_no", "run", "rows"])

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        rows = list(LoserTree([iter(json.loads(text)) for text in group["rows"]]))
        merged = pd.DataFrame(rows, columns=FIELDS).astype({"page_id": "Int64", "refers_to": "Int64"})
        return merged.assign(range_no=key[0], position=range(len(rows)))

    cut = runs.select("run", "rows").mapInArrow(slices, "range_no long, run string, rows string")
    return cut.groupBy("range_no").applyInPandas(merge, f"{KINDS}, range_no long, position long")


def read_archives(spark, folder: str) -> DataFrame:
    """The merged index of all archives below ``folder``."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return merge_runs(stored(files.mapInArrow(_runs, "run string, n long, rows string"), "runs"))


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` (page_id, url, html; other columns ignored) as archives and returns their merged index.

    A null html is an empty payload, a null url an empty one, a null page_id a record without number (always a
    response). Rows repeating a page_id and payload are each written. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, folder or fresh_folder(spark, "archives")))
