"""WARC archives of page captures, and a globally ordered index of what they hold.

Writing: a record a page. Of captures with equal payloads the one with the largest id is a response that holds the
payload, the others revisit it. Records are written as text files with the record end as separator, in archives of
bounded size. Reading: archives are parsed record by record by their lengths, and payloads checked against their
digests.

Index: each archive gives a run of its captures, sorted by URL key and time. The runs are cut into ranges of
the key, and every range is merged from its run slices by a loser tree; the ranges follow each other, so all captures
come out in one order, the captures of a URL as one history. A URL with very many captures is cut by time and id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.llm.common import staged
from conform.session import scratch_path

# The record separator and header names of WARC 1.0.
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FIRST_CAPTURE = datetime(2026, 1, 1)
CAPTURE_SPAN = 100_000_000  # seconds
ARCHIVE_BYTES = 8 << 20
INDEX_SCHEMA = ("page_id long, url string, url_key string, captured string, record_type string, payload_bytes long, "
                "payload_digest string, refers_to long")


def capture_time(page_id: int | None) -> datetime:
    """The tables hold no capture times: a second for each id."""
    return FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % CAPTURE_SPAN)


def url_key(url: str | None) -> str:
    """Host labels reversed and lower-cased (A-Z), then path and query: captures of a site sort together."""
    scheme, sep, rest = (url or "").partition("://")
    if not sep:
        return ")" + scheme.split("#")[0]
    host = re.match(r"[^/?#]*", rest).group()
    lower = re.sub("[A-Z]+", lambda m: m.group().lower(), host)
    return ",".join(reversed(lower.split("."))) + ")" + rest[len(host):].split("#")[0]


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    tail = name.rstrip(">").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def _record(page_id: int | None, url: str | None, payload: str, digest_hex: str, size: int, response: int | None) -> str:
    digest = base64.b32encode(bytes.fromhex(digest_hex)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    head = ["WARC/1.0", f"WARC-Type: {'response' if response is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {capture_time(page_id):%Y-%m-%dT%H:%M:%SZ}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if response is not None:
        head += [f"WARC-Refers-To: {_name(response)}", f"WARC-Profile: {REVISIT_PROFILE}"]
        payload, size = "", 0
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + size}"]
    return "\r\n".join(head) + "\r\n\r\n" + http + payload


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One record for each row of ``pages`` (page_id, url, html) in gzip archives below ``path``.

    A null html is an empty payload. Payloads of fewer than ``least_bytes`` bytes are never revisits. Rows that share id and
    payload are responses alike; a row without id never is what others revisit, unless no row has an id:
    then all are responses.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("sha", F.sha1(F.col("payload").cast("binary"))).withColumn("size", F.octet_length("payload").cast("long"))
    digests = staged(pages.sparkSession, p.select("page_id", "sha", "size"), "warc-digests")
    # one narrow row for each payload that occurs more than once
    shared = (digests.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
              .where("n > 1").select(F.col("sha").alias("s"), "response"))
    total = digests.agg(F.sum("size")).first()[0] or 0
    p = p.join(shared, p["sha"] == shared["s"], "left").withColumn(
        "response", F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response")))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, held = 0, 0
        for b in batches:
            numbers, records = [], []
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "size", "response"))):
                if held and held + row[4] > archive_bytes:
                    archive, held = archive + 1, 0
                record = _record(*row)
                held += len(record)
                numbers.append(archive)
                records.append(record)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(records, pa.string())], names=["archive", "value"])

    # about a task an archive: many shuffle partitions don't turn into as many small files
    p = p.select("page_id", "url", "payload", "sha", "size", "response").coalesce(max(1, -(-total // archive_bytes)))
    records = p.mapInArrow(build, "archive int, value string")
    records.write.partitionBy("archive").option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a gzip archive, by the records' own lengths."""
    unpack, data, done = zlib.decompressobj(31), b"", False
    rest = memoryview(content)
    step = 1 << 20

    def more(need: int) -> None:
        nonlocal data, rest, done
        while len(data) < need and not done:
            data += unpack.decompress(rest[:step])
            rest = rest[step:]
            done = not len(rest)

    while True:
        more(1)
        if not data:
            return
        end = data.find(b"\r\n\r\n")
        while end < 0 and not done:
            more(len(data) + step)
            end = data.find(b"\r\n\r\n")
        if not data.startswith(b"WARC/1.0\r\n") or end < 0:
            raise ValueError("not a WARC record")
        head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:])
        begin, size = end + 4, int(head["Content-Length"])
        more(begin + size + 4)
        if data[begin + size:begin + size + 4] != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, data[begin:begin + size]
        data = data[begin + size + 4:]


def _entry(head: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload and digest of {head['WARC-Record-ID']} differ")
    url = head.get("WARC-Target-URI")
    refers = _id(head["WARC-Refers-To"]) if kind == "revisit" else None
    captured = re.sub(r"\D", "", head["WARC-Date"])
    return _id(head["WARC-Record-ID"]), url, url_key(url), captured, kind, size, digest, refers


def _order(entry: tuple) -> tuple:
    return entry[2], entry[3], entry[0] is not None, entry[0] or 0


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A sorted run of captures for each archive: run, seq and the index columns."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    fields = [f.strip().split(" ") for f in INDEX_SCHEMA.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                run = sorted((_entry(*r) for r in parse_archive(b.column("content")[i].as_buffer().to_pybytes())), key=_order)
                columns = list(zip(*run)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("path")[i].as_py()] * len(run), pa.string()), pa.array(range(len(run)), pa.int64()),
                     *(pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields))], names=["run", "seq", *(n for n, _ in fields)])

    return files.select("path", "content").mapInArrow(read, "run string, seq long, " + INDEX_SCHEMA)


class LoserTree:
    """Merges sorted lists: an inner node holds the loser of its match, so a new head plays one match a level."""

    END = ((1,),)

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.head = [((0,), r[0]) if r else self.END for r in runs]
        self.loser, winner = [0] * max(k, 1), [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            if self.head[b] < self.head[a]:
                a, b = b, a
            winner[node], self.loser[node] = a, b
        self.best = winner[1] if k > 1 else 0

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(list, place in it) in order."""
        k = len(self.runs)
        while k and self.head[self.best] != self.END:
            w = self.best
            yield w, self.at[w]
            self.at[w] += 1
            run = self.runs[w]
            self.head[w] = ((0,), run[self.at[w]]) if self.at[w] < len(run) else self.END
            node = (w + k) >> 1
            while node:
                if self.head[self.loser[node]] < self.head[w]:
                    w, self.loser[node] = self.loser[node], w
                node >>= 1
            self.best = w


def merge_runs(spark: SparkSession, runs: DataFrame, range_rows: int = 50_000) -> DataFrame:
    """All captures with ``position``, their place (from 1) in the order of URL key, time and id."""
    runs = staged(spark, runs, "warc-runs")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), runs.count() // range_rows)
    order = [F.col("url_key"), F.col("captured"), F.col("page_id").asc_nulls_first(), F.col("run"), F.col("seq")]
    ranged = runs.repartitionByRange(parts, *order).sortWithinPartitions("run", "seq")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)                            # one range: its rows are bounded by ``parts``
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        ends = [int(e) for e in pc.run_end_encode(t.column("run").combine_chunks()).run_ends.to_numpy()]
        begins = [0, *ends[:-1]]
        keys = list(zip(*(t.column(c).to_pylist() for c in ("page_id", "url", "url_key", "captured"))))
        tree = LoserTree([[_order(k) for k in keys[a:b]] for a, b in zip(begins, ends)])
        rows = [begins[r] + i for r, i in tree]
        part = TaskContext.get().partitionId()
        t = t.take(pa.array(rows, pa.int64())).drop_columns(["run", "seq"])
        t = t.append_column("part", pa.array([part] * len(rows), pa.int32())).append_column("place", pa.array(range(1, len(rows) + 1), pa.int64()))
        yield from t.to_batches()

    merged = staged(spark, ranged.mapInArrow(merge, INDEX_SCHEMA + ", part int, place long"), "warc-index")
    sizes = merged.groupBy("part").agg(F.count("*").alias("n"))   # one row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("part").alias("p"), before.alias("before"))
    return merged.join(sizes, merged["part"] == sizes["p"]).withColumn("position", F.col("place") + F.col("before")).drop("part", "p", "place", "before")


def archive_pages(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, read them back and return the merged index.

    Output: page_id, url, url_key, captured, record_type, payload_bytes, payload_digest, refers_to, position; one row for each
    input row, repeated rows too. A null url has key ")", a null html an empty payload. An empty table gives an
    empty index. Other columns are not read. ``path`` defaults to a new folder below the shared scratch folder.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return merge_runs(spark, read_runs(spark, path))
