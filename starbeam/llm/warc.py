"""WARC archives with revisit records, and their merged capture index.

*Writing.*  Captures whose payloads are equal and long enough share one
response record; the others become revisit records that refer to it.  Each
task writes archives of about ``ARCHIVE_BYTES`` of payload, one gzip member
a record, into the shared folder, and returns a manifest row for each.
Archives carry a fresh name, so a task that runs twice leaves at most an
archive that no manifest names.

*Reading.*  Archives are read back member by member.  The captures of one
archive, sorted by URL key and time, are a run.

*Merging.*  Runs are cut at common splitters (Spark's range partitioning over
URL key, time and record, so the captures of one hot URL spread too) and each
range merges its slices of all runs with a loser tree.  The ranges follow the
index in number, about ``RANGE_ROWS`` captures each, so a task's slices stay
of one size as the index grows.  What comes out is ordered across and within partitions: a URL's capture history in sequence.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen, shared_path

SMALLEST = 1000
ARCHIVE_BYTES = 16 << 20
#: captures of the index that one range merges, about
RANGE_ROWS = 100_000
CRLF = b"\r\n"
PAGE = "<urn:page:{}>"


def url_key(url: str | None) -> str:
    """Sort-friendly form of a URL: reversed host, then path and sorted query, lower case; no scheme, www, port 80/443 or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www[0-9]*\.", "", host)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{where}){parts.path or '/'}" + (f"?{query}" if query else "")


class LoserTree:
    """Merges sorted lists: each inner node holds the loser of its match, so the next item costs one path of comparisons."""

    def __init__(self, runs: list[list[Any]]) -> None:
        self.runs, self.n = runs, len(runs)
        self.at = [0] * self.n
        self.tree = [-1] * max(self.n, 1)
        for i in range(self.n):
            self.play(i)

    def ahead(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; an exhausted run comes last, ties go to the lower run."""
        x, y = self.runs[a], self.runs[b]
        if self.at[b] >= len(y):
            return self.at[a] < len(x) or a < b
        if self.at[a] >= len(x):
            return False
        return (x[self.at[a]], a) < (y[self.at[b]], b)

    def play(self, i: int) -> None:
        """Run i goes up from its leaf; where a place is still free it waits there."""
        node = (i + self.n) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = i
                return
            if self.ahead(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator[Any]:
        while self.n:
            i = self.tree[0]
            if self.at[i] >= len(self.runs[i]):
                return
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.play(i)


def record(kind: str, page: str, url: str, time: str, payload: bytes, digest: str, refers: str | None) -> bytes:
    """One uncompressed WARC record; a revisit holds no payload, its header names the payload's digest and length."""
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {PAGE.format(page)}".encode(), f"WARC-Date: {time}".encode()]
    if url:
        head.append(b"WARC-Target-URI: " + url.encode())
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}".encode())
    if kind == "revisit":
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {PAGE.format(refers)}".encode())
        head.append(f"X-Payload-Length: {len(payload)}".encode())
    body = b"" if kind == "revisit" else payload
    head += [b"Content-Type: text/html", b"Content-Length: " + str(len(body)).encode()]
    return CRLF.join(head) + CRLF + CRLF + body + CRLF + CRLF


def one_line(url: str | None) -> str:
    """A URL fit for a header line."""
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def members(stream: Any, size: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member of a stream."""
    held, offset, d, out, used = b"", 0, zlib.decompressobj(31), [], 0
    while True:
        if not held:
            held = stream.read(size)
            if not held:
                if out or used:
                    raise ValueError("the archive ends inside a record")
                return
        out.append(d.decompress(held))
        used += len(held) - len(d.unused_data)
        held = d.unused_data
        if d.eof:
            yield offset, used, b"".join(out)
            offset += used
            d, out, used = zlib.decompressobj(31), [], 0


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != CRLF + CRLF:
        raise ValueError("a record's length is wrong")
    return fields, rest[:n]


def plan_records(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``pages`` (page_id, url, html, time) with digest, record_type and refers_to.

    Of captures with equal payloads of ``smallest`` bytes or more, the one
    with the largest page_id is the response.  Captures without a page_id
    are always responses and never referred to.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "time").withColumn("digest", F.sha1("html"))
    long = rows.filter((F.octet_length("html") >= smallest) & F.col("page_id").isNotNull())
    shared = long.groupBy("digest").agg(F.max("page_id").alias("_last"), F.min("page_id").alias("_first"))
    shared = shared.filter("_first <> _last").select(F.col("digest").alias("_d"), "_last")
    rows = rows.join(shared, (F.col("digest") == F.col("_d")) & (F.octet_length("html") >= smallest), "left")
    refers = F.when(F.col("_last") != F.col("page_id"), F.col("_last"))
    return rows.select("page_id", "url", "html", "time", "digest", refers.alias("refers_to"))


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records and returns the manifest: path and record count of every archive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, path, n, held = None, "", 0, 0
        done: list[tuple[str, int]] = []
        for batch in batches:
            for page, url, html, time, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    store.create_dir(root, recursive=True)
                    out, path, n, held = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                payload = html.encode()
                kind = "response" if refers is None else "revisit"
                out.write(gzip_member(record(kind, "" if page is None else str(page), one_line(url), time, payload, digest, refers)))
                n, held = n + 1, held + len(payload)
                if held >= archive_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        if done:
            paths, counts = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return planned.select("page_id", "url", "html", "time", "digest", F.col("refers_to").cast("string")).mapInArrow(run, "path string, records long")


RUN = "urlkey string, time string, page string, archive string, offset long, length long, record_type string, payload_bytes long, payload_digest string, refers_to string"


def read_runs(manifest: DataFrame) -> DataFrame:
    """The archives' captures; those of one archive are a sorted run."""
    names = [x.split()[0] for x in RUN.split(", ")]
    types = [pa.int64() if x.endswith("long") else pa.string() for x in RUN.split(", ")]

    def captures(path: str) -> Iterator[tuple]:
        store, at = fs.FileSystem.from_uri(path)
        with store.open_input_stream(at, compression=None) as stream:
            for offset, length, data in members(stream):
                fields, payload = parsed(data)
                kind, page = fields["WARC-Type"], fields["WARC-Record-ID"][len("<urn:page:") : -1]
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                size, refers = len(payload), None
                if kind == "revisit":
                    size, refers = int(fields["X-Payload-Length"]), fields["WARC-Refers-To"][len("<urn:page:") : -1]
                elif hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{path}: the payload at {offset} does not match its digest")
                yield url_key(fields.get("WARC-Target-URI")), fields["WARC-Date"], page, path, offset, length, kind, size, digest, refers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows = sorted(captures(path), key=lambda r: r[:5])
                if len(rows) != n:
                    raise ValueError(f"{path}: {len(rows)} of {n} records")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    # an archive is a unit of work: dealt out by rows, not by bytes
    spark = manifest.sparkSession
    parts = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.repartition(parts).mapInArrow(run, RUN)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All runs' captures in the order of URL key, time and record, across and within partitions.

    ``runs`` is a written table: its rows are counted first.
    """
    names = [x.split()[0] for x in RUN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slices.setdefault(row[3], []).append(row)
        if schema is None:
            return
        for rows in slices.values():  # a shuffle keeps a run's order, but does not promise it
            if any(b[:5] < a[:5] for a, b in zip(rows, rows[1:], strict=False)):
                rows.sort(key=lambda r: r[:5])
        tree = LoserTree([[(r[:5], r) for r in slices[k]] for k in sorted(slices)])
        held: list[tuple] = []
        for _, row in tree:
            held.append(row)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], names=names)

    spark = runs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // range_rows))
    return runs.repartitionByRange(parts, "urlkey", "time", "page", "archive", "offset").mapInArrow(run, RUN)


def archive_pages(pages: DataFrame, smallest: int = SMALLEST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html, time) as WARC archives, reads them back and returns the merged capture index.

    A null html is an empty payload, a null url has no target and the empty
    key, a null page_id an empty record name.  Repeated rows are captures of
    their own; where they share the largest page_id of a payload, each is a
    response.  An empty table writes no archive and gives an empty index.
    """
    folder = shared_path(pages.sparkSession, "warc")
    manifest = frozen(write_archives(plan_records(pages, smallest), folder, archive_bytes), "warc-manifest")
    return merged_index(frozen(read_runs(manifest), "warc-runs"))
