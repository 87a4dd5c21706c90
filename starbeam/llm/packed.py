"""Position-level joins over whole texts, in packs instead of rows.

The different texts of a table are laid out in batches of a few megabytes,
one row each, with the bytes back to back.  An operator sends what it knows
about positions (a hash and the position) from each batch to buckets by hash,
as one binary per (batch, bucket); a bucket decides which positions count and
answers each batch with one binary.  A position costs six to twelve bytes on
the way instead of a row.  The number of buckets follows the input, so a
bucket's work stays the same size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen

BATCH_BYTES = 2 << 20
#: stands for a null doc_id
LAST = int(np.iinfo(np.int64).max)
#: bytes of text whose positions share a bucket
BUCKET_BYTES = 6 << 20

#: ``data`` holds the bytes compressed, ``at`` the texts' offsets in them
BATCHES = "batch long, data binary, at binary, ord binary, n binary, content binary"
#: most texts of a batch, so that a text's number in it takes two bytes
BATCH_TEXTS = 60_000
PACKS = "bucket int, batch long, key binary, low binary, pos binary, text binary"
REPLIES = "batch long, pos binary"


class Batch(NamedTuple):
    """Texts back to back: ``raw[at[i]:at[i + 1]]`` is text i; ``ord`` is its smallest id, ``n`` how many rows have it.

    ``num`` numbers the texts by id: texts of one id share a number.  Numbers
    and batch ids ascend with the ids, so (batch id, number) orders the
    corpus; texts without an id come last, in the order of their content.
    """

    id: int
    raw: np.ndarray
    at: np.ndarray
    ord: np.ndarray
    n: np.ndarray
    content: bytes
    num: np.ndarray


def contents(docs: DataFrame) -> DataFrame:
    """doc_id and content (MD5 of the text; null counts as empty) of every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.unhex(F.md5(text)).alias("content"), text.alias("text"))


def text_batches(docs: DataFrame, size: int = BATCH_BYTES) -> DataFrame:
    """The different texts of ``docs`` (doc_id, text) in batches, by their smallest doc_id; a null one counts as larger than any other."""
    spark, last = docs.sparkSession, F.lit(LAST)
    texts = contents(docs).groupBy("content").agg(
        F.min(F.coalesce(F.col("doc_id").cast("long"), last)).alias("ord"), F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartitionByRange(parts, "ord", "content").sortWithinPartitions("ord", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        held: list[tuple[bytes, bytes, int, int]] = []
        total = 0

        def row() -> pa.RecordBatch:
            nonlocal serial, total
            at = np.cumsum([0, *(len(t) for _, t, _, _ in held)], dtype=np.int64)
            data = zstandard.ZstdCompressor(level=6).compress(b"".join(t for _, t, _, _ in held))
            columns = [serial, data, at.tobytes(), np.array([x[2] for x in held], np.int64).tobytes(),
                       np.array([x[3] for x in held], np.int64).tobytes(), b"".join(c for c, _, _, _ in held)]
            serial, total = serial + 1, 0
            held.clear()
            return record(BATCHES, [[x] for x in columns])

        for batch in batches:
            for c, t, o, n in zip(*(batch.column(x).to_pylist() for x in ("content", "text", "ord", "n")), strict=True):
                data = t.encode()
                full = total + len(data) > size or len(held) >= BATCH_TEXTS
                if held and full and (o != held[-1][2] or o == LAST):
                    yield row()
                held.append((c, data, o, n))
                total += len(data)
        if held:
            yield row()

    return frozen(texts.mapInArrow(run, BATCHES), "text-batches")


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


def bounds(mask: np.ndarray) -> list[int]:
    """Where each run of true values begins and ends, in turn."""
    return np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()


def spans_of(bounds: str) -> Column:
    """``bounds`` as an array of (begin, end)."""
    begins = F.filter(bounds, lambda x, i: i % 2 == 0)
    return F.transform(begins, lambda x, i: F.struct(x.alias("begin"), F.get(bounds, 2 * i + 1).alias("end")))


def span_length(spans: str) -> Column:
    """What the spans hold, all together."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])


def record(schema: str, columns: list[list]) -> pa.RecordBatch:
    """An Arrow batch of a schema such as ``a long, b binary``."""
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


def batch_of(row: dict) -> Batch:
    nums = lambda c: np.frombuffer(row[c], dtype=np.int64)
    order = nums("ord")
    num = np.zeros(len(order), dtype=np.int64)
    num[1:] = np.cumsum((order[1:] != order[:-1]) | (order[1:] == LAST))
    at = nums("at")
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(int(at[-1]), 1))
    return Batch(row["batch"], np.frombuffer(data, dtype=np.uint8), at, order, nums("n"), row["content"], num)


def over_batches(batches: DataFrame, work: Callable[..., Iterator[pa.RecordBatch]], schema: str, *replies: DataFrame) -> DataFrame:
    """``work(batch, positions, ...)`` for each batch; ``positions`` are a table's answers to it, sorted, in any number of tables."""
    n = len(replies)
    for i, reply in enumerate(replies):
        got = reply.groupBy("batch").agg(F.collect_list("pos").alias(f"pos{i}"))
        batches = batches.join(got, "batch", "left")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in stream:
            for i in range(part.num_rows):
                row = {c: part.column(c)[i].as_py() for c in part.schema.names}
                positions = [np.sort(np.concatenate([undeltas(x) for x in row[f"pos{k}"] or []] or
                                                    [np.zeros(0, np.uint32)])).astype(np.int64) for k in range(n)]
                yield from work(batch_of(row), *positions)

    return batches.mapInArrow(run, schema)


def packs(batch: Batch, key: np.ndarray, pos: np.ndarray, buckets: int, low: np.ndarray | None = None, exact: bool = True) -> pa.RecordBatch:
    """One pack per bucket: what is known of positions ``pos`` (ascending) with hash ``key``.

    ``exact`` sends 56 bits (32 of the hash, 24 of ``low``, which with the bucket
    make 60 and more) and the text's number; otherwise 32 bits go, for a first sieve.
    """
    where = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(where.astype(np.uint16) if buckets < 65536 else where, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=buckets))])
    sent, pos = key[order].astype(np.uint32), pos[order].astype(np.uint32)
    if exact:
        text = batch.num[np.searchsorted(batch.at, pos, side="right") - 1].astype(np.uint16)
        low = low[order].astype(np.uint32)
    rows: list[list] = [[], [], [], [], [], []]
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        s = slice(cuts[b], cuts[b + 1])
        extra = (low[s].view(np.uint8).reshape(-1, 4)[:, :3].tobytes(), planes(np.diff(text[s], prepend=np.uint16(0)))) if exact else (None, None)
        values = (b, batch.id, sent[s].tobytes(), extra[0], deltas(pos[s]), extra[1])
        for column, v in zip(rows, values, strict=True):
            column.append(v)
    return record(PACKS, rows)


def planes(values: np.ndarray) -> bytes:
    """16-bit numbers as all low bytes, then all high ones, which the shuffle's compression shrinks."""
    return values.astype(np.uint16).view(np.uint8).reshape(-1, 2).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(2, -1).T).view(np.uint16).reshape(-1)


def deltas(pos: np.ndarray) -> bytes:
    """Ascending positions as 16-bit steps where all fit, else as they are (told apart by their first byte)."""
    step = np.diff(pos, prepend=np.uint32(0))
    if len(step) and int(step[1:].max(initial=0)) < 65536:
        return b"\2" + pos[:1].tobytes() + planes(step[1:])
    return b"\4" + pos.tobytes()


def undeltas(data: bytes) -> np.ndarray:
    if data[0] == 4:
        return np.frombuffer(data, dtype=np.uint32, offset=1)
    first = np.frombuffer(data, dtype=np.uint32, count=1, offset=1)
    return np.cumsum(np.concatenate([first, unplanes(data[5:])]), dtype=np.int64).astype(np.uint32)


def answered(sent: DataFrame, decide: Callable[..., np.ndarray], exact: bool = True) -> DataFrame:
    """Each bucket's ``decide`` says which of its positions count; they go back to their batches.

    It gets (key) of a first sieve, else (key, rank), where ranks ascend with the
    texts' ids and texts of one id share a rank.
    """
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        gathered = lambda c, kind: np.concatenate([np.frombuffer(r[c], dtype=kind) for r in rows])
        if exact:
            index = {b: i for i, b in enumerate(sorted({r["batch"] for r in rows}))}
            numbers = [np.cumsum(unplanes(r["text"]), dtype=np.int64) for r in rows]
            rank = np.concatenate([n + (index[r["batch"]] << 16) for n, r in zip(numbers, rows, strict=True)])
            low = np.concatenate([np.frombuffer(r["low"], dtype=np.uint8).reshape(-1, 3) for r in rows]).astype(np.uint64)
            low = low[:, 0] | low[:, 1] << np.uint64(8) | low[:, 2] << np.uint64(16)
            yes = decide(gathered("key", np.uint32).astype(np.uint64) << np.uint64(24) | low, rank)
        else:
            yes = decide(gathered("key", np.uint32))
        out: tuple[list, list] = ([], [])
        at = 0
        for r in rows:
            pos = undeltas(r["pos"])
            mine = yes[at : at + len(pos)]
            at += len(pos)
            if mine.any():
                out[0].append(r["batch"])
                out[1].append(deltas(pos[mine]))
        return pa.Table.from_batches([record(REPLIES, list(out))])

    return frozen(sent.groupBy("bucket").applyInArrow(run, REPLIES), "replies")


def sorted_groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of the keys, and the number of its group for each place of that order."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    group = np.zeros(len(k), dtype=np.int64)
    group[1:] = np.cumsum(k[1:] != k[:-1])
    return order, group


def bucket_count(batches: DataFrame, size: int = BUCKET_BYTES) -> int:
    """Enough buckets for ``size`` bytes of text each, at about three bytes of text to one as it is kept."""
    total = batches.agg(F.coalesce(F.sum(F.octet_length("data").cast("long")), F.lit(0))).first()[0]
    return max(1, -(-3 * total // size))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of 0 .. n - 1: inside any of the ranges."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.subtract.at(step, ends, 1)
    return np.cumsum(step[:n]) > 0
