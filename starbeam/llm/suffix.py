"""Suffix-array dedup by a difference cover, to the depth that a repeat needs.

Only the first ``LENGTH`` bytes of a suffix matter: a byte goes where such a
prefix also begins in a document with a smaller id.  So the sort is one into
classes of equal prefixes, and the recursion ends as soon as names are that
long:

1. *Sample.*  ``COVER`` is a difference cover modulo ``PERIOD``: for any two
   positions there is a shift below the period that takes both to sampled
   ones.  Sampled suffixes are sorted by their first ``LENGTH - PERIOD + 1``
   bytes and named; a name that stands once ends its suffix.
2. *Recurse on names.*  Sampled suffixes whose name, and whose successor's
   name one period on, both stand elsewhere are sorted again by a prefix of
   ``LENGTH + PERIOD - 1`` bytes.  One that begins in a smaller document
   settles ``PERIOD`` suffixes at once.
3. *Merge the rest.*  A suffix that is not settled, and from which a shift
   reaches a name that stands elsewhere, is sorted by its ``LENGTH`` bytes.
   By induction over the documents, the first holder of a prefix is never
   settled, so the others still meet it.
4. *Compare neighbours.*  In each sorted run of equal prefixes, those after
   the first document's are repeats.

Prefixes are compared by hashes of 60 bits and more of their bytes (36 and more
in the first step, whose accidents only cost time), not letter by letter, and
the sort is by hash: the order between different prefixes is never used.
Equal texts are laid out once; all but the one with the smallest id are
repeats from end to end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packed import (
    LAST, PACKS, Batch, answered, bounds, bucket_count, contents, covered, over_batches, packs, record, sorted_groups, span_length, spans_of,
    text_batches,
)
from .wordhash import mix, range_hashes

LENGTH = 50
#: a perfect difference set: every difference modulo 31 but 0 occurs once
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
RESULT = "content binary, ord long, n_bytes long, bounds array<long>, kept binary"
_OTHER = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D))


def text_of(batch: Batch, pos: np.ndarray) -> np.ndarray:
    return np.searchsorted(batch.at, pos, side="right") - 1


def sampled(batch: Batch, depth: int) -> np.ndarray:
    """Sampled positions with ``depth`` bytes of their text ahead; texts are sampled from their own first byte."""
    size = np.diff(batch.at)
    offset = np.arange(len(batch.raw), dtype=np.int64) - np.repeat(batch.at[:-1], size)
    left = np.repeat(size, size) - offset
    inside = np.zeros(PERIOD, dtype=bool)
    inside[list(COVER)] = True
    return np.flatnonzero(inside[offset % PERIOD] & (left >= depth))


def named(batch: Batch, at: np.ndarray, depth: int, buckets: int) -> pa.RecordBatch:
    low = range_hashes(_OTHER[batch.raw], at, at + depth) & np.uint64(0xFFFFFF)
    return packs(batch, range_hashes(batch.raw, at, at + depth), at, buckets, low)


def repeats(batches: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per text: content, ord, n_bytes, spans (the bytes of prefixes that begin in a smaller document) and kept, the text without them."""
    short, long = length - PERIOD + 1, length + PERIOD - 1
    buckets = bucket_count(batches)

    def sample(batch: Batch) -> Iterator[pa.RecordBatch]:
        at = sampled(batch, short)
        if len(at):
            yield packs(batch, range_hashes(batch.raw, at, at + short), at, buckets, exact=False)

    def again(key: np.ndarray) -> np.ndarray:
        order, group = sorted_groups(key)
        yes = np.empty(len(key), dtype=bool)
        yes[order] = (np.bincount(group) > 1)[group]
        return yes

    def recurse(batch: Batch, hits: np.ndarray) -> Iterator[pa.RecordBatch]:
        shared = np.zeros(len(batch.raw) + PERIOD, dtype=bool)
        shared[hits] = True
        at = hits[shared[hits + PERIOD]]
        at = at[at + long <= batch.at[text_of(batch, at) + 1]] if len(at) else at
        if len(at):
            yield named(batch, at, long, buckets)

    def smaller(key: np.ndarray, rank: np.ndarray) -> np.ndarray:
        order, group = sorted_groups(key)
        first = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
        np.minimum.at(first, group, rank[order])
        yes = np.empty(len(key), dtype=bool)
        yes[order] = rank[order] > first[group]
        return yes

    def merge(batch: Batch, hits: np.ndarray, settled: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(hits):
            return
        text = text_of(batch, hits)
        begin, end = np.maximum(hits - (PERIOD - 1), batch.at[text]), np.minimum(hits, batch.at[text + 1] - length) + 1
        some = begin < end
        open_ = covered(len(batch.raw), begin[some], end[some]) & ~covered(len(batch.raw), settled, settled + PERIOD)
        at = np.flatnonzero(open_)
        if len(at):
            yield named(batch, at, length, buckets)

    def remove(batch: Batch, settled: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        gone = covered(len(batch.raw), np.concatenate([settled, starts]), np.concatenate([settled + long, starts + length]))
        rows: list[list] = [[], [], [], [], []]
        for i in range(len(batch.n)):
            raw, mask = batch.raw[batch.at[i] : batch.at[i + 1]], gone[batch.at[i] : batch.at[i + 1]]
            values = (batch.content[16 * i : 16 * i + 16], int(batch.ord[i]), len(raw), bounds(mask), raw[~mask].tobytes())
            for column, v in zip(rows, values, strict=True):
                column.append(v)
        yield record(RESULT, rows)

    hits = answered(over_batches(batches, sample, PACKS), again, exact=False)
    settled = answered(over_batches(batches, recurse, PACKS, hits), smaller)
    starts = answered(over_batches(batches, merge, PACKS, hits, settled), smaller)
    out = over_batches(batches, remove, RESULT, settled, starts)
    return out.select("content", "ord", "n_bytes", spans_of("bounds").alias("spans"), "kept")


def by_row(docs: DataFrame, texts: DataFrame, length: int, copy: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` with the columns of their texts, or those of ``copy`` where a smaller doc_id has the text."""
    both = contents(docs).select("doc_id", "content").join(texts, "content")
    is_copy = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) != F.col("ord")) & (F.col("n_bytes") >= length)
    return both.select("doc_id", "n_bytes", *[F.when(is_copy, v).otherwise(F.col(c)).alias(c) for c, v in copy.items()])


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_bytes, spans (maximal removed runs of bytes, as begin and end) and kept.

    ``kept`` is what is left of the text's bytes; a cut may fall inside a
    character.  Rows are treated as by ``dedup_suffixes``.
    """
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    return by_row(docs, repeats(text_batches(docs), length), length, {"spans": whole, "kept": F.lit(b"")})


def dedup_suffixes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    A null text counts as empty.  Of equal texts only the rows with the
    smallest doc_id are judged on the other documents; the rest is removed
    whole (if ``length`` bytes long).  Rows of one doc_id don't remove each
    other's bytes.  A row without a doc_id comes after all others.  An empty
    table gives an empty result.
    """
    texts = repeats(text_batches(docs), length)
    # digests of the kept texts, before any row leaves its task
    texts = texts.select("content", "ord", "n_bytes", span_length("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                         F.sha2("kept", 256).alias("kept_sha256"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return by_row(docs, texts, length, {"n_removed": F.col("n_bytes"), "n_spans": F.lit(1).cast("long"), "kept_sha256": nothing})
