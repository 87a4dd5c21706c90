"""Substring dedup: fixed-block anchors, rolling probes, extension to exact repeats.

A window is ``WINDOW`` consecutive words of one document.  Every document is
cut into blocks of ``BLOCK`` words that don't overlap; these are the anchors.
As ``WINDOW >= 2 * BLOCK - 1``, each window holds a whole block, so a window
that stands at two places is found by probing: every rolling run of ``BLOCK``
words looks for an equal anchor of another place.  A hit is extended by up to
``WINDOW - BLOCK`` words to either side, and the windows around it are
compared in full; runs of windows that stand elsewhere too are the maximal
repeats.

Texts that several documents share are laid out once.  All their windows
stand elsewhere by that alone, and they serve the others as anchors.  No pair
of places is made: a bucket counts the places of each key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import (
    PACKS, Batch, answered, bounds, bucket_count, contents, covered, over_batches, packs, record, sorted_groups, span_length, spans_of,
    text_batches,
)
from .wordhash import mix, range_hashes, word_spans

WINDOW = 35
RESULT = "content binary, n_words long, bounds array<long>, kept string"


def hashed_words(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of every word, and each text's first word (one more than there are texts)."""
    starts, ends, text = word_spans(batch.raw, batch.at)
    first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(batch.at) - 1))]).astype(np.int64)
    return range_hashes(batch.raw, starts, ends), text, first


def rolling(text: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` words of one text begin."""
    if len(text) < width:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(text[width - 1 :] == text[: len(text) - width + 1])


def repeated_words(batches: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per text: content, n_words, spans (the words inside a window that stands elsewhere too) and kept, its other words."""
    block = (window + 1) // 2
    buckets = bucket_count(batches)

    def probe(batch: Batch) -> Iterator[pa.RecordBatch]:
        h, text, first = hashed_words(batch)
        at = rolling(text, block)
        anchor = (at - first[text[at]]) % block == 0
        # the last bit of a key says whether its place is an anchor; equal runs differ in it only
        key = range_hashes(h, at, at + block) << np.uint64(1) | anchor.astype(np.uint64)
        yield packs(batch, key, at, buckets, exact=False)

    def hit(key: np.ndarray) -> np.ndarray:
        order, group = sorted_groups(key >> np.uint32(1))
        anchors = np.bincount(group, weights=(key[order] & np.uint32(1)).astype(np.float64))
        places = np.bincount(group)
        yes = np.empty(len(key), dtype=bool)
        yes[order] = ((anchors > 0) & (places > 1))[group]
        return yes

    def extend(batch: Batch, hits: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(hits):
            return
        h, text, first = hashed_words(batch)
        begin, end = first[text[hits]], first[text[hits] + 1]
        low, high = np.maximum(hits - (window - block), begin), np.minimum(hits, end - window) + 1
        some = low < high
        at = np.flatnonzero(covered(len(h), low[some], high[some]))
        key = range_hashes(h, at, at + window)
        more = range_hashes(mix(h ^ np.uint64(0x5851F42D4C957F2D)), at, at + window)
        yield packs(batch, key, at, buckets, more & np.uint64(0xFFFFFF))

    def elsewhere(key: np.ndarray, rank: np.ndarray) -> np.ndarray:
        order, group = sorted_groups(key)
        yes = np.empty(len(key), dtype=bool)
        yes[order] = (np.bincount(group) > 1)[group]
        return yes

    def remove(batch: Batch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, text, first = hashed_words(batch)
        gone = covered(len(text), starts, starts + window)
        count = np.diff(first)
        rows: list[list] = [[], [], [], []]
        data = batch.raw.tobytes()
        for i in range(len(count)):
            found = data[batch.at[i] : batch.at[i + 1]].split()  # bytes: splits at ASCII white space only
            mask = gone[first[i] : first[i + 1]]
            if batch.n[i] > 1 and count[i] >= window:
                mask = np.ones(count[i], dtype=bool)
            kept = b" ".join(compress(found, (~mask).tolist()) if mask.any() else found)
            values = (batch.content[16 * i : 16 * i + 16], int(count[i]), bounds(mask), kept.decode())
            for column, v in zip(rows, values, strict=True):
                column.append(v)
        yield record(RESULT, rows)

    hits = answered(over_batches(batches, probe, PACKS), hit, exact=False)
    windows = answered(over_batches(batches, extend, PACKS, hits), elsewhere)
    out = over_batches(batches, remove, RESULT, windows)
    return out.select("content", "n_words", spans_of("bounds").alias("spans"), "kept")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, spans (maximal removed runs of words, as begin and end) and
    kept, the other words with one space between.  Rows are treated as by ``dedup_substrings``."""
    result = repeated_words(text_batches(docs), window)
    return contents(docs).select("doc_id", "content").join(result, "content").drop("content")


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, n_spans (maximal removed runs).

    A null text counts as empty.  Repeated rows are documents of their own,
    so each holds the other's windows; they get equal results.  An empty table
    gives an empty result.  Keys are hashes of the words of 60 bits and more.
    """
    result = repeated_words(text_batches(docs), window)
    # digests of the kept texts, before any row leaves its task
    result = result.select("content", "n_words", span_length("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                           F.sha2("kept", 256).alias("kept_sha256"))
    ids = contents(docs).select("doc_id", F.col("content"))
    return ids.join(result, "content").select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")
