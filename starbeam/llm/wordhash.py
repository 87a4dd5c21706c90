"""Word positions and hashes of Arrow text columns, without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2^64, of an odd number and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, _BASE), np.full(size, _UNBASE)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0][:n], _powers[1][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and each text's offset (one more than there are texts)."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``, in order."""
    n = len(raw)
    ink = ~_SPACE[raw]
    cut = np.zeros(n + 1, dtype=bool)  # a text begins here
    cut[at] = True
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | cut[:n]))
    after = np.empty(n, dtype=bool)
    after[n - 1 :] = False
    after[: max(n - 1, 0)] = ink[1:]
    ends = np.flatnonzero(ink & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice ``values[start:end]``, by prefix sums."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * down[starts]
    return mix(poly ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
