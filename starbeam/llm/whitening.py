"""Embedding whitening by Chebyshev-filtered subspace iteration.

The entries of a vector become whole numbers, ``floor(scale * c)`` (a shift of
all of them by the same number changes no result); every different vector
counts once in the fit.  The leading eigenvectors of their covariance come
from passes over the centred vectors, each of which multiplies a thin block
Q by XᵀX / n: tasks sum their share, Spark adds the shares up, and only the
block, d rows of some numbers, reaches the driver.

One round applies a Chebyshev polynomial of the covariance to the block, by
its three-term recurrence (one pass a degree).  On the interval that holds
the unwanted eigenvalues the polynomial stays within one, above it it grows
fast.  QR and Rayleigh-Ritz follow.  A block is certified when the residual
of every wanted pair, |Vq - eq|, is down to rounding.  The interval's upper
end is the block's smallest Ritz value.  Its lower end comes from a few
Lanczos steps: their smallest Ritz value less its remainder, a bound that
keeps the polynomial from growing at the other end of the spectrum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen

COMPONENTS = 16
#: columns of the block besides the wanted ones
SPARE = 16
DEGREE = 12
ROUNDS = 40
LANCZOS = 10
SCALE = 64
#: residuals, as a share of the largest eigenvalue, at which a pair is certified
CERTIFIED = 2e-14
#: eigenvalues below this share of the largest count as zero: their direction is not determined
ZERO = 1e-12
#: entries beyond this, times the scale, are not whole numbers of double precision
EXACT = 2.0**53
#: vectors a packed row of the fit list holds
PACK_BYTES = 1 << 20


def numbered(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """(vec_id, x): each usable row with the bytes of its whole numbers ``floor(scale * c)``, of 8 bytes each."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("v")
            keep, out = [], []
            for i, entries in enumerate(lists):
                values = entries.values
                if values is None or not len(values) or values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                    if not (np.abs(x) < EXACT).all():  # also NaN and infinite
                        continue
                keep.append(i)
                out.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.array(out, pa.binary())], names=["vec_id", "x"])

    return vectors.select("vec_id", F.col(vector).alias("v")).mapInArrow(run, f"vec_id {id_type}, x binary")


def packed(distinct: DataFrame) -> DataFrame:
    """The fit list with about ``PACK_BYTES`` of vectors in a row (x), all of the same length, and n, their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for x in batch.column("x").to_pylist():
                held.append(x)
                size += len(x)
                if size >= PACK_BYTES:
                    yield one(held)
                    held, size = [], 0
        if held:
            yield one(held)

    def one(rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(rows)], pa.binary()), pa.array([len(rows)], pa.int64())], names=["x", "n"])

    return distinct.select("x").mapInArrow(run, "x binary, n long")


def matrix(x: bytes, d: int) -> np.ndarray:
    return np.frombuffer(x, dtype="<i8").reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``, rounded once: n * x - sums is a whole number, exact in 64 bits where it fits."""
    s = np.array(sums, dtype=object)
    top = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))), default=0)
    if n * top + max((abs(v) for v in sums), default=0) < 2**62:
        return (n * x - s.astype(np.int64)) / n
    return ((n * x.astype(object) - s) / n).astype(np.float64)


@dataclass(frozen=True)
class FitList:
    """The different vectors: their packed table, dimension, number and sums for each dimension."""

    blocks: DataFrame
    d: int
    n: int
    sums: list[int]

    def product(self, q: np.ndarray) -> np.ndarray:
        """V @ q for the covariance V: one pass over the vectors."""
        d, n, sums, wide = self.d, self.n, self.sums, q.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, wide))
            for batch in batches:
                for x in batch.column("x").to_pylist():
                    c = centred(matrix(x, d), n, sums)
                    total += c.T @ (c @ q)
            yield pa.RecordBatch.from_arrays([pa.array(range(d * wide), pa.int32()), pa.array(total.ravel())], names=["at", "v"])

        parts = self.blocks.select("x").mapInArrow(run, "at int, v double")
        out = np.zeros(d * wide)
        # d times the block's width numbers, whatever the data's size
        for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
            out[r.at] = r.v
        return out.reshape(d, wide) / n

    def trace(self) -> float:
        """The sum of the covariance's diagonal, in one pass."""
        d, n, sums = self.d, self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = [float((centred(matrix(x, d), n, sums) ** 2).sum()) for x in batch.column("x").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.float64())], names=["v"])

        return (self.blocks.select("x").mapInArrow(run, "v double").agg(F.sum("v")).first()[0] or 0.0) / n


def fit_list(x: DataFrame) -> FitList:
    """The different vectors of a table (x, their bytes).

    The dimension is the one that most of them have (of several, the
    largest); vectors of another length have no place in it.
    """
    distinct = frozen(x.select("x").distinct(), "whitening-distinct")
    sizes = distinct.groupBy((F.octet_length("x") / 8).cast("int").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return FitList(distinct.withColumn("n", F.lit(0)), 0, 0, [])
    d, n = best.d, best.n
    blocks = frozen(packed(distinct.filter(F.octet_length("x") == 8 * d)), "whitening-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("x").to_pylist():
                m = matrix(x, d)
                # a block's sums fit 64 bits unless its entries come near the limit of exact doubles
                total = m.sum(axis=0) if abs(m).max() * len(m) < 2**62 else m.astype(object).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(v) for v in total.tolist()])], names=["at", "s"])

    parts = blocks.select("x").mapInArrow(run, "at int, s string")
    sums = [0] * d
    for r in parts.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # d rows
        sums[r.at] = int(r.s)
    return FitList(blocks, d, n, sums)


def lanczos_low(fit: FitList, rng: np.random.Generator, steps: int) -> float:
    """A lower bound of the covariance's spectrum: the smallest Ritz value of a few Lanczos steps less the remainder."""
    steps = min(steps, fit.d)
    basis = [v := rng.standard_normal(fit.d)]
    basis[0] = v / np.linalg.norm(v)
    diagonal, off = [], []
    for _ in range(steps):
        w = fit.product(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):  # orthogonal to all before, twice for rounding
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        off.append(float(np.linalg.norm(w)))
        if off[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        basis.append(w / off[-1])
    t = np.diag(diagonal) + np.diag(off[: len(diagonal) - 1], 1) + np.diag(off[: len(diagonal) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - off[-1])


def filtered(fit: FitList, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the given degree on [low, high], scaled to one at ``top``, of V, applied to q."""
    half, mid = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - mid)
    y, before = (fit.product(q) - mid * q) * (sigma / half), q
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        y, before = 2 * (new / half) * (fit.product(y) - mid * y) - sigma * new * before, y
        sigma = new
    return y


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors (columns) by falling eigenvalue, with the share of the trace and the checks of the fit."""

    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    residual: float
    identity_error: float


def leading(fit: FitList, k: int = COMPONENTS, spare: int = SPARE, degree: int = DEGREE, seed: int = 7) -> Components:
    """The k leading eigenpairs of the fit list's covariance (fewer where its rank is lower)."""
    rng = np.random.default_rng(seed)
    wide = min(fit.d, k + spare)
    empty = Components(np.zeros((fit.d, 0)), np.zeros(0), np.zeros(0), 0.0, 0.0)
    if fit.n < 2 or not wide:
        return empty
    k = min(k, fit.d)
    q = np.linalg.qr(rng.standard_normal((fit.d, wide)))[0]
    low, best = None, np.inf
    for _ in range(ROUNDS):
        z = fit.product(q)
        h = q.T @ z
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        if values[0] <= 0:
            return empty
        residual = float(np.linalg.norm(z[:, :k] - q[:, :k] * values[:k], axis=0).max() / values[0])
        # certified, or down to the rounding of the passes: another round no longer helps
        if residual <= CERTIFIED or (best < 1e-12 and residual > best / 4):
            break
        best = min(best, residual)
        if low is None:
            low = lanczos_low(fit, rng, LANCZOS) if wide < fit.d else 0.0
        high = float(values[-1])
        low = min(low, 0.9 * high)
        if high <= ZERO * values[0]:  # the block holds the whole range
            q = np.linalg.qr(z)[0]
            continue
        q = np.linalg.qr(filtered(fit, q, low, high, float(values[0]), degree))[0]
    else:
        raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {residual:.1e} of the largest eigenvalue")
    good = values[:k] > ZERO * values[0]
    vectors, values = q[:, :k][:, good], values[:k][good]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    scaled = vectors / np.sqrt(values)
    # one more pass: the covariance of what whitening gives
    error = float(np.abs(scaled.T @ fit.product(scaled) - np.eye(len(values))).max())
    return Components(vectors, values, values / fit.trace(), residual, error)


def whitened(vectors: DataFrame, vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE, spare: int = SPARE,
             degree: int = DEGREE) -> DataFrame:
    """For every usable row of ``vectors`` (vec_id and the named array) and component up to k: vec_id, component, n,
    deviation, whitened, explained, identity_error, eigenvalue.

    Rows whose array is null or empty, or holds a null, a NaN, an infinite
    entry or one of 2^53 / scale and more, are left out, as are those of
    another length than most different vectors have.  Equal vectors count
    once in the fit; each row gets its own results.  Components are as many
    as the different vectors determine: none for an empty table or where all
    are equal, so the result is empty then.  Null and repeated ids pass
    through.  ``deviation``, the sum of (n x - S)² as a whole number, is null
    where it does not fit a long.  Other columns are not read.
    """
    rows = frozen(numbered(vectors, vector, scale), "whitening-rows")
    fit = fit_list(rows)
    found = leading(fit, k, spare, degree)
    d, n, sums = fit.d, fit.n, fit.sums
    scaled = found.vectors / np.sqrt(found.values)
    explained, values, error = found.explained.tolist(), found.values.tolist(), found.identity_error
    m = len(values)
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            x = matrix(b"".join(batch.column("x").to_pylist()), d)
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"]
            again = pa.array(np.repeat(np.arange(size), m))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(again),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), size)),
                pa.array(np.full(size * m, n, dtype=np.int64)),
                pa.array(deviations(x, n, sums), pa.int64()).take(again),
                pa.array((centred(x, n, sums) @ scaled).ravel()),
                pa.array(explained * size, pa.float64()),
                pa.array(np.full(size * m, error)),
                pa.array(values * size, pa.float64()),
            ], names=names)

    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, eigenvalue double")
    return rows.filter(F.octet_length("x") == 8 * d if m else F.lit(False)).mapInArrow(run, schema)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n x - S)² over the dimensions, exact; None where it does not fit 63 bits."""
    if not len(x):
        return []
    top = n * int(np.abs(x).max()) + max(abs(s) for s in sums)
    if top * top * x.shape[1] < 2**63:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    # in two halves of 32 bits would do as well; whole numbers of any size are simpler, and this is rare
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [v if v < 2**63 else None for v in exact.tolist()]
