"""Embedding whitening by bit-sliced cross-products.

Every entry c becomes the integer x = floor(64 c) + 1000000. The fit list holds
each distinct x vector once. Its cross-products are counted, not multiplied: in
a block of rows every dimension is shifted to start at 0 and cut into bit
planes, the bits of a plane are packed across the rows into 64-bit words, and
the number of common bits of two planes, weighted by their powers of two, adds
up to the exact sum of products. Sums are carried between tasks as integers of
any size. The driver gets one number for each pair of dimensions; it subtracts
the products of the sums as integers, so centring loses nothing, and only then
goes to floating point for the eigenvectors, which ``eigh`` finds and rotations
in extended precision refine.

The cost grows with the rows and with the square of the planes (dimensions
times bits that their values span); a task holds one block of rows and the
matrix of its dimensions.

Defined cases: rows with a null vector, a null or non-finite entry, an entry of
2^56 or more, or no entry at all are left out; so are rows whose vector has
another length than the commonest (of equally common ones the longest), as one
matrix has one number of dimensions. Repeated rows and rows with a null id are
returned each. Components without variance (fewer distinct vectors than
dimensions, constant dimensions) are returned with a null ``whitened`` value.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtone.llm.common import remove, stored

SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 62
#: Rows whose bits are packed together.
BLOCK = 8192
#: Sums leave a task in so many numbers of 40 bits each.
LIMBS, LIMB = 5, 40


def integers(vec: Column) -> Column:
    """The integer vector of a vector."""
    return F.transform(vec, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows whose vectors are whole, of every length."""
    bad = F.exists(vec_col, lambda c: F.coalesce(
        F.isnan(c.cast("double")) | (F.abs(c.cast("double")) * SCALE >= float(LIMIT)), F.lit(True)))
    whole = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ~bad
    return df.where(whole).select(F.col(id_col).alias("id"), integers(F.col(vec_col)).alias("x"))


# ---- exact sums -----------------------------------------------------------

def _type(bound: int):
    """int64 where numbers up to ``bound`` fit, else Python's own integers."""
    return np.int64 if bound < LIMIT else object


def planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of every bit plane of ``u`` (rows by dimensions, unsigned), by dimension and bit."""
    rows, dims = u.shape
    width = np.array([int(x).bit_length() for x in u.max(axis=0)])
    padded = np.zeros((-(-rows // 64) * 64, dims), dtype=np.uint64)
    padded[:rows] = u
    words, dim, bit = [], [], []
    for b in range(int(width.max(initial=0))):
        own = np.flatnonzero(width > b)
        bits = ((padded[:, own] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        words.append(np.packbits(bits.T, axis=1).view(np.uint64))
        dim.append(own)
        bit.append(np.full(len(own), b))
    if not words:
        return np.empty((0, 1), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    words, dim, bit = np.concatenate(words), np.concatenate(dim), np.concatenate(bit)
    order = np.lexsort((bit, dim))
    return words[order], dim[order], bit[order]


def cross_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (sums, sums of products) of the columns of ``y`` (int64, at most BLOCK rows)."""
    rows, dims = y.shape
    low = y.min(axis=0)
    words, dim, bit = planes(y.view(np.uint64) - low.view(np.uint64))
    common = np.zeros((len(dim), len(dim)), dtype=np.int64)
    for p in range(len(dim)):
        common[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
        common[p:, p] = common[p, p:]
    top = int(bit.max(initial=0)) + 1
    kind = _type(rows << 2 * top)
    weight = np.array([1 << int(b) for b in bit], dtype=kind)
    shifted, total = np.zeros((dims, dims), dtype=kind), np.zeros(dims, dtype=kind)
    if len(dim):
        starts = np.flatnonzero(np.concatenate(([True], dim[1:] != dim[:-1])))
        held = dim[starts]  # the dimensions that vary
        weighted = common.astype(kind) * weight[:, None] * weight[None, :]
        shifted[np.ix_(held, held)] = np.add.reduceat(np.add.reduceat(weighted, starts, axis=0), starts, axis=1)
        total[held] = np.add.reduceat(np.diagonal(common).astype(kind) * weight, starts)
    # back from the shifted numbers u = y - low
    most = max(abs(int(y.min())), abs(int(y.max())))
    kind = _type(8 * rows * max(most, 1) ** 2)
    shifted, total, low = shifted.astype(kind), total.astype(kind), low.astype(kind)
    products = shifted + np.outer(low, total) + np.outer(total, low) + rows * np.outer(low, low)
    return total + rows * low, products


def _vectors(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows without ``OFFSET``: it changes no covariance, and small numbers have fewer bits."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, dims) - OFFSET


def _limbs(number: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(number & (1 << LIMB) - 1)
        number >>= LIMB
    return [*out, number]


def _scatter(dims: int):
    """Rows (i, j, c0..c4) of a task: the number of vectors (-1, -1), sums (-1, j), products (i, j >= i)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for batch in batches:
            vectors = _vectors(batch.column(0), dims)
            for at in range(0, len(vectors), BLOCK):
                s, c = cross_products(np.ascontiguousarray(vectors[at:at + BLOCK]))
                sums, products = sums + s, products + c
            n += len(vectors)
        if not n:
            return
        i, j = np.triu_indices(dims)
        rows = [(-1, -1, n), *((-1, d, s) for d, s in enumerate(sums)), *zip(i, j, products[i, j])]
        parts = list(zip(*(_limbs(int(r[2])) for r in rows)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(r[0]) for r in rows], pa.int32()), pa.array([int(r[1]) for r in rows], pa.int32()),
             *(pa.array(p, pa.int64()) for p in parts)], names=["i", "j", *(f"c{k}" for k in range(LIMBS))])

    return run


# ---- the components -------------------------------------------------------

def _extended(numerators: np.ndarray, denominator: int) -> np.ndarray:
    """numerators / denominator in extended precision."""
    def near(x: int) -> np.longdouble:
        high = float(x)
        return np.longdouble(high) + np.longdouble(float(x - int(high)))

    down = near(denominator)
    return np.array([[near(int(x)) / down for x in row] for row in numerators], dtype=np.longdouble)


def eigenvectors(v: np.ndarray, k: int, sweeps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` (extended precision, symmetric) and their unit eigenvectors as rows.

    ``eigh`` finds a basis to the precision of a double, measured by the
    largest eigenvalue. Plane rotations in extended precision then take out what
    couples the first ``k`` with any other, so that small eigenvalues beside
    large ones are good too.
    """
    values, q = np.linalg.eigh(v.astype(np.float64))
    q = q[:, np.argsort(-values, kind="stable")].astype(np.longdouble)
    for _ in range(2):  # orthonormal to extended precision
        q = q @ (3 * np.eye(len(v), dtype=np.longdouble) - q.T @ q) / 2
    b = q.T @ v @ q
    eps = np.finfo(np.longdouble).eps
    for _ in range(sweeps):
        scale = np.sqrt(np.abs(np.diagonal(b)))
        loose = np.abs(np.triu(b, 1)) > 4 * eps * np.maximum(np.outer(scale, scale), eps * scale.max(initial=0) ** 2)
        loose[k:] = False
        if not loose.any():
            break
        for p, r in zip(*np.nonzero(loose)):
            if b[p, r] == 0:
                continue
            theta = (b[r, r] - b[p, p]) / (2 * b[p, r])
            t = (1 if theta >= 0 else -1) / (abs(theta) + np.sqrt(theta * theta + 1))
            c = 1 / np.sqrt(t * t + 1)
            s = t * c
            for m in (b, q):
                m[:, p], m[:, r] = c * m[:, p] - s * m[:, r], s * m[:, p] + c * m[:, r]
            b[p, :], b[r, :] = c * b[p, :] - s * b[r, :], s * b[p, :] + c * b[r, :]
    values = np.diagonal(b)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], q[:, order].T


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation; all but the dimensions is independent of the number of rows."""

    dims: int
    n: int
    sums: tuple[int, ...]  # of the x vectors
    components: np.ndarray  # unit eigenvectors as rows
    eigenvalues: np.ndarray
    explained: tuple[float, ...]
    identity_error: float | None

    def scaled(self) -> np.ndarray:
        """Components over the square roots of their eigenvalues; NaN where these are zero."""
        safe = np.where(self.eigenvalues > 0, self.eigenvalues, np.nan)
        return (self.components / np.sqrt(safe)[:, None]).astype(np.float64)


def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exact, for rows of y and their sums over n rows."""
    bound = n * max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0)))) + max(abs(s) for s in sums)
    kind = _type(bound)
    return y.astype(kind) * n - np.array(sums, dtype=kind)


def _empty(dims: int) -> Whitening:
    return Whitening(dims, 0, (), np.empty((0, dims)), np.empty(0), (), None)


def fit(df: DataFrame, k: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> Whitening:
    """Learn the whitening of the distinct integer vectors of ``df``; ``k`` components at most."""
    rows = usable(df, id_col, vec_col)
    commonest = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if commonest is None:
        return _empty(0)
    dims = commonest["d"]
    vectors = stored(rows.where(F.size("x") == dims).select("x").distinct(), "whitening-fit")
    limbs = [f"c{i}" for i in range(LIMBS)]
    found = vectors.mapInArrow(_scatter(dims), "i int, j int, " + ", ".join(f"{c} bigint" for c in limbs))
    n, sums, products = 0, [0] * dims, np.zeros((dims, dims), dtype=object)
    for r in found.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect():  # a row for each pair of dimensions
        number = sum(r[c] << LIMB * at for at, c in enumerate(limbs))
        if r["j"] < 0:
            n = number
        elif r["i"] < 0:
            sums[r["j"]] = number
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = number
    s = np.array(sums, dtype=object)
    numerators = n * products - np.outer(s, s)
    trace = _extended(np.array([[sum(numerators[d, d] for d in range(dims))]], dtype=object), n * n)[0, 0]
    values, components = eigenvectors(_extended(numerators, n * n), min(k, dims))
    values = np.where(values > trace * np.longdouble(1e-15), values, 0)
    whitening = Whitening(dims, n, tuple(x + OFFSET * n for x in sums), components, values,
                          tuple(float(e / trace) if trace else 0.0 for e in values), None)
    error = _identity_error(vectors, whitening)
    remove(vectors)
    return Whitening(dims, n, whitening.sums, components, values, whitening.explained, error)


def _projection(model: Whitening):
    """Function from integer rows (without ``OFFSET``) to (n * x - S, whitened values)."""
    n, scaled = model.n, model.scaled()
    sums = [s - OFFSET * n for s in model.sums]

    def run(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        moved = centred(y, n, sums)
        return moved, (moved / n).astype(np.float64) @ scaled.T

    return run


def _identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """How far the covariance of the whitened fit list is from the identity, measured on its rows."""
    project, dims, held = _projection(model), model.dims, np.flatnonzero(model.eigenvalues > 0)
    if not len(held):
        return None
    i, j = np.triu_indices(len(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(len(held)), np.zeros((len(held), len(held)))
        for batch in batches:
            white = project(_vectors(batch.column(0), dims))[1][:, held]
            sums, products = sums + white.sum(axis=0), products + white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((np.full(len(held), -1), i)), pa.int32()),
             pa.array(np.concatenate((np.arange(len(held)), j)), pa.int32()),
             pa.array(np.concatenate((sums, products[i, j])))], names=["i", "j", "v"])

    found = {(r["i"], r["j"]): r["v"] / model.n for r in vectors.mapInArrow(run, "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return max(abs(found[a, b] - found[-1, a] * found[-1, b] - (a == b)) for a, b in zip(i.tolist(), j.tolist()))


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened) of every usable row.

    ``deviation`` is the exact squared length of n * x - S, a decimal (null beyond 38 digits);
    ``whitened`` holds a value for each component, null without variance.
    """
    project, dims = _projection(model), model.dims

    @F.arrow_udf(returnType="deviation decimal(38, 0), whitened array<double>")
    def run(x: pa.Array) -> pa.Array:
        moved, white = project(_vectors(x, dims))
        most = max(abs(int(moved.min(initial=0))), abs(int(moved.max(initial=0))))
        kind = _type(dims * most * most)
        lengths = (moved.astype(kind) ** 2).sum(axis=1)
        lengths = pa.array(lengths) if kind is np.int64 else pa.array(
            [int(v) if v < 10 ** 38 else None for v in lengths], pa.decimal128(38, 0))
        values = pa.array(white.ravel(), mask=np.isnan(white.ravel()))
        ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
        return pa.StructArray.from_arrays(
            [lengths.cast(pa.decimal128(38, 0)), pa.ListArray.from_arrays(ends, values)], names=["deviation", "whitened"])

    rows = usable(df, id_col, vec_col).where(F.size("x") == dims)
    done = rows.withColumn("done", run(F.col("x")))
    return done.select(F.col("id").alias(id_col), "done.deviation", "done.whitened")
