"""Embedding whitening by spectrum slicing.

Vectors become whole numbers, so that sums and products are exact in any order: the covariance doesn't depend on how the
rows are dealt to tasks. Spark makes the sums and the products per task and adds them up by dimension; what reaches the
driver is one d x d matrix, whatever the number of rows. There the inertia of shifted copies (pivots of an LDL' factorisation) counts
the eigenvalues above a shift; intervals are cut until each holds one, Rayleigh quotient iteration finds it, and two more
counts certify its number. Rows are whitened in the tasks again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries whose scaled value is beyond this are taken as this, so that they are long integers.
MOST = float(2**62)
EPS = np.finfo(np.float64).eps
#: Products are carried as three limbs of so many bits; sums of a million limbs still are long integers.
LIMB = 40


@dataclass(frozen=True)
class Whitening:
    """Centre (whole part and the rest), unit eigenvectors (columns) and eigenvalues, falling, of n vectors of one size."""

    n: int
    total: tuple[int, ...]
    centre: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.centre)


def whole_numbers(column: pa.ListArray, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of long integers) for each size of vectors, or for `size` only.

    Rows with a null vector, no entries, or a null, NaN or infinite entry are left out.
    """
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64), nan=0).astype(np.int64)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    begin = np.cumsum(lengths) - lengths
    for d in [size] if size is not None else np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        if not d or not len(rows):
            continue
        matrix = values[begin[rows, None] + np.arange(d)]
        fine = np.isfinite(matrix).all(axis=1)
        scaled = np.clip(np.floor(matrix[fine] * SCALE), -MOST, MOST)
        yield rows[fine], scaled.astype(np.int64) + SHIFT


def sums(vectors: DataFrame) -> tuple[int, int, tuple[int, ...]]:
    """(size, number of vectors, exact sum per dimension) of the commonest size; of equally common ones the greatest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for rows, x in whole_numbers(batch.column("embedding")):
                n, total = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = [n + len(rows), total + x.astype(object).sum(axis=0) if len(x) and np.abs(x).max() > 2**40 else total + x.sum(axis=0).astype(object)]
        for d, (n, total) in held.items():
            if n:
                columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))]
                yield pa.record_batch(columns, names=["size", "at", "n", "total"])

    parts = vectors.select("embedding").mapInArrow(lean(read), "size int, at int, n long, total decimal(38,0)")
    added = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    best = added.filter("at = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if best is None:
        return 0, 0, ()
    rows = added.filter(F.col("size") == best["size"]).orderBy("at").collect()
    return best["size"], best["n"], tuple(int(r["total"]) for r in rows)


def limbs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = values & ((1 << LIMB) - 1)
    middle = values >> LIMB
    if values.dtype != object:
        return low, middle, np.zeros_like(low)
    return tuple(x.astype(np.int64) for x in (low, middle & ((1 << LIMB) - 1), middle >> LIMB))


def products(vectors: DataFrame, size: int, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of the centred vectors, per pair of dimensions, as whole numbers of any length."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bound = np.zeros((size, size), dtype=np.int64), 0

        def out(part: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(range(size), pa.int32())]
            columns += [pa.array(list(x), pa.list_(pa.int64())) for x in limbs(part)]
            return pa.record_batch(columns, names=["at", "low", "middle", "high"])

        for batch in batches:
            for _, x in whole_numbers(batch.column("embedding"), size):
                z = x - centre
                most = int(np.abs(z).max(initial=0)) ** 2 * len(z)
                if most >= 2**53:  # not exact in floating point
                    wide = z.astype(object)
                    yield out(wide.T @ wide)
                    continue
                if bound + most >= 2**62:
                    yield out(held)
                    held, bound = np.zeros_like(held), 0
                exact = z.astype(np.float64)
                held += (exact.T @ exact).astype(np.int64)
                bound += most
        if bound:
            yield out(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            parts = np.stack([batch.column(n).flatten().to_numpy().reshape(len(at), size) for n in ("low", "middle", "high")], axis=1)
            for i, part in zip(at.tolist(), parts, strict=True):
                held[i] = held[i] + part if i in held else part
        for i, part in held.items():
            yield pa.record_batch([pa.array([i], pa.int32()), *[pa.array([p], pa.list_(pa.int64())) for p in part]], names=["at", "low", "middle", "high"])

    layout = "at int, low array<long>, middle array<long>, high array<long>"
    parts = vectors.select("embedding").mapInArrow(lean(read), layout)
    matrix = np.zeros((size, size), dtype=object)
    for at, low, middle, high in parts.repartition(min(size, 64), "at").mapInArrow(lean(add), layout).collect():
        matrix[at] = [a + (b << LIMB) + (c << 2 * LIMB) for a, b, c in zip(low, middle, high, strict=True)]
    return matrix


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix above `shift`: positive pivots of an LDL' factorisation of the shifted
    matrix. Pivots are single entries or 2 x 2 blocks, chosen so that entries don't grow."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    limit = (1 + np.sqrt(17)) / 8
    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        lam, own = float(column.max(initial=0)), abs(a[k, k])
        single, swap = True, k
        if own < limit * lam:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            sigma = float(row.max())
            if own * sigma < limit * lam * lam:
                swap = r
                single = abs(a[r, r]) >= limit * sigma
        to = k if single else k + 1
        if swap not in (k, to) or (single and swap != k):
            a[[to, swap]] = a[[swap, to]]
            a[:, [to, swap]] = a[:, [swap, to]]
        if single:
            pivot = a[k, k]
            positive += int(pivot > 0)
            if pivot:
                v = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(v, v / pivot)
            k += 1
        else:  # such a block always has one eigenvalue of either sign
            block, v = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= v @ np.linalg.solve(block, v.T)
            positive += 1
            k += 2
    return positive


def _slices(matrix: np.ndarray, wanted: int, width: float) -> list[tuple[float, float, int, int]]:
    """Disjoint intervals (low, high, number of eigenvalues above high, above low) that hold the `wanted` greatest: one in
    each, or several in one no wider than `width`."""
    radius = np.abs(matrix).sum(axis=1).max()
    todo = [(-radius * EPS * len(matrix) - width, radius + width, 0, len(matrix))]
    done = []
    while todo:
        low, high, fewer, more = todo.pop()
        if fewer >= wanted or more == fewer:
            continue
        if more - fewer == 1 or high - low <= width:
            done.append((low, high, fewer, more))
            continue
        middle = (low + high) / 2
        here = min(max(above(matrix, middle), fewer), more)
        todo += [(low, middle, here, more), (middle, high, fewer, here)]
    return sorted(done, key=lambda s: s[2])


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            out = np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
        shift += EPS * scale  # the shift is an eigenvalue to the last bit


def _single(matrix: np.ndarray, low: float, high: float, fewer: int, scale: float) -> tuple[float, np.ndarray]:
    """The eigenvalue in an interval that holds one, and its vector: Rayleigh quotient iteration, halving the interval by
    another count whenever an iterate leaves it."""
    rng = np.random.default_rng(0)
    while True:
        shift = (low + high) / 2
        v = rng.standard_normal(len(matrix))
        for _ in range(3):
            v = _solve(matrix, shift, v, scale)
            v /= np.linalg.norm(v)
        best, last = None, np.inf
        for _ in range(20):
            value = float(v @ matrix @ v)
            left = float(np.linalg.norm(matrix @ v - value * v))
            if not low <= value <= high or left >= last:
                break
            best, last = (value, v), left
            if left == 0:
                break
            v = _solve(matrix, value, v, scale)
            v /= np.linalg.norm(v)
        if best is not None and last <= 8 * EPS * scale * len(matrix):
            return best
        if high - low <= 4 * EPS * scale:
            return shift, v
        if above(matrix, shift) > fewer:
            low = shift
        else:
            high = shift


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of the `wanted` greatest eigenvalues of a covariance, without
    those that are zero to rounding. Their numbering is certified by inertia counts on both sides.

    Eigenvalues that agree to rounding have no vectors of their own; some basis of their space is given. The greatest
    entry of each vector is positive.
    """
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((len(matrix), 0))
    width = 64 * EPS * scale * len(matrix)
    values, vectors = [], []
    for low, high, fewer, more in _slices(matrix, wanted, width):
        if more - fewer == 1:
            value, v = _single(matrix, low, high, fewer, scale)
            found = [(value, v)]
        else:
            block = np.random.default_rng(more).standard_normal((len(matrix), more - fewer))
            for _ in range(4):
                block = np.linalg.qr(_solve(matrix, (low + high) / 2, block, scale))[0]
            inner, turn = np.linalg.eigh(block.T @ matrix @ block)
            found = [(float(inner[i]), block @ turn[:, i]) for i in range(len(inner))[::-1]]
        least, most = min(v for v, _ in found), max(v for v, _ in found)
        if above(matrix, most + width) > fewer or above(matrix, least - width) < more:
            raise ArithmeticError("eigenvalues were found in the wrong order")
        values += [v for v, _ in found]
        vectors += [v for _, v in found]
    kept = [i for i in range(min(wanted, len(values))) if values[i] > width]
    columns = [vectors[i] * np.sign(vectors[i][np.abs(vectors[i]).argmax()]) for i in kept]
    return np.array([values[i] for i in kept]), np.stack(columns, axis=1) if columns else np.zeros((len(matrix), 0))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of all vectors of the commonest size (column `embedding`); None if there are none."""
    size, n, total = sums(vectors)
    if not n:
        return None
    centre = np.array([round(t / n) if abs(t) < 2**53 else (2 * t + n) // (2 * n) for t in total], dtype=np.int64)
    rest = np.array([t - n * int(c) for t, c in zip(total, centre, strict=True)], dtype=object)
    exact = n * products(vectors, size, centre) - np.outer(rest, rest)
    covariance = np.array([[v / (n * n) for v in row] for row in exact.tolist()], dtype=np.float64)
    values, axes = leading(covariance, components)
    return Whitening(n, total, centre, np.array([r / n for r in rest]), axes, values, float(np.trace(covariance)))


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return ((x - model.centre).astype(np.float64) - model.rest) @ (model.vectors / np.sqrt(model.values))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Greatest absolute entry of the whitened vectors' covariance minus the identity, over all vectors fitted on."""
    size, k = model.size, len(model.values)

    def moments(mean: np.ndarray | None):
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(k if mean is None else k * k)
            for batch in batches:
                for _, x in whole_numbers(batch.column("embedding"), size):
                    w = _whitened(x, model)
                    held += w.sum(axis=0) if mean is None else ((w - mean).T @ (w - mean)).ravel()
            yield pa.record_batch([pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)], names=["at", "part"])

        parts = vectors.select("embedding").mapInArrow(lean(read), "at int, part double")
        rows = parts.groupBy("at").agg(F.sum("part").alias("total")).orderBy("at").collect()
        return np.array([r["total"] for r in rows]) / model.n

    if not k:
        return 0.0
    return float(np.abs(moments(moments(None)).reshape(k, k) - np.eye(k)).max())


LAYOUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    `vectors` has vec_id and embedding; other columns play no part. Vectors that are null, empty or hold a null or
    non-finite entry take no part, nor do vectors of another size than the commonest (of all rows; ties: the greatest).
    Ids may be null or repeated: each row has its own result. Components with an eigenvalue of zero to rounding can't be whitened and are
    left out, so a single vector, or only equal ones, give no rows, like an empty table.
    """
    spark = vectors.sparkSession
    model = fit(vectors, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], LAYOUT)
    error = identity_error(vectors, model)
    n, k, size = model.n, len(model.values), model.size
    rest = [t - n * int(c) for t, c in zip(model.total, model.centre, strict=True)]
    squares = sum(r * r for r in rest)
    explained = model.values / model.trace
    wide_rest = np.array(rest, dtype=object)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in whole_numbers(batch.column("embedding"), size):
                z = x - model.centre
                small = max(int(np.abs(z).max(initial=0)), max(map(abs, rest))) ** 2 * size < 2**62
                z = z if small else z.astype(object)
                own, with_rest = (z * z).sum(axis=1), z @ (wide_rest.astype(np.int64) if small else wide_rest)
                deviation = [Decimal(n * n * int(a) - 2 * n * int(b) + squares) for a, b in zip(own, with_rest, strict=True)]
                m = len(rows)
                columns = [
                    batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, dtype=np.int64)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(_whitened(x, model).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.record_batch(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(lean(read), LAYOUT)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation is null only where it exceeds a long integer."""
    rows = whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))
