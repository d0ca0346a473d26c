"""Whitening of vectors: float32 eigenvectors of the exact covariance, refined by matrix products in wider floats."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainstay.scratch import written

# Production values.
SCALE = 256
COMPONENTS = 4
# Columns of the product matrix in one row of a task's result.
BLOCK = 64
# Integers up to this are exact in a double; products are taken in blocks that stay below it.
EXACT = 2**53
# Sums travel as three 64-bit parts in base 2^32, so they add up exactly in any order.
BASE = 32
MASK = (1 << BASE) - 1
WIDE = np.longdouble
ROUNDS = 12


@dataclass(frozen=True)
class Whitening:
    """What all rows share: the fit list's size and sums, unit components with their variances, and the total variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The integers next to the means."""
        return nearest(self.n, self.sums)

    @property
    def rest(self) -> np.ndarray:
        """The sums of what vectors have beyond the centre."""
        return np.array(self.sums, object) - self.n * self.centre

    @property
    def shift(self) -> np.ndarray:
        """The means beyond the centre, at most a half each, so that they keep all digits of a double."""
        return np.array([float(r) / self.n for r in self.rest])

    @property
    def scales(self) -> np.ndarray:
        """Square roots of the variances; NaN for a component without variance."""
        limit = len(self.sums) * np.finfo(float).eps * max(self.variances.max(initial=0.0), 0.0)
        return np.sqrt(np.where(self.variances > limit, self.variances, np.nan))


def nearest(n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The integer next to each mean."""
    return np.array([(2 * s + n) // (2 * n) for s in sums], object)


def grid_vectors(vectors: DataFrame, key: str = "vec_id", value: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(key, x): floor(scale * component) of every vector that is present, finite and within 64 bits."""
    limit = float(2**63) / scale
    fits = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < limit))
    x = F.transform(value, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.where(F.col(value).isNotNull() & (F.size(value) > 0)).where(fits).select(F.col(key).alias("_key"), x.alias("x"))


def _usual_length(fit: DataFrame) -> int:
    """The length that most vectors have, the longer one of equals; 0 without vectors."""
    counts = fit.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.max(F.struct("rows", "length"))["length"]).first()[0] or 0


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1)


def _centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre, as 64-bit integers where they hold it, else as Python's."""
    if max(int(np.abs(centre).max()), abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 2**61:
        return x - centre.astype(np.int64)
    return x.astype(object) - centre


def _limbs(values: np.ndarray) -> np.ndarray:
    """Integers of any size as three 64-bit parts, the last one signed."""
    parts = [values & MASK, (values >> BASE) & MASK, values >> (2 * BASE)]
    return np.stack([p.astype(np.int64) for p in parts], axis=-1)


def _whole(limbs: np.ndarray) -> np.ndarray:
    """The integers of three parts."""
    parts = limbs.astype(object)
    return parts[..., 0] + (parts[..., 1] << BASE) + (parts[..., 2] << (2 * BASE))


def column_sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """How many vectors there are, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            n += len(x)
            # Halves of 32 bits: neither can overflow in a batch.
            part = (x & MASK).sum(axis=0).astype(object) + ((x >> BASE).sum(axis=0).astype(object) << BASE)
            total = part if total is None else total + part
        if total is not None:
            limbs = _limbs(total)
            columns = [np.arange(len(total), dtype=np.int32), np.full(len(total), n, np.int64), *limbs.T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "n", "a", "b", "c"])

    rows = (
        fit.select("x").mapInArrow(add, "dim int, n long, a long, b long, c long")
        .groupBy("dim").agg(*[F.sum(name).alias(name) for name in ("n", "a", "b", "c")]).orderBy("dim").collect()
    )
    if not rows:
        return 0, ()
    sums = _whole(np.array([[r.a, r.b, r.c] for r in rows], np.int64))
    return rows[0].n, tuple(int(s) for s in sums)


def _products(y: np.ndarray) -> np.ndarray:
    """Y'Y in exact integers."""
    largest = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if largest >= 2**26:
        wide = y.astype(object)
        return wide.T @ wide
    rows = max(1, (EXACT - 1) // max(largest * largest, 1))
    total = np.zeros((y.shape[1], y.shape[1]), object)
    floats = y.astype(np.float64)
    for at in range(0, len(y), rows):
        part = floats[at:at + rows]
        total = total + (part.T @ part).astype(np.int64)
    return total


def centred_products(fit: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Sum over all vectors of (x - centre)(x - centre)', exact.

    Each task hands on one matrix, in pieces of a row and BLOCK columns; the pieces of one place meet in one task,
    which adds them as they come.
    """
    size = len(centre)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = _products(_centred(_matrix(batch.column(0)), centre))
                total = part if total is None else total + part
        if total is not None:
            limbs = _limbs(total)
            places = [(i, j) for i in range(size) for j in range(0, size, BLOCK)]
            parts = [limbs[i, j:j + BLOCK].tobytes() for i, j in places]
            yield _pieces(places, parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                limbs = np.frombuffer(part, np.int64)
                held[i, j] = held[i, j] + limbs if (i, j) in held else limbs
        yield _pieces(list(held), [limbs.tobytes() for limbs in held.values()])

    kinds = "i int, j int, part binary"
    pieces = fit.select("x").mapInArrow(multiply, kinds).repartition("i", "j").mapInArrow(add, kinds).collect()
    result = np.zeros((size, size), object)
    for piece in pieces:
        limbs = np.frombuffer(bytes(piece.part), np.int64).reshape(-1, 3)
        result[piece.i, piece.j:piece.j + len(limbs)] = _whole(limbs)
    return result


def _pieces(places: list[tuple[int, int]], parts: list[bytes]) -> pa.RecordBatch:
    rows, columns = [i for i, _ in places], [j for _, j in places]
    kinds = [pa.array(rows, pa.int32()), pa.array(columns, pa.int32()), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(kinds, names=["i", "j", "part"])


def _refine_once(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """One step by matrix products: better vectors, their values, the gap below which values can't be told apart, and the change."""
    r = np.eye(len(a), dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    gap = 2 * (np.linalg.norm((s - np.diag(values)).astype(float)) + np.abs(values).max() * np.linalg.norm(r.astype(float)))
    apart = values[None, :] - values[:, None]
    near = np.abs(apart) <= gap
    change = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, apart))
    return x + x @ change, values, float(gap), change


def _split_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, gap: float) -> np.ndarray:
    """Vectors whose values lie together are turned inside the space they span.

    The space is right already; the small matrix in it is taken after the common value is subtracted, so that the
    differences of the values are no longer lost beside the values themselves.
    """
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], values[:-1] - values[1:] > gap]))
    for first, end in zip(starts, [*starts[1:], len(values)], strict=True):
        if end - first < 2:
            continue
        basis = x[:, first:end]
        middle = values[first:end].mean()
        inner = basis.T @ (a @ basis) - middle * (basis.T @ basis)
        size = np.abs(inner).max()
        if size > 0:
            _, turn = np.linalg.eigh(((inner + inner.T) / (2 * size)).astype(float))
            x[:, first:end] = basis @ turn[:, ::-1].astype(WIDE)
    return x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, right to double precision.

    Starts from float32 eigenvectors. Each round multiplies matrices in the widest float, which doubles the correct
    digits of vectors with separate values, and solves clusters of close values by themselves.
    """
    a = a.astype(WIDE)
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start.astype(WIDE)
    least = np.inf
    for _ in range(ROUNDS):
        x, values, gap, change = _refine_once(a, x)
        moved = float(np.abs(change).max())
        if moved <= np.finfo(WIDE).eps * len(a) or (moved >= least and moved < 1e-12):
            break
        least = min(least, moved)
        x = _split_clusters(a, x, values, gap)
    x = x + x @ (np.eye(len(a), dtype=WIDE) - x.T @ x) / 2
    _, values, _, _ = _refine_once(a, x)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(float), x[:, order].astype(float)


def covariance(n: int, rest: np.ndarray, products: np.ndarray) -> np.ndarray:
    """The covariance, divisor n, from centred sums and products: exact integers until the one division."""
    numerators = n * products - np.outer(rest, rest)
    return np.array([[WIDE(int(v)) for v in row] for row in numerators], WIDE) / WIDE(n * n)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a list of integer vectors ``x`` of one length; None for an empty list.

    The driver holds sums and products of dimensions alone; their number doesn't grow with the vectors.
    """
    n, sums = column_sums(fit)
    if not n:
        return None
    centre = nearest(n, sums)
    v = covariance(n, np.array(sums, object) - n * centre, centred_products(fit, centre))
    values, vectors = eigen(v)
    top = vectors[:, :components]
    signs = np.sign(top[np.abs(top).argmax(axis=0), np.arange(top.shape[1])])
    return Whitening(n, sums, top * signs, np.maximum(values[:components], 0.0), float(np.trace(v)))


def _distances(y: np.ndarray, n: int, rest: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * y - rest)^2 of each vector, exact."""
    largest, furthest = max(abs(int(y.max())), abs(int(y.min()))), int(np.abs(rest).max())
    if max(largest, furthest) * largest * len(rest) >= 2**62:
        apart = y.astype(object) * n - rest
        return list((apart * apart).sum(axis=1))
    squares, products = (y * y).sum(axis=1).tolist(), (y @ rest.astype(np.int64)).tolist()
    both = int((rest * rest).sum())
    return [n * (n * s - 2 * p) + both for s, p in zip(squares, products, strict=True)]


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(_key, component, deviation, whitened) of every vector: the centred vector on each component, over its deviation."""
    n, scales, axes, centre, rest, shift = model.n, model.scales, model.components, model.centre, model.rest, model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _centred(_matrix(batch.column(1)), centre)
            exact = pa.array([s if s < 2**63 else None for s in _distances(y, n, rest)], pa.int64())
            whitened = (y - shift).astype(float) @ axes / scales
            for k in range(axes.shape[1]):
                column = pa.array(whitened[:, k], pa.float64(), mask=np.isnan(whitened[:, k]))
                number = pa.array(np.full(len(y), k + 1, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), number, exact, column], names=["_key", "component", "deviation", "whitened"]
                )

    key = vectors.schema["_key"].dataType.simpleString()
    return vectors.select("_key", "x").mapInArrow(run, f"_key {key}, component int, deviation long, whitened double")


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; None without variance."""
    n, axes, scales, centre, shift = model.n, model.components, model.scales, model.centre, model.shift
    live = np.flatnonzero(~np.isnan(scales))
    if not len(live):
        return None
    size = len(live)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                y = _centred(_matrix(batch.column(0)), centre)
                w = (y - shift).astype(float) @ axes[:, live] / scales[live]
                total += w.T @ np.column_stack([w, np.ones(len(w))])
        i, j = np.divmod(np.arange(total.size, dtype=np.int32), size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = fit.select("x").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((size, size + 1))
    for row in rows:
        total[row.i, row.j] = row.v
    means = total[:, size] / n
    return float(np.abs(total[:, :size] / n - np.outer(means, means) - np.eye(size)).max())


def whitened_vectors(
    vectors: DataFrame, key: str = "vec_id", value: str = "embedding", scale: int = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and leading component: key, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, or hold null or non-finite entries take no part, nor do entries whose ``scale``-fold
    has no 64-bit integer. The dimension is the length that most different vectors have, the longer one of equals;
    vectors of another length take no part. The fit list holds each different vector once; rows that repeat, in
    number or vector, each get their own result, a null number too. A component without variance has whitened null
    (there are fewer than ``components`` where the dimension is smaller); without any variance explained is 0 and
    identity_error null. deviation is null where it passes 64 bits. An empty table gives no rows; other columns
    aren't read.
    """
    rows = grid_vectors(vectors, key, value, scale)
    distinct = written(rows.select("x").distinct(), "whitening")
    fit = distinct.where(F.size("x") == _usual_length(distinct))
    model = fit_whitening(fit, components)
    kind = rows.schema["_key"].dataType.simpleString()
    if model is None:
        empty = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    share = model.variances / model.trace if model.trace > 0 else np.zeros_like(model.variances)
    shares = F.array(*[F.lit(float(s)) for s in share])
    return whiten(rows.where(F.size("x") == len(model.sums)), model).select(
        F.col("_key").alias(key), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(identity_error(fit, model)).cast("double").alias("identity_error"),
    )
