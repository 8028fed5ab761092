"""Embeddings whitened by their principal components.

1. Entries become whole numbers; every different vector goes once to the fit table.
2. One pass gives the number of vectors, the sums, and the exact scatter about a whole number near the mean: products of centred
   entries are split into limbs small enough for exact matrix products in doubles, and come together as decimals. What goes to the
   driver is a row for each pair of dimensions, however many vectors there are.
3. There the covariance (exact up to one last rounding) is factored by Cholesky with pivots, and one-sided Jacobi rotations
   make the columns of the triangular factor orthogonal. Their squared norms are the eigenvalues, the columns over their norms
   the components. No product of the factor with itself is formed, so small eigenvalues keep their digits.
4. Every row is projected; the covariance of the projected fit table is one more aggregation.

Defined cases: a vector that is null or has a null or non-finite entry is left out. A shorter vector counts as if zeros followed.
Entries beyond the range of a long are taken as its ends. There are at most as many components as the covariance has rank, so
equal vectors only, or a single one, give no row; neither does an empty table. Components of equal eigenvalues are any orthogonal
ones; the largest entry of a component is positive. A deviation that a long cannot hold is null. A null identifier passes through,
repeated rows come out as often as they go in and count once in the fit. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallymart.llm.common import written
from tallymart.llm.vectors import as_doubles, entries, largest, longest

SCALE = 256
#: Bits of a limb, and rows of an exact product: 2 ** (21 + 21 + 11) is the last whole number up to which doubles have all.
LIMB, ROWS = 21, 2_048


def narrowed(x: np.ndarray) -> list[bytes]:
    """Each row's own shortest form: a byte for its width, then its entries. Equal rows have equal forms."""
    most = np.maximum(x.max(axis=1, initial=0), -1 - x.min(axis=1, initial=0))
    out: list[bytes] = [b""] * len(x)
    widths = np.select([most < 2**7, most < 2**15, most < 2**31], [1, 2, 4], 8)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        raw = x[at].astype(f"<i{w}").tobytes()
        step = int(w) * x.shape[1]
        for i, row in enumerate(at):
            out[row] = bytes([w]) + raw[i * step : (i + 1) * step]
    return out


def widened(forms: pa.Array, width: int) -> np.ndarray:
    """int64 rows of narrowed forms."""
    raw = forms.to_pylist()
    out = np.zeros((len(raw), width), np.int64)
    widths = np.array([r[0] for r in raw])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join(raw[i][1:] for i in at), f"<i{w}").reshape(len(at), width)
    return out


def fit_table(rows: DataFrame, width: int) -> DataFrame:
    """x: the narrowed form of every different vector, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(narrowed(entries(batch.column(0), SCALE, width)[1]), pa.binary())], names=["x"])

    return written(rows.select("vec").mapInArrow(run, "x binary").distinct(), "whitening-fit")


def added(fit: DataFrame, width: int, outputs) -> dict[tuple[int, int, int], int]:
    """Sums over the fit table by (power, i, j). outputs: gives the parts of a block of rows as (power, i, j, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            x = widened(batch.column(0), width)
            for at in range(0, len(x), ROWS):
                for power, square in outputs(x[at : at + ROWS]):
                    totals[power] = totals[power] + square.astype(object) if power in totals else square.astype(object)
        for power, square in totals.items():
            i, j = np.triu_indices(*square.shape[:1], m=square.shape[1]) if square.shape[0] == square.shape[1] else np.indices(square.shape).reshape(2, -1)
            values = pa.array(square[i, j].tolist(), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), power, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), values], names=["power", "i", "j", "v"])

    sums = fit.mapInArrow(run, "power int, i int, j int, v decimal(38,0)").groupBy("power", "i", "j").agg(F.sum("v").alias("v"))
    got = sums.toArrow()
    return {(p, i, j): int(v) for p, i, j, v in zip(*(got.column(c).to_pylist() for c in ("power", "i", "j", "v")), strict=True)}


def column_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(Number of vectors, exact sums of their entries)."""

    def parts(x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        # Halves of 32 bits, so that no sum of a block overflows.
        return [(0, np.array([[len(x)]])), (1, (x & 0xFFFFFFFF).sum(axis=0)[None]), (2, (x >> 32).sum(axis=0)[None])]

    got = added(fit, width, parts)
    return got.get((0, 0, 0), 0), [got.get((1, 0, i), 0) + (got.get((2, 0, i), 0) << 32) for i in range(width)]


def less(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre: as int64, or as Python integers where that is too small."""
    return x - centre.astype(np.int64) if largest(x) + largest(centre) < 2**62 else x.astype(object) - centre


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles that give y as a sum over 2 ** (21 * place), each of magnitude at most 2 ** 21."""
    out, sign = [], np.where(y < 0, -1, 1)
    rest = abs(y)
    while not out or (rest > 0).any():
        out.append((sign * (rest & (2**LIMB - 1))).astype(np.float64))
        rest = rest >> LIMB
    return out


def covariance(fit: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit table, divisor n, from exact sums of products of centred entries."""
    centre = np.array([s // n for s in sums], object)

    def parts(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        y = limbs(less(x, centre))
        for a in range(len(y)):
            for b in range(a, len(y)):
                square = y[a].T @ y[b]
                yield a + b, (square if a == b else square + square.T).astype(np.int64)

    got = added(fit, width, parts)
    scatter = np.zeros((width, width), object)
    for (power, i, j), v in got.items():
        scatter[i, j] += v << (LIMB * power)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre, strict=True)], object)
    v = ((n * scatter - np.outer(rest, rest)) / (n * n)).astype(np.float64)
    return np.triu(v) + np.triu(v, 1).T


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """A factor a (rows as in v, a column for each rank) with a @ a.T == v; triangular with its rows in the order of the pivots."""
    d, rest, free = len(v), v.diagonal().copy(), np.ones(len(v), bool)
    a = np.zeros((d, d))
    least = np.finfo(float).eps * d * rest.max(initial=0)
    for k in range(d):
        p = int(np.argmax(np.where(free, rest, -np.inf)))
        if rest[p] <= least:
            return a[:, :k]
        free[p] = False
        a[p, k] = np.sqrt(rest[p])
        a[free, k] = (v[free, p] - a[free, :k] @ a[p, :k]) / a[p, k]
        rest -= a[:, k] ** 2
    return a


def jacobi(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Squared norms, falling, and directions of the columns of a after rotations that make them orthogonal).

    Columns are rotated in disjoint pairs, all pairs once a sweep in the order of a round-robin tournament.
    """
    r = a.shape[1]
    a = np.pad(a, ((0, 0), (0, r % 2)))
    n = a.shape[1]
    for _ in range(60):
        ring, turned = np.arange(n), False
        for _ in range(n - 1):
            p, q = ring[: n // 2], ring[: n // 2 - 1 : -1]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            far = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if far.any():
                turned = True
                with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
                    tau = (yy - xx) / (2 * xy)
                    t = np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.sqrt(1 + tau * tau))
                t = np.where(far, t, 0.0)
                c = 1 / np.sqrt(1 + t * t)
                a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            ring[1:] = np.roll(ring[1:], 1)
        if not turned:
            break
    squared = (a * a).sum(axis=0)
    order = np.argsort(-squared, kind="stable")[:r]
    unit = a[:, order] / np.sqrt(squared[order])
    return squared[order], unit * np.sign(unit[np.abs(unit).argmax(axis=0), np.arange(r)])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums: as int64, or as Python integers where that is too small."""
    if n * largest(x) + max(map(abs, sums), default=0) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(y: np.ndarray) -> pa.Array:
    """Sums of the squares of a row of y, null beyond the range of a long."""
    if not y.size or (y.dtype == np.int64 and largest(y) ** 2 * y.shape[1] < 2**63):
        return pa.array((y * y).sum(axis=1).astype(np.int64))
    return pa.array([s if s < 2**63 else None for s in (y.astype(object) ** 2).sum(axis=1).tolist()], pa.int64())


def whitened(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining row and component."""
    rows = as_doubles(vectors, id_col, vec_col)
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = rows.agg(longest(F.col("vec"))).first()[0]
    if not width:
        return rows.sparkSession.createDataFrame([], shape)
    fit = fit_table(rows, width)
    n, sums = column_sums(fit, width)
    if not n:
        return rows.sparkSession.createDataFrame([], shape)
    v = covariance(fit, width, n, sums)
    squared, unit = jacobi(pivoted_cholesky(v))
    k = min(components, len(squared))
    if not k:
        return rows.sparkSession.createDataFrame([], shape)
    onto, explained = unit[:, :k] / np.sqrt(squared[:k]), squared[:k] / np.trace(v)

    def white(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centred(x, n, sums)
        return y, (y / n).astype(np.float64) @ onto

    def of_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = white(widened(batch.column(0), width))[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, i])) for i in range(k)], names=names)

    names = [f"w{i}" for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    projected = fit.mapInArrow(of_fit, ", ".join(f"{c} double" for c in names))
    found = projected.agg(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    error = max(abs(got - (i == j)) for got, (i, j) in zip(found, pairs, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, x = entries(batch.column(1), SCALE, width)
            ids = batch.column(0).filter(pa.array(fine))
            y, w = white(x)
            each = np.repeat(np.arange(len(x)), k)
            columns = [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)), deviations(y).take(pa.array(each)), pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays([pc.cast(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()), strict=True)], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, shape)
