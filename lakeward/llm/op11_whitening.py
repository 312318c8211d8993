"""Embedding whitening with components found by contour integration (FEAST).

Vectors are put on a grid, ``x = floor(scale * c) + shift``, so sums and second moments are whole
numbers and come out the same in any order: tasks add them up exactly and send one row per
dimension, or pair of dimensions, which Spark sums. The second moments are taken about the whole
number next to each mean; what the mean differs from it is taken off exactly.

The leading eigenpairs of the covariance are found interval by interval. Inertia counts (the signs
of an LDL^T factorisation) say how many eigenvalues lie above a point; they place the borders so
that an interval holds few. In an interval, a quadrature over a circle of solves with the complex
shifted covariance projects a block of vectors onto the interval's eigenvectors, Rayleigh-Ritz takes
them out, and the step is repeated until the residuals vanish. An interval is done when it has as
many eigenpairs as its inertia counts say. Intervals are solved by separate Spark tasks.

The driver holds matrices of d x d numbers (d: the vectors' length), never a vector of the table.
The table is read four times (sums, moments, check, result), each time two columns only.

Defined edge cases: vectors that are null, or hold a null or non-finite entry, or one whose grid
value is no long (2**55 or more for scale 64), are left out; vectors of different lengths are fitted
each length by itself; an empty vector has no component and gives no row; null ids and repeated rows
stay; components without variance (fewer rows than dimensions, constant entries) have explained 0
and whitened null; with no variance at all explained and identity_error are null; a deviation that
is no long is null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

COMPONENTS = 32
#: Largest grid value that takes part: differences of two still fit a long.
LARGEST = float(1 << 61)
#: Whole numbers are sent between tasks as this many parts of 40 bits.
PARTS, PART_BITS = 4, 40
#: Products of pieces of 20 bits, over so many rows, are exact in double precision.
PIECE_BITS, EXACT_ROWS = 20, 4096
#: Eigenvalues wanted in an interval, points of the quadrature, rounds before the block is enlarged.
IN_INTERVAL, POINTS, ROUNDS = 8, 8, 12


@dataclass(frozen=True)
class Grid:
    """``x = floor(scale * c) + shift``."""

    scale: float = 64.0
    shift: int = 1_000_000


@dataclass
class Fit:
    """Mean, components and scales for vectors of one length."""

    n: int
    centre: np.ndarray  # whole number next to the mean, per dimension
    rest: list[int]  # sums less n times the centre
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2, exactly; None where it is no long."""
        y = x - self.centre
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest))
        if most * most * len(self.rest) < 1 << 63:
            t = y * self.n - np.array(self.rest, "int64")
            return (t * t).sum(axis=1).tolist()
        t = y.astype(object) * self.n - np.array(self.rest, object)
        return [v if v < 1 << 63 else None for v in (t * t).sum(axis=1).tolist()]


# --- vectors of a batch -------------------------------------------------------------------------


def _matrices(column: pa.ListArray, grid: Grid) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, grid values) of the vectors that take part, by length."""
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(column).drop_null().to_numpy(zero_copy_only=False)
    flat = column.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(grid.scale * flat)
        good = np.abs(scaled) < LARGEST
    of = np.repeat(np.arange(len(rows)), lengths)
    keep = np.ones(len(rows), bool)
    keep[of[~good]] = False
    for d in np.unique(lengths[keep]):
        if d:
            own = keep & (lengths == d)
            yield int(d), rows[own], scaled[own[of]].astype("int64").reshape(-1, d) + grid.shift


def _parts(value: int) -> list[int]:
    """A whole number as PARTS whole numbers whose sums over many tasks stay longs."""
    low = [(value >> PART_BITS * k) & ((1 << PART_BITS) - 1) for k in range(PARTS - 1)]
    return [*low, value >> PART_BITS * (PARTS - 1)]


_PART_NAMES = [f"p{k}" for k in range(PARTS)]
_PART_SCHEMA = ", ".join(f"{c} bigint" for c in _PART_NAMES)


def _whole(row) -> int:
    return sum(row[c] << PART_BITS * k for k, c in enumerate(_PART_NAMES))


def _sums_of(rows: DataFrame, *keys: str) -> list:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys]).collect()


def _rows(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"d": pa.int32(), "i": pa.int32(), "j": pa.int32(), "v": pa.float64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(name, pa.int64()))
                                       for name, c in zip(names, zip(*found, strict=True), strict=True)], names)


def _vectors(vectors: DataFrame, column: str, *others) -> DataFrame:
    return vectors.select(*others, F.col(column).cast("array<double>").alias("vec"))


def _totals(vectors: DataFrame, column: str, grid: Grid) -> dict[int, tuple[int, list[int]]]:
    """Per length: number of vectors and their sums per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for b in slices(batches, "vec"):
            for d, _, x in _matrices(b.column("vec"), grid):
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                n[d] = n.get(d, 0) + len(x)
                sums[d] = sums.get(d, 0) + high.astype(object) * (1 << 32) + low.astype(object)
        for d in n:
            yield _rows([(d, i, n[d], *_parts(s)) for i, s in enumerate(sums[d])], ["d", "i", "n", *_PART_NAMES])

    got = _sums_of(_vectors(vectors, column).mapInArrow(run, f"d int, i int, n bigint, {_PART_SCHEMA}"), "d", "i")
    out: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(got, key=lambda r: (r["d"], r["i"])):
        out.setdefault(row["d"], (row["n"], []))[1].append(_whole(row))
    return out


def _pieces(y: np.ndarray) -> list[np.ndarray]:
    """``y`` as pieces of 20 bits: y = sum of piece[k] * 2 ** (20 k)."""
    top = max(0, (int(np.abs(y).max(initial=0)).bit_length() - 1) // PIECE_BITS)
    low = [(y >> PIECE_BITS * k) & ((1 << PIECE_BITS) - 1) for k in range(top)]
    return [p.astype("float64") for p in [*low, y >> PIECE_BITS * top]]


def _second_moments(vectors: DataFrame, column: str, grid: Grid, centres: dict[int, np.ndarray]) -> dict[int, list]:
    """Per length: the exact sums of products of entries less their centre, [i][j]."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)  # one number a dimension and length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments: dict[int, np.ndarray] = {}
        for b in slices(batches, "vec"):
            for d, _, x in _matrices(b.column("vec"), grid):
                for at in range(0, len(x), EXACT_ROWS):
                    pieces = _pieces(x[at:at + EXACT_ROWS] - shared.value[d])
                    for k, p in enumerate(pieces):
                        for l, q in enumerate(pieces):
                            product = (p.T @ q).astype("int64").astype(object)
                            moments[d] = moments.get(d, 0) + product * (1 << PIECE_BITS * (k + l))
        for d, m in moments.items():
            for i in range(d):
                yield _rows([(d, i, j, *_parts(m[i, j])) for j in range(i, d)], ["d", "i", "j", *_PART_NAMES])

    got = _sums_of(_vectors(vectors, column).mapInArrow(run, f"d int, i int, j int, {_PART_SCHEMA}"), "d", "i", "j")
    out = {d: [[0] * d for _ in range(d)] for d in centres}
    for row in got:
        out[row["d"]][row["i"]][row["j"]] = out[row["d"]][row["j"]][row["i"]] = _whole(row)
    return out


# --- eigenpairs by contour integration ------------------------------------------------------------


def above(a: np.ndarray, point: float) -> int:
    """How many eigenvalues of the symmetric ``a`` lie above ``point``: positive pivots of LDL^T
    (Bunch-Kaufman pivoting)."""
    s = a - point * np.eye(len(a))
    n, k, count, alpha = len(s), 0, 0, (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            s[[i, j]] = s[[j, i]]
            s[:, [i, j]] = s[:, [j, i]]

    while k < n:
        off = np.abs(s[k + 1:, k])
        most = off.max(initial=0)
        single = abs(s[k, k]) >= alpha * most
        if not single:
            r = k + 1 + int(off.argmax())
            others = max(np.abs(s[k:r, r]).max(initial=0), np.abs(s[r + 1:, r]).max(initial=0))
            if abs(s[k, k]) * others >= alpha * most * most:
                single = True
            elif abs(s[r, r]) >= alpha * others:
                swap(k, r)
                single = True
            else:
                swap(k + 1, r)
        if single:
            if s[k, k]:
                count += int(s[k, k] > 0)
                s[k + 1:, k + 1:] -= np.outer(s[k + 1:, k] / s[k, k], s[k + 1:, k])
            k += 1
        else:  # such a pivot of two rows has one positive and one negative eigenvalue
            count += 1
            w = s[k + 2:, k:k + 2]
            s[k + 2:, k + 2:] -= w @ np.linalg.solve(s[k:k + 2, k:k + 2], w.T)
            k += 2
    return count


def _clear(a: np.ndarray, point: float) -> tuple[float, int]:
    """A point at or a little below ``point`` with no eigenvalue close by, and the count above it."""
    for _ in range(40):
        counts = {above(a, point * f) for f in (1 - 1e-8, 1 + 1e-8)}
        if len(counts) == 1:
            return point, counts.pop()
        point *= 1 - 5e-8
    return point, above(a, point)


def intervals(a: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues in it) that hold at least the ``wanted`` largest eigenvalues
    of ``a``, positive semidefinite with trace 1; fewer if ``a`` has fewer above rounding."""
    least = 8 * len(a) * np.finfo(float).eps
    low, n_low = _clear(a, least)
    wanted = min(wanted, n_low)
    if not wanted:
        return []
    high = 1.001
    while n_low > wanted and high / low > 1 + 1e-6:
        mid, n = _clear(a, (low * high) ** 0.5)
        if n >= wanted:
            low, n_low = mid, n
        else:
            high = mid
    out, open_ = [], [(low, 1.001, n_low, 0)]
    while open_:
        lo, hi, n_lo, n_hi = open_.pop()
        mid = (lo * hi) ** 0.5
        if n_lo == n_hi:
            continue
        # a circle much wider than its eigenvalues are apart would not tell them from those beside it
        if (n_lo - n_hi <= IN_INTERVAL and hi / lo <= 2) or hi / lo <= 1 + 1e-5:
            out.append((lo, hi, n_lo - n_hi))
            continue
        mid, n_mid = _clear(a, mid)
        open_ += [(lo, mid, n_lo, n_mid), (mid, hi, n_mid, n_hi)]
    return sorted(out)


def feast(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric ``a`` in (low, high)."""
    n, random = len(a), np.random.default_rng(11)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(0.5j * np.pi * (1 - nodes))
    centre, radius = (low + high) / 2, (high - low) / 2
    exact = 16 * n * np.finfo(float).eps * np.linalg.norm(a)
    block = min(n, count + max(4, count // 2))
    while True:
        y = random.standard_normal((n, block))
        for _ in range(ROUNDS):
            q = np.zeros((n, block))
            for turn, weight in zip(turns, weights, strict=True):
                shifted = (centre + radius * turn) * np.eye(n) - a
                q += 0.5 * weight * (radius * turn * np.linalg.solve(shifted, y.astype(complex))).real
            u, size, _ = np.linalg.svd(q, full_matrices=False)
            u = u[:, size > size[0] * 1e-14]
            values, small = np.linalg.eigh(u.T @ a @ u)
            y = u @ small
            inside = (values > low) & (values < high)
            residual = np.linalg.norm(a @ y[:, inside] - y[:, inside] * values[inside], axis=0)
            if inside.sum() == count and residual.max(initial=0) <= exact:
                return values[inside], y[:, inside]
            if y.shape[1] < block:
                y = np.hstack([y, random.standard_normal((n, block - y.shape[1]))])
        if block == n:
            raise ArithmeticError(f"{int(inside.sum())} eigenvalues between {low} and {high}, inertia says {count}")
        block = min(n, 2 * block)


def leading(spark: SparkSession, a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of ``a`` (trace 1), falling, and their unit eigenvectors."""
    found = intervals(a, wanted)
    if not found:
        return np.zeros(0), np.zeros((len(a), 0))
    shared = spark.sparkContext.broadcast(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                values, vectors = feast(shared.value, row["low"], row["high"], row["count"])
                yield pa.RecordBatch.from_pydict({"value": values, "vector": pa.array(list(vectors.T), pa.list_(pa.float64()))})

    parts = spark.createDataFrame([(float(lo), float(hi), n) for lo, hi, n in found],"low double, high double, count int").repartition(len(found), "low")
    got = parts.mapInArrow(run, "value double, vector array<double>").collect()
    if len(got) != sum(c for _, _, c in found):
        raise ArithmeticError("an interval's eigenpairs are missing")
    # one more Rayleigh-Ritz step makes vectors of different intervals orthogonal to rounding
    q, _ = np.linalg.qr(np.array([r["vector"] for r in sorted(got, key=lambda r: -r["value"])]).T)
    values, small = np.linalg.eigh(q.T @ a @ q)
    return values[::-1][:wanted], (q @ small)[:, ::-1][:, :wanted]


# --- fitting and applying -------------------------------------------------------------------------


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS,
        grid: Grid = Grid()) -> dict[int, Fit]:
    """The whitening of the vectors of every length."""
    spark, fits = vectors.sparkSession, {}
    totals = _totals(vectors, column, grid)
    centres = {d: np.array([(2 * s + n) // (2 * n) for s in sums], "int64") for d, (n, sums) in totals.items()}
    moments = _second_moments(vectors, column, grid, centres) if totals else {}
    for d, (n, sums) in totals.items():
        rest = [s - n * int(m) for s, m in zip(sums, centres[d], strict=True)]
        v = np.array([[(n * moments[d][i][j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
        trace = float(np.trace(v))
        values, base = leading(spark, v / trace, min(components, d)) if trace else (np.zeros(0), np.zeros((d, 0)))
        fits[d] = Fit(n, centres[d], rest, trace, values * trace, base)
    _identity_errors(vectors, column, grid, fits)
    return fits


def _identity_errors(vectors: DataFrame, column: str, grid: Grid, fits: dict[int, Fit]) -> None:
    """Measure the whitened vectors' covariance over the table."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in slices(batches, "vec"):
            for d, _, x in _matrices(b.column("vec"), grid):
                w = shared.value[d].whitened(x)
                # the column of ones gives the sums beside the products
                w = np.hstack([np.ones((len(w), 1)), w])
                sums[d] = sums.get(d, 0) + w.T @ w
        for d, m in sums.items():
            yield _rows([(d, i, j, float(m[i, j])) for i in range(len(m)) for j in range(len(m))],
                        ["d", "i", "j", "v"])

    got = _sums_of(_vectors(vectors, column).mapInArrow(run, "d int, i int, j int, v double"), "d", "i", "j")
    for d, f in fits.items():
        k = len(f.values)
        m = np.zeros((k + 1, k + 1))
        for row in got:
            if row["d"] == d:
                m[row["i"], row["j"]] = row["v"] / f.n
        if k:
            f.identity_error = float(np.abs(m[1:, 1:] - np.outer(m[1:, 0], m[0, 1:]) - np.eye(k)).max())


def transform(vectors: DataFrame, fits: dict[int, Fit], id_column: str = "vec_id", column: str = "embedding",
              grid: Grid = Grid()) -> DataFrame:
    """Per vector that takes part: its id, its length ``d``, ``deviation``, ``whitened`` (an array,
    one entry a component that has variance)."""
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "vec"):
            for d, rows, x in _matrices(b.column("vec"), grid):
                f = shared.value[d]
                yield pa.RecordBatch.from_pydict({
                    id_column: b.column(id_column).take(pa.array(rows)), "d": pa.array([d] * len(rows), pa.int32()),
                    "deviation": pa.array(f.deviations(x), pa.int64()),
                    "whitened": pa.array(list(f.whitened(x)), pa.list_(pa.float64()))})

    return _vectors(vectors, column, F.col(id_column).cast("bigint").alias(id_column)) \
        .mapInArrow(run, f"`{id_column}` bigint, d int, deviation bigint, whitened array<double>")


def components(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", most: int = COMPONENTS,
               grid: Grid = Grid()) -> DataFrame:
    """One row per vector and component: its id, component, n, deviation, whitened, explained, identity_error."""
    fits = fit(vectors, column, most, grid)
    facts = [(d, k + 1, f.n, (float(f.values[k] / f.trace) if k < len(f.values) else 0.0) if f.trace else None,
              f.identity_error) for d, f in fits.items() for k in range(min(most, d))]
    # a row per component and length of vector: 32 rows where all vectors have one length
    facts =vectors.sparkSession.createDataFrame(
        facts, "d int, component int, n bigint, explained double, identity_error double")
    rows = transform(vectors, fits, id_column, column, grid)
    each = rows.withColumn("component", F.explode(F.sequence(F.lit(1), F.least(F.col("d"), F.lit(most)))))
    return each.join(F.broadcast(facts), ["d", "component"]) \
        .select(id_column, "component", "n", "deviation", F.get("whitened", F.col("component") - 1).alias("whitened"),
                "explained", "identity_error")
