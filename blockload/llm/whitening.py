"""Embedding whitening (operator 11).

Vectors are put on a whole-number scale, x = floor(1024 c) + 100000, centred
by their exact sums and projected on the leading eigenvectors of their
covariance, each divided by the root of its eigenvalue.

Three passes over the vectors, all of them maps with small partial sums:
counts and exact sums; the scatter of the centred vectors; and the projection,
whose own covariance is measured in a pass of the same kind. Partial scatters
are added up by Spark in bands of rows, so no task holds more than a band of
them, and the driver gets one matrix of dim x dim, whose size does not depend on
the number of vectors. It is brought to tridiagonal form by Householder
reflections; Sturm counts bisect for the leading eigenvalues; inverse iteration
gives their vectors, made orthogonal within clusters of near eigenvalues and
turned back. The projection is broadcast (components x dim numbers).

Defined results: vectors that are null, empty, or hold null or non-finite
entries take no part; vectors are whitened with those of their own length;
repeated rows and null ids count as rows of their own. A component whose
eigenvalue is zero within rounding (fewer rows than components, constant
dimensions) cannot be whitened and is not returned, so a single vector has no
rows. ``deviation`` is exact; where it passes 63 bits it is null and
``deviation_exact`` (a decimal, null from 10^38 on) alone holds it. An entry too large for a 62-bit
x raises. Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockload.llm.runtime import partitions_for, pick, ship, tidy

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BAND = 64                # rows of a partial matrix that travel together
ZERO = 1e-12             # of the trace: an eigenvalue below is rounding
CLUSTER = 1e-3           # of the matrix's norm: eigenvalues nearer than this are one cluster

SUMS = "dim int, n long, j int, total decimal(38,0)"
BANDS = "dim int, band int, task long, data binary"
WHITENED = ("vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, "
            "explained double, dim int")


# --- the vectors -----------------------------------------------------------------

def whole(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, dim and the vector (as doubles) of the rows that take part."""
    fits = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return pick(vectors, "vec_id", column).where(F.col(column).isNotNull()).where(
        (F.size(column) > 0) & fits).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size(column).alias("dim"),
        F.transform(F.col(column), lambda v: v.cast("double")).alias("c"))


def numbers(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, row places, x as 64-bit whole numbers) for each length in a batch."""
    dims = batch.column("dim").to_numpy()
    flat = np.floor(batch.column("c").flatten().to_numpy(zero_copy_only=False) * SCALE)
    if len(flat) and np.abs(flat).max() >= float(1 << 62):
        raise OverflowError("an entry is too large for a whole number of 62 bits")
    flat = flat.astype(np.int64) + SHIFT
    begin = np.cumsum(dims) - dims
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, flat[begin[rows][:, None] + np.arange(dim)]


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums, in whole numbers of any size."""
    if np.abs(x).max() < (1 << 62) // len(x):
        return [int(v) for v in x.sum(axis=0)]
    return [sum(int(v) for v in col) for col in x.T]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        for dim, _, x in numbers(batch):
            n, s = held.get(dim, (0, [0] * dim))
            held[dim] = n + len(x), [a + b for a, b in zip(s, exact_sums(x))]
    for dim, (n, s) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(range(dim), pa.int32()),
             pa.array([Decimal(v) for v in s], pa.decimal128(38, 0))], names=["dim", "n", "j", "total"])


def moments(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the number of vectors and the exact sum of each dimension."""
    parts = rows.select("dim", "c").mapInArrow(tidy(_sums), SUMS)
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("s")).orderBy("dim", "j").collect():
        found.setdefault(r.dim, (r.n, []))[1].append(int(r.s))
    return found


# --- sums of small matrices over all tasks ----------------------------------------

def _band_rows(held: dict[int, np.ndarray], task: int) -> Iterator[pa.RecordBatch]:
    for dim, m in held.items():
        bands = [m[i:i + BAND] for i in range(0, len(m), BAND)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * len(bands), pa.int32()), pa.array(range(len(bands)), pa.int32()),
             pa.array([task] * len(bands), pa.int64()), pa.array([b.tobytes() for b in bands], pa.binary())],
            names=["dim", "band", "task", "data"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands sorted by (dim, band, task), added up one after the other."""
    key, total = None, None
    out = lambda: pa.RecordBatch.from_arrays(
        [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([0], pa.int64()),
         pa.array([total.tobytes()], pa.binary())], names=["dim", "band", "task", "data"])
    for batch in batches:
        for dim, band, data in zip(*(batch.column(c).to_pylist() for c in ("dim", "band", "data"))):
            m = np.frombuffer(data)
            if (dim, band) == key:
                total = total + m
                continue
            if key is not None:
                yield out()
            key, total = (dim, band), m
    if key is not None:
        yield out()


def summed(parts: DataFrame, widths: dict[int, int]) -> dict[int, np.ndarray]:
    """The sum of all partial matrices of each length, added in the order of
    the tasks, so that reruns agree; ``widths`` gives their columns."""
    n = partitions_for(sum(-(-w // BAND) for w in widths.values()), 4)
    added = parts.repartition(n, "dim", "band").sortWithinPartitions("dim", "band", "task").mapInArrow(tidy(_added), BANDS)
    found: dict[int, list[np.ndarray]] = {}
    for r in sorted(added.collect(), key=lambda r: (r.dim, r.band)):
        found.setdefault(r.dim, []).append(np.frombuffer(r.data).reshape(-1, widths[r.dim]))
    return {dim: np.concatenate(bands) for dim, bands in found.items()}


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _scatter(means: dict[int, np.ndarray]):
    """Per length a matrix of the centred vectors: their products, and in a last
    row their sums, which take out what rounding of the mean leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in numbers(batch):
                y = x - means[dim]
                held[dim] = held.get(dim, 0.0) + np.vstack([y.T @ y, y.sum(axis=0)])
        yield from _band_rows(held, _task())
    return run


def centred(total: np.ndarray, n: int) -> np.ndarray:
    """The covariance from a summed scatter matrix."""
    rest = total[-1] / n
    return total[:-1] / n - np.outer(rest, rest)


# --- eigenvectors of a symmetric matrix -------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reflections to tridiagonal form: diagonal, off-diagonal and
    the reflections' unit vectors, in the order of their use."""
    a, n = a.copy(), len(a)
    mirrors = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length > 0:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
            w = 2 * (a[k + 1:, k + 1:] @ v)
            w -= (w @ v) * v
            a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
            a[k + 1:, k] = a[k, k + 1:] = 0
            a[k + 1, k] = a[k, k + 1] = -np.copysign(length, v[0])
        mirrors.append(v if length > 0 else np.zeros(n - k - 1))
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def turned_back(y: np.ndarray, mirrors: list[np.ndarray]) -> np.ndarray:
    """A vector of the tridiagonal matrix in the given one's coordinates."""
    y = y.copy()
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        y[k + 1:] -= 2 * (v @ y[k + 1:]) * v
    return y


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of ``at``."""
    least = np.finfo(float).tiny
    count = np.zeros(len(at), int)
    q = np.ones(len(at))
    for i in range(len(d)):
        q = d[i] - at - (e[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bit."""
    n = len(d)
    reach = np.abs(np.r_[0, e]) + np.abs(np.r_[e, 0])
    lo, hi = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    hi = hi + np.abs(hi) * 1e-15 + np.finfo(float).tiny
    wanted = n - 1 - np.arange(k)                  # so many eigenvalues are smaller
    for _ in range(200):
        middle = (lo + hi) / 2
        if ((middle <= lo) | (middle >= hi)).all():
            break
        high = below(d, e, middle) > wanted
        hi, lo = np.where(high, middle, hi), np.where(high, lo, middle)
    return (lo + hi) / 2


def solved(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = b for a tridiagonal T, by elimination with row swaps."""
    n = len(d)
    main, up, up2, b = d - shift, np.r_[e, 0.0], np.zeros(n), b.copy()
    low = e.copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(main[i]):
            main[i], low[i] = low[i], main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < floor:
            main[i] = floor
        f = low[i] / main[i]
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        b[i + 1] -= f * b[i]
    if abs(main[-1]) < floor:
        main[-1] = floor
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        x[i] = b[i]
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= main[i]
    return x


def leading_vectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit
    eigenvectors as rows."""
    k = min(k, len(a))
    d, e, mirrors = tridiagonal(a)
    values = leading_values(d, e, k)
    norm = max(np.abs(d).max(), np.abs(e).max() if len(e) else 0.0, np.finfo(float).tiny)
    floor = norm * np.finfo(float).eps
    rng, rows = np.random.default_rng(11), []
    first = 0                                      # of the cluster
    for i in range(k):
        if i and values[i - 1] - values[i] > CLUSTER * norm:
            first = i
        # Equal eigenvalues are moved apart by rounding, so that each iteration
        # does not run into the vector of the one before.
        shift = values[i] - (i - first) * 4 * floor
        y = rng.normal(size=len(a))
        for _ in range(6):
            for _ in range(2):
                for z in rows[first:i]:
                    y -= (z @ y) * z
                y /= np.linalg.norm(y)
            y = solved(d, e, shift, y, floor)
        for _ in range(2):
            for z in rows[first:i]:
                y -= (z @ y) * z
            y /= np.linalg.norm(y)
        rows.append(y)
    vectors = np.array([turned_back(y, mirrors) for y in rows])
    return values, vectors * np.where(np.take_along_axis(
        vectors, np.abs(vectors).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)


# --- projection ---------------------------------------------------------------------

class Fit:
    """What the projection of the vectors of one length needs."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, k: int) -> None:
        self.n, self.sums = n, sums
        self.mean = np.array([s / n for s in sums])
        trace = float(np.trace(covariance))
        values, vectors = leading_vectors(covariance, k) if trace > 0 else (np.zeros(0), np.zeros((0, len(sums))))
        real = values > ZERO * trace
        self.explained = (values / trace if trace > 0 else values)[real]
        self.projection = vectors[real] / np.sqrt(values[real])[:, None]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.projection.T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over the dimensions of (n x - S)^2, exact: with x = c + u for
        whole c near the mean, they are n^2 sum u^2 - 2 n sum u r + sum r^2."""
        near = [round(s / self.n) for s in self.sums]
        rest = [s - self.n * c for s, c in zip(self.sums, near)]
        u = x - np.array(near, np.int64)
        most, far, dim = int(np.abs(u).max()), max(abs(r) for r in rest), len(rest)
        kind = np.int64 if max(most * most, most * far) * dim < 1 << 62 else object
        u, r = u.astype(kind), np.array(rest, kind)
        squares, mixed, last = (u * u).sum(axis=1), (u * r).sum(axis=1), sum(v * v for v in rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + last for a, b in zip(squares, mixed)]


def _spread(fits):
    """Partial scatter of the whitened vectors, for the measured error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in numbers(batch):
                w = fits.value[dim].whitened(x)
                if w.shape[1]:
                    held[dim] = held.get(dim, 0.0) + np.vstack([w.T @ w, w.sum(axis=0)])
        yield from _band_rows(held, _task())
    return run


def _projected(fits):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.int32()]
    names = [c.split()[0] for c in WHITENED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, rows, x in numbers(batch):
                fit = fits.value[dim]
                w, k = fit.whitened(x), len(fit.explained)
                if not k:
                    continue
                exact = fit.deviations(x)
                fitting = [v if v < 1 << 63 else None for v in exact]
                decimals = [Decimal(v) if v < 10 ** 38 else None for v in exact]
                m, each = len(rows), pa.array(np.repeat(np.arange(len(rows)), k))
                cols = [ids.take(pa.array(np.repeat(rows, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                        np.full(m * k, fit.n), pa.array(fitting, pa.int64()).take(each), pa.array(decimals, kinds[4]).take(each),
                        w.ravel(), np.tile(fit.explained, m), np.full(m * k, dim, np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error, deviation_exact and dim: one row per vector and component."""
    spark = vectors.sparkSession
    ship(spark)
    rows = whole(vectors, column)
    sums = moments(rows)
    parts = rows.select("dim", "c").mapInArrow(
        tidy(_scatter({d: np.array([s / n for s in t]) for d, (n, t) in sums.items()})), BANDS)
    scatter = summed(parts, {d: d for d in sums}) if sums else {}
    made = {d: Fit(n, t, centred(scatter[d], n), components) for d, (n, t) in sums.items()}
    fits = spark.sparkContext.broadcast(made)      # components x dim numbers for each length

    widths = {d: len(f.explained) for d, f in made.items() if len(f.explained)}
    spread = summed(rows.select("dim", "c").mapInArrow(tidy(_spread(fits)), BANDS), widths) if widths else {}
    errors = {d: float(np.abs(centred(m, made[d].n) - np.eye(widths[d])).max()) for d, m in spread.items()}
    error = F.create_map(*[F.lit(v) for pair in errors.items() for v in pair]) if errors else F.lit(None)
    told = rows.mapInArrow(tidy(_projected(fits)), WHITENED)
    measured = F.element_at(error, F.col("dim")) if errors else error.cast("double")
    return told.select("vec_id", "component", "n", "deviation", "whitened", "explained",
                       measured.alias("identity_error"), "deviation_exact", "dim")
