"""Whitening of embeddings: leading components of the covariance by contour integration (FEAST).

An entry c counts as the integer x = floor(1024 c) + 100000. Two passes over the rows give exact
sums: S and n, then products of entries centred at the integer next to the mean. So the covariance
is the exact one, rounded once, whatever the number of tasks. It has the size of the dimension and
is solved on the driver; nothing there grows with the rows.

``leading`` projects random vectors onto the eigenvectors of an interval by a quadrature of
(z I - V)^-1 along a circle around it, and takes Ritz pairs from what is left, until they have
converged. Intervals come from inertia counts (signs of the pivots of a shifted factorisation of the
tridiagonal form), and the same counts show that no eigenvalue of an interval was missed.

Rows whose vector is null or holds null or non-finite entries are left out, and so are those with
entries of 2^42 and more, whose x no double holds exactly. Repeated rows each count. Vectors of
different lengths are fit lists of their own; an empty vector has no components. A component of no
variance has null ``whitened`` and is explained by 0; a table of equal vectors has a trace of 0 and
null ``explained``. An empty table gives no rows. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T

from estatelens.session import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 42)
SLICE = 4_096                # rows of one product, so that it stays exact for usual entries
NODES, TURNS, GROUP, SEED = 12, 40, 4, 11
EPS = np.finfo(float).eps
OUT = T.StructType([T.StructField("dim", T.IntegerType()),
                    T.StructField("deviation", T.DecimalType(38, 0)),
                    T.StructField("values", T.ArrayType(T.DoubleType()))])


@dataclass
class Fit:
    """What whitening needs for vectors of one length. Eigenvalues fall; components are columns."""
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    centre: np.ndarray = field(init=False)
    rest: list[int] = field(init=False)

    def __post_init__(self):
        self.centre = np.array([_nearest(s, self.n) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    @property
    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace else None for e in self.eigenvalues]

    def apply(self, x: np.ndarray) -> tuple[list[int], list[list[float | None]]]:
        """Exact deviations and whitened values of integer vectors."""
        z = x - self.centre
        rest = np.array(self.rest, np.int64)
        top = int(np.abs(z).max(initial=0))
        small = top * top * max(1, z.shape[1]) < 1 << 62 and top * self.n * max(1, z.shape[1]) < 1 << 62
        whole = z if small else z.astype(object)
        squares, mixed = (whole * whole).sum(axis=1), (whole * rest).sum(axis=1)
        fixed = sum(r * r for r in self.rest)
        n = self.n
        deviation = [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, mixed)]
        centred = z - rest / n
        seen = self.eigenvalues > 0
        values = centred @ self.components[:, seen] / np.sqrt(self.eigenvalues[seen])
        if seen.all():
            return deviation, values.tolist()
        gap = [None] * int((~seen).sum())
        return deviation, [[*row, *gap] for row in values.tolist()]


def _nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


# ------------------------------------------------------------------------------- eigenvectors
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix."""
    a, d = v.copy(), len(v)
    for k in range(d - 2):
        u = a[k + 1:, k].copy()
        norm = np.linalg.norm(u)
        if norm == 0:
            continue
        u[0] += norm if u[0] >= 0 else -norm
        u /= np.linalg.norm(u)
        a[k + 1:, :] -= 2 * np.outer(u, u @ a[k + 1:, :])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """How many eigenvalues lie above a number, from the signs of pivots."""

    def __init__(self, v: np.ndarray):
        self.diagonal, off = tridiagonal(v)
        self.squares = [0.0, *(off * off).tolist()]
        self.bound = float(np.abs(v).sum(axis=1).max())
        self.least = EPS * EPS * max(self.bound, 1e-300)

    def above(self, at: float) -> int:
        count, pivot = 0, 1.0
        for d, square in zip(self.diagonal.tolist(), self.squares):
            pivot = d - at - square / pivot
            if abs(pivot) < self.least:
                pivot = -self.least
            count += pivot > 0
        return count

    def place(self, k: int, tolerance: float) -> float:
        """The k-th largest eigenvalue (from 1), to ``tolerance``."""
        low, high = -self.bound, self.bound
        while high - low > tolerance:
            middle = (low + high) / 2
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)
        return (low + high) / 2


def contour(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of v between low and high, and their vectors.

    Raises if that many do not come out: none is missed silently.
    """
    d = len(v)
    rng = np.random.default_rng(SEED)
    width = min(d, 2 * count + 8)
    t, w = np.polynomial.legendre.leggauss(NODES)
    arc = np.exp(-0.5j * np.pi * (t - 1))
    middle, radius = (low + high) / 2, (high - low) / 2
    limit = 64 * EPS * np.abs(v).sum(axis=1).max()
    while True:
        y = rng.normal(size=(d, width))
        before = np.inf
        for _ in range(TURNS):
            q = np.zeros_like(y)
            for point, weight in zip(arc, w):
                shifted = (middle + radius * point) * np.eye(d) - v
                q += (radius * point * weight / 2 * np.linalg.solve(shifted, y)).real
            q = np.linalg.qr(q)[0]
            values, inner = np.linalg.eigh(q.T @ v @ q)
            y = q @ inner
            inside = np.flatnonzero((values > low) & (values <= high))
            miss = np.linalg.norm(v @ y[:, inside] - y[:, inside] * values[inside], axis=0)
            worst = miss.max(initial=0.0)
            if len(inside) == count and worst <= limit and worst >= before / 2:
                return values[inside], y[:, inside]     # no turn makes it better any more
            before = worst
        if width == d:
            raise ArithmeticError(f"{len(inside)} of {count} eigenvalues between {low} and {high}")
        width = min(d, 2 * width)


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors as columns. v: symmetric, no
    negative eigenvalues; those that rounding cannot tell from 0 are 0, with zero vectors."""
    d = len(v)
    k = min(k, d)
    values, vectors = np.zeros(k), np.zeros((d, k))
    scale = float(np.abs(v).max(initial=0.0))
    if not scale:
        return values, vectors
    v = v / scale
    inertia = Inertia(v)
    fine = 4 * d * EPS * inertia.bound
    wanted = min(k, inertia.above(4 * fine))
    places = [inertia.place(i, fine) for i in range(1, wanted + 1)]
    tied = 1e-9 * inertia.bound
    while True:                      # eigenvalues equal to the last one belong to its interval
        n = len(places)
        beyond = inertia.place(n + 1, fine) if n < d else places[-1] - inertia.bound
        if places[-1] - beyond > tied:
            break
        places.append(beyond)
    gaps = [a - b for a, b in zip(places, [*places[1:], beyond])]
    found = []
    done, high = 0, places[0] + gaps[-1] + inertia.bound / d
    while done < n:                  # intervals of a few eigenvalues, cut at the widest gap
        cut = max(range(done, min(done + GROUP, n)), key=lambda i: gaps[i])
        while gaps[cut] <= tied:
            cut += 1
        low = places[cut] - gaps[cut] / 2
        found.append(contour(v, low, high, inertia.above(low) - inertia.above(high))[1])
        done, high = cut + 1, low
    # Vectors of neighbouring intervals are made orthogonal together.
    q = np.linalg.qr(np.hstack(found))[0]
    e, inner = np.linalg.eigh(q.T @ v @ q)
    vectors[:, :wanted] = (q @ inner)[:, ::-1][:, :wanted]
    values[:wanted] = e[::-1][:wanted] * scale
    top = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)]
    vectors[:, top < 0] *= -1
    return values, vectors


# --------------------------------------------------------------------------------- on Spark
def usable(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector takes part."""
    v = F.col(column)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < LARGEST))
    return rows.where(v.isNotNull()).where(fine)


def by_length(vectors: pa.Array):
    """(places of the rows, their integer vectors) per length, in slices."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(SCALE * flat).astype(np.int64) + SHIFT
    start = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        for a in range(0, len(rows), SLICE):
            part = rows[a:a + SLICE]
            yield part, x[start[part][:, None] + np.arange(dim)]


def _exact_sum(x: np.ndarray) -> list[int]:
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [(int(h) << 26) + int(l) for h, l in zip(high.sum(axis=0), low.sum(axis=0))]


def _products(z: np.ndarray) -> np.ndarray:
    """z'z in exact integers."""
    top = int(np.abs(z).max(initial=0))
    if top * top * len(z) < 1 << 53:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    whole = z.astype(object)
    return whole.T @ whole


def _decimals(values) -> pa.Array:
    from decimal import Decimal
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def fit(rows: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> dict[int, Fit]:
    """Length of vectors -> what whitens them. Reads the column twice."""
    vectors = usable(rows, column).select(F.col(column).cast("array<double>").alias("v"))

    def add(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for _, x in by_length(batch.column("v")):
                have = totals.setdefault(x.shape[1], [0, [0] * x.shape[1]])
                have[0] += len(x)
                have[1] = [a + b for a, b in zip(have[1], _exact_sum(x))]
        for dim, (n, sums) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                 pa.array([n] * dim, pa.int64()), _decimals(sums)], ["dim", "i", "n", "s"])

    summed = vectors.mapInArrow(add, "dim int, i int, n bigint, s decimal(38,0)").groupBy(
        "dim", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))
    sums: dict[int, dict[int, Row]] = {}
    for r in summed.collect():               # one row per dimension
        sums.setdefault(r.dim, {})[r.i] = r
    centres = {dim: np.array([_nearest(int(of[i].s), of[i].n) for i in range(dim)], np.int64)
               for dim, of in sums.items()}

    def multiply(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch.column("v")):
                p = _products(x - centres[x.shape[1]]).astype(object)
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + p
        for dim, p in totals.items():
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(i), pa.int32()), pa.array(i, pa.int32()),
                 pa.array(j, pa.int32()), _decimals(p[i, j])], ["dim", "i", "j", "p"])

    multiplied = vectors.mapInArrow(multiply, "dim int, i int, j int, p decimal(38,0)").groupBy(
        "dim", "i", "j").agg(F.sum("p").cast("decimal(38,0)").alias("p"))
    covariance = {dim: np.zeros((dim, dim)) for dim in sums}
    for r in multiplied.collect():           # one row per pair of dimensions
        of, m = sums[r.dim], centres[r.dim]
        n = of[r.i].n
        rest = [int(of[x].s) - n * int(m[x]) for x in (r.i, r.j)]
        covariance[r.dim][r.i, r.j] = covariance[r.dim][r.j, r.i] = (
            (n * int(r.p) - rest[0] * rest[1]) / (n * n))
    out = {}
    for dim, v in covariance.items():
        e, u = leading(v, k)
        out[dim] = Fit(sums[dim][0].n, [int(sums[dim][i].s) for i in range(dim)], e, u,
                       float(np.trace(v)))
    return out


def whiten(rows: DataFrame, fits: dict[int, Fit], name: str, column: str = "embedding") -> DataFrame:
    """The usable rows with all their columns and ``name``: length, exact deviation and whitened
    values. Rows of a length that was not fitted, and empty vectors, get null."""
    names = [*rows.columns, name]

    def run(batches):
        for batch in batches:
            dims = [None] * batch.num_rows
            deviations, values = list(dims), list(dims)
            for part, x in by_length(batch.column(column).cast(pa.list_(pa.float64()))):
                if x.shape[1] in fits:
                    got = fits[x.shape[1]].apply(x)
                    for i, deviation, value in zip(part.tolist(), *got):
                        dims[i], deviations[i], values[i] = x.shape[1], deviation, value
            seen = np.array([v is not None for v in values], bool)
            exact = pa.array([None if d is None else d for d in deviations], pa.decimal128(38, 0))
            added = pa.StructArray.from_arrays(
                [pa.array(dims, pa.int32()), exact, pa.array(values, pa.list_(pa.float64()))],
                names=["dim", "deviation", "values"], mask=pa.array(~seen))
            yield pa.RecordBatch.from_arrays([*batch.columns, added], names)

    return usable(rows, column).mapInArrow(
        run, T.StructType([*rows.schema.fields, T.StructField(name, OUT)]))


def identity_errors(whitened: DataFrame, name: str, k: int = COMPONENTS) -> dict[int, float]:
    """Length -> largest entry of the whitened values' covariance less the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    value = [F.get(f"{name}.values", F.lit(i)) for i in range(k)]
    rows = whitened.where(f"{name} is not null").groupBy(F.col(f"{name}.dim").alias("dim")).agg(
        *[F.covar_pop(value[i], value[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()
    return {r.dim: max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs
                        if r[f"c{i}_{j}"] is not None), default=None) for r in rows}


def components(rows: DataFrame, column: str = "embedding", key: str = "vec_id",
               k: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: (key, component, n, deviation, whitened, explained,
    identity_error, deviation_exact). deviation is null where a long cannot hold it."""
    rows = rows.select(F.col(key).alias("key"), F.col(column).alias("vector"))
    fits = fit(rows, "vector", k)
    done = written(whiten(rows, fits, "found", "vector").select("key", "found"), "whitened")
    errors = identity_errors(done, "found", k)
    known = rows.sparkSession.createDataFrame(       # at most k rows per length
        [(dim, i, f.n, share, errors.get(dim)) for dim, f in fits.items()
         for i, share in enumerate(f.explained)],
        "dim int, i int, n bigint, explained double, identity_error double")
    long = done.where("found is not null").select(
        "key", "found.dim", F.col("found.deviation").alias("deviation_exact"),
        F.posexplode("found.values").alias("i", "whitened"))
    return long.join(F.broadcast(known), ["dim", "i"]).select(
        F.col("key").alias(key), (F.col("i") + 1).alias("component"), "n",
        F.col("deviation_exact").try_cast("bigint").alias("deviation"), "whitened", "explained",
        "identity_error", "deviation_exact")
