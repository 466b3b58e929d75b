"""Nearest neighbours by largest inner product, with collision-counting hashing.

Each vector is hashed by single random projections. A block of vectors keeps, per projection, its
vectors sorted by their value. A query opens a window around its own value in every sorted array; a
vector in the window collides there. Windows widen (virtual rehashing: the same arrays at a larger
radius, no new tables) until enough vectors have collided in a share ``COLLISIONS`` of the
projections; those are verified with exact inner products in double precision.

Inner products become distances by one more component: a vector x of norm at most M is hashed as
(x / M, sqrt(1 - |x|^2 / M^2)) and a query q as (q / |q|, 0), so that nearer means a larger product.

Vectors are dealt to blocks of about ``BLOCK`` and queries to chunks of about ``CHUNK`` by hash; a
task has one block and one chunk, so memory does not grow with the table. Every row is in an index,
and every query meets every block, which is what a query set against all rows costs; within a block
only about ``VERIFIED`` of the vectors are verified (``LEAST`` times k in a small block). Sampled: the radius at which windows start is
set per block from ``SAMPLE`` of its vectors.

Vectors that are null, empty, zero or hold a null or a value that is not finite take no part; nor
do rows without vec_id. Of rows with equal vec_id the one with the smallest vector counts. Vectors
of different lengths are never compared. Ties go to the smaller vec_id. Vectors of any size take
part; a product beyond the range of a double is infinite. Only vec_id and embedding are read, so other
columns and their names do not matter. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

K, EVERY = 20, 20
PROJECTIONS, COLLISIONS, VERIFIED = 64, 0.7, 0.25
BLOCK, CHUNK, SAMPLE, WIDEN, ROUNDS, SEED = 16_384, 2_048, 32, 1.08, 40, 11
LEAST = 50                  # vectors to verify per neighbour asked for, in a small block
FOUND = "query_id bigint, vec_id bigint, score double"


class Index:
    """Sorted projections of one block. ``enough``: vectors to verify for a query, at least."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, top_norm: float, k: int):
        self.vectors, self.ids = vectors, ids
        n, dim = vectors.shape
        rng = np.random.default_rng(SEED + dim)
        self.lines = rng.normal(size=(dim + 1, PROJECTIONS))
        unit = vectors / top_norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        values = unit @ self.lines[:-1] + rest[:, None] * self.lines[-1]
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order, 0).T)
        self.order = np.ascontiguousarray(order.T)
        self.needed = int(np.ceil(COLLISIONS * PROJECTIONS))
        self.enough = min(n, max(LEAST * k, int(VERIFIED * n)))
        self.radius = self._start(np.sort(rng.choice(n, min(n, SAMPLE), replace=False)), k)

    def _project(self, queries: np.ndarray) -> np.ndarray:
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)     # no square over- or underflows
        return (scaled / np.linalg.norm(scaled, axis=1)[:, None]) @ self.lines[:-1]

    def _windows(self, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of every query's window in each sorted array."""
        low, high = (np.stack([np.searchsorted(self.sorted[j], at[:, j] + side * radius, edge)
                               for j in range(PROJECTIONS)], axis=1)
                     for side, edge in ((-1, "left"), (1, "right")))
        return low, high

    def _start(self, rows: np.ndarray, k: int) -> float:
        """The radius at which a middling query has enough candidates."""
        at = self._project(self.vectors[rows])
        values = np.empty((len(self.ids), PROJECTIONS))
        for j in range(PROJECTIONS):
            values[self.order[j], j] = self.sorted[j]
        reach = []
        for q in at:                     # distance at which a vector has collided often enough
            far = np.partition(np.abs(values - q), self.needed - 1, axis=1)[:, self.needed - 1]
            reach.append(np.partition(far, self.enough - 1)[self.enough - 1])
        return float(np.median(reach)) * (1 + 1e-9) + 1e-12

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int):
        """(query, vec_id, score) of up to k verified vectors per query."""
        n = len(self.ids)
        at = self._project(queries)
        low, high = self._windows(at, self.radius)
        out = []
        for i in range(len(queries)):
            a, b, radius = low[i], high[i], self.radius
            parts = [self.order[j, a[j]:b[j]] for j in range(PROJECTIONS)]
            hits = np.bincount(np.concatenate(parts), minlength=n)
            chosen = np.flatnonzero(hits >= self.needed)
            for turn in range(ROUNDS):
                if len(chosen) >= self.enough:
                    break
                radius = radius * WIDEN if turn < ROUNDS - 1 else np.inf
                (new_a,), (new_b,) = self._windows(at[i:i + 1], radius)
                parts = [self.order[j, x:y] for j in range(PROJECTIONS)
                         for x, y in ((new_a[j], a[j]), (b[j], new_b[j]))]
                hits += np.bincount(np.concatenate(parts), minlength=n)
                a, b = new_a, new_b
                chosen = np.flatnonzero(hits >= self.needed)
            chosen = chosen[self.ids[chosen] != query_ids[i]]
            # Row by row in one order: equal vectors get equal scores in any company.
            score = (self.vectors[chosen] * queries[i]).sum(axis=1)
            if len(chosen) > k:
                edge = -np.partition(-score, k - 1)[k - 1]
                near = score >= edge
                chosen, score = chosen[near], score[near]
            order = np.lexsort((self.ids[chosen], -score))[:k]
            out.append((np.full(len(order), query_ids[i]), self.ids[chosen][order], score[order]))
        return tuple(np.concatenate(c) for c in zip(*out))


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    flat = pa.concat_arrays(table["v"].chunks).flatten().to_numpy()
    vectors, ids = flat.reshape(table.num_rows, -1), table["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    return vectors[order], ids[order]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, dim, largest, norm) of the vectors that take part."""
    given = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = given.where((F.size("v") > 0) & finite).groupBy("vec_id").agg(F.min("v").alias("v"))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    return whole.select("vec_id", "v", F.size("v").alias("dim"), largest.alias("largest")).where(
        "largest > 0").withColumn("norm", F.col("largest") * F.sqrt(F.aggregate(
            F.transform("v", lambda x: x / F.col("largest")), F.lit(0.0), lambda total, x: total + x * x)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK,
            chunk: int = CHUNK) -> DataFrame:
    """Both tables: vec_id, embedding. (query_id, rank, vec_id, score), the query's own vec_id
    left out."""
    data, asked = usable(vectors), usable(queries)
    per_dim = (data.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")).join(
        asked.groupBy("dim").agg(F.count("*").alias("n_queries")), "dim"))
    sized = per_dim.select("dim", "top",
                           F.ceil(F.col("n") / block).cast("int").alias("blocks"),
                           F.ceil(F.col("n_queries") / chunk).cast("int").alias("chunks"))
    rows = data.join(sized, "dim").select(
        "dim", "vec_id", "v", "top", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    sought = asked.join(sized, "dim").select(
        "dim", "vec_id", "v", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        index = Index(*_vectors(left), left["top"][0].as_py(), k)
        found = index.search(*_vectors(right), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    cell = [F.col(c).cast("bigint") for c in ("dim", "block", "chunk")]
    found = rows.groupBy(*cell).cogroup(sought.groupBy(*cell)).applyInArrow(run, FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
