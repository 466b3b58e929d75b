"""Near-copies among embeddings: iterative quantisation, multi-index Hamming tables, reranking.

A rotation is learned that makes the signs of the rotated, centred unit vectors a good code: signs
and the best rotation for them are found in turn. The bits of a code are split over a few tables.
Two vectors of cosine c are 2 - 2 c apart (squared), and a bit in which they differ takes
(|a_i| + |b_i|)^2 of that, where a_i and b_i are the rotated values. So in some table the differing
bits cost one of the two at most half of its share in squares of its own values, and this one finds
the other when it looks up all keys that it reaches by turning bits of so small values. No pair is
lost, whatever the rotation: the rotation, learned from at most ``SAMPLE`` vectors, decides only how
many keys and candidates there are.

A candidate must pass the same bound over the whole code, by bit counts, and then the cosine of the
original vectors in double precision. A pair that meets in several tables counts in the first.

Tables are dealt by label, table and the leading bits of the key into blocks of about ``BLOCK``
vectors; a vector goes to its own block and as a visitor to those that its turned bits reach. A block
that holds many more is split into cells of owners and visitors, so that no task gets an unbounded
group. Equal vectors of a label are one class, counted, never paired. Blocks return for each vector
the number of its links there and the smallest vector it is connected with: rows grow with vectors,
not with pairs. Vectors are longer keys as tables grow (``TABLE_BITS`` and more), as is usual for
such tables.

Vectors that are null, empty, zero or hold a null or non-finite component, and those without a
label, link with nothing; vectors of different lengths never link. Every row is a vector of its own,
also where rows are repeated or share a vec_id; rows without vec_id take part and are named by no
component unless it has no others. Empty tables give no rows. Other columns are kept, whatever their
names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from estatelens.llm.components import components
from estatelens.session import written

COSINE = 0.98
SAMPLE, TURNS, SEED = 20_000, 30, 11
CODE_BITS, TABLE_BITS, BLOCK = 64, 10, 4_096
ROOM = 1e-6                     # rounding of rotated values
UNIT = 1 << 40                  # squares of rotated values are compared as whole numbers
PAIRS, STATES = 1 << 16, 1 << 20        # worked on at a time


# ---------------------------------------------------------------------------------- codes
class Coder:
    """Rotation for vectors of one length, and what follows from it."""

    def __init__(self, mean: np.ndarray, turn: np.ndarray, table_bits: int, cosine: float):
        self.mean, self.turn = mean, turn
        bits = turn.shape[1]
        self.tables = np.array_split(np.arange(bits), max(1, bits // table_bits))
        self.starts = np.array([t[0] for t in self.tables])
        self.total = 2 - 2 * cosine + ROOM
        self.share = int(self.total / (2 * len(self.tables)) * UNIT)
        self.mark = math.sqrt(self.total) / 4

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """One coordinate after the other, so that a vector gets the same values in any company."""
        centred = x - self.mean
        out = np.zeros((len(x), self.turn.shape[1]))
        for j in range(x.shape[1]):
            out += centred[:, j:j + 1] * self.turn[j]
        return out

    def prefixes(self, bits: np.ndarray, cost: np.ndarray, table: int, width: np.ndarray):
        """(vector, prefix) of every block a vector visits, its own included. ``width``: leading
        bits that deal, by vector."""
        own = self.tables[table]
        rows, key = np.arange(len(bits)), np.zeros(len(bits), np.int64)
        left = np.full(len(bits), self.share)
        for k, bit in enumerate(own):
            if not (width > k).any():
                break
            used = width[rows] > k
            value = bits[rows, bit].astype(np.int64)
            turned = np.flatnonzero(used & (cost[rows, bit] <= left))
            key = np.where(used, key * 2 + value, key)
            more_key = (key[turned] ^ 1)
            rows, left = (np.concatenate([rows, rows[turned]]),
                          np.concatenate([left, left[turned] - cost[rows[turned], bit]]))
            key = np.concatenate([key, more_key])
        return rows, key


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of norm 1; scaled first, so that squares neither vanish nor overflow."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def learn(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotation (onto at most CODE_BITS directions) from unit vectors."""
    mean = x.mean(axis=0)
    y = x - mean
    bits = min(x.shape[1], CODE_BITS)
    _, axes = np.linalg.eigh(y.T @ y)
    axes = axes[:, ::-1][:, :bits]
    z = y @ axes
    turn = np.linalg.qr(np.random.default_rng(SEED).normal(size=(bits, bits)))[0]
    for _ in range(TURNS):
        signs = np.where(z @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ z)
        turn = (left @ right).T
    return mean, axes @ turn


def packed(bits: np.ndarray) -> np.ndarray:
    """Up to 64 bits a row as one number."""
    weights = np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64)
    return (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


# ---------------------------------------------------------------------------------- one cell
def reach(key: np.ndarray, left: np.ndarray, cost: np.ndarray, done: int):
    """(vector, key) of all keys that turning bits from place ``done`` on can reach."""
    rows = np.arange(len(key))
    width = cost.shape[1]
    for k in range(done, width):
        turned = np.flatnonzero(cost[rows, k] <= left)
        rows, key, left = (np.concatenate([rows, rows[turned]]),
                           np.concatenate([key, key[turned] ^ (1 << (width - 1 - k))]),
                           np.concatenate([left, left[turned] - cost[rows[turned], k]]))
    return rows, key


def _reach_in_parts(probes: np.ndarray, key, left, cost, done) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, STATES >> min(cost.shape[1] - done, 10))
    for a in range(0, len(probes), step):
        part = probes[a:a + step]
        rows, keys = reach(key[part], left[part], cost[part], done)
        yield part[rows], keys


def matches(coder: Coder, v: np.ndarray, table: int, prefix: int, width: int, owner: np.ndarray,
            visitor: np.ndarray, order: np.ndarray, cosine: float):
    """(first, second) rows of one cell that are near-copies and count here.

    ``order``: numbers that rank the vectors everywhere alike.
    """
    x = unit(v)
    w = coder.rotate(x)
    bits, cost = w > 0, np.floor(w * w * UNIT).astype(np.int64)
    code, strong = packed(bits), packed(np.abs(w) >= coder.mark)
    at = coder.tables[table]
    shifts = np.arange(len(at))[::-1]
    key = (bits[:, at].astype(np.int64) << shifts).sum(axis=1)
    rest = len(at) - width
    # Bits of the prefix that a visitor has to turn to come here.
    turned = ((key >> rest) ^ prefix)[:, None] >> np.arange(width)[::-1] & 1
    left = coder.share - (turned * cost[:, at[:width]]).sum(axis=1)
    start = (key & ((1 << rest) - 1)) | (prefix << rest)
    mine = np.flatnonzero(owner)
    mine = mine[np.argsort(key[mine], kind="stable")]
    keys = key[mine]
    probes = np.flatnonzero(visitor & (left >= 0))
    lengths = np.sqrt(np.einsum("ij,ij->i", v, v))
    plain = np.isfinite(lengths) & (lengths > 1e-100) & (lengths < 1e100)
    first, second = [], []
    for rows, sought in _reach_in_parts(probes, start, left, cost[:, at], width):
        low, high = np.searchsorted(keys, sought, "left"), np.searchsorted(keys, sought, "right")
        hit = high > low
        rows, low, count = rows[hit], low[hit], (high - low)[hit]
        ends = np.cumsum(count)
        for a in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            place = np.arange(a, min(a + PAIRS, int(ends[-1])))
            of = np.searchsorted(ends, place, "right")
            p = rows[of]
            o = mine[low[of] + place - (ends[of] - count[of])]
            differ = code[p] ^ code[o]
            both = np.bitwise_count(differ & strong[p] & strong[o]).astype(np.int64)
            one = np.bitwise_count(differ & (strong[p] ^ strong[o])).astype(np.int64)
            near = (p != o) & ((4 * both + one) * coder.mark ** 2 <= coder.total)
            p, o = p[near], o[near]
            dot = np.einsum("ij,ij->i", x[p], x[o])
            exact = plain[p] & plain[o]
            dot[exact] = (np.einsum("ij,ij->i", v[p[exact]], v[o[exact]])
                          / (lengths[p[exact]] * lengths[o[exact]]))
            near = dot >= cosine
            p, o = p[near], o[near]
            counts = _counts_here(coder, bits, cost, order, table, p, o)
            first.append(p[counts])
            second.append(o[counts])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def _counts_here(coder, bits, cost, order, table, p, o) -> np.ndarray:
    """Whether visitor p and owner o meet here first: in no earlier table, and here from the side of
    the smaller number if that side sees the other."""
    differ = bits[p] ^ bits[o]
    mine = np.add.reduceat(differ * cost[p], coder.starts, axis=1) <= coder.share
    other = np.add.reduceat(differ * cost[o], coder.starts, axis=1) <= coder.share
    earlier = (mine | other)[:, :table].any(axis=1)
    return ~earlier & ((order[p] < order[o]) | ~other[:, table])


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number connected with each of n numbers by links a-b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


# ---------------------------------------------------------------------------------- on Spark
def classes(rows: DataFrame) -> DataFrame:
    """Written table (label, v, id, vec_id, copies, dim): equal vectors of a label are one row."""
    grouped = rows.groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"),
                                             F.count("*").alias("copies"))
    return written(grouped.select("label", "v", F.monotonically_increasing_id().alias("id"), "vec_id",
                                  "copies", F.size("v").alias("dim")), "vectors")


def usable(label: str, v: str):
    """Whether a row takes part in links."""
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & F.col(v).isNotNull() & fine
                      & F.exists(v, lambda c: c != 0), F.lit(False))


def coders(known: DataFrame, n: int, table_bits: int, cosine: float) -> dict[int, Coder]:
    """Length -> coder, learned from about ``SAMPLE`` vectors chosen by hash."""
    part = min(1.0, 1.2 * SAMPLE / max(n, 1))
    chosen = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= int(part * (1 << 30))
    table = known.where(chosen).select(F.col("v").cast("array<double>").alias("v"), "id").orderBy(
        F.xxhash64("v"), "id").limit(SAMPLE).toArrow()
    vectors: dict[int, list] = {}
    for v in table["v"].to_pylist():
        vectors.setdefault(len(v), []).append(v)
    return {dim: Coder(*learn(unit(np.array(vs))), table_bits, cosine) for dim, vs in vectors.items()}


def _coder(known: dict[int, Coder], dim: int, table_bits: int, cosine: float) -> Coder:
    """A length that the sample has not: codes without a learned rotation find the same pairs."""
    if dim not in known:
        known[dim] = Coder(np.zeros(dim), np.eye(dim)[:, :CODE_BITS], table_bits, cosine)
    return known[dim]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def visits(batch: pa.RecordBatch, known, table_bits, cosine):
    """(row, table, prefix, own) of all blocks that the vectors of a batch go to."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        coder = _coder(known, dim, table_bits, cosine)
        for a in range(0, len(rows), BLOCK):
            part = rows[a:a + BLOCK]
            taken = batch.take(pa.array(part))
            w = coder.rotate(unit(_matrix(taken.column("v"), dim)))
            bits, cost = w > 0, np.floor(w * w * UNIT).astype(np.int64)
            deal = taken.column("deal").to_numpy()
            for t, at in enumerate(coder.tables):
                width = np.minimum(deal, len(at))
                seen, prefix = coder.prefixes(bits, cost, t, width)
                home = np.zeros(len(part), np.int64)
                for k, bit in enumerate(at):
                    home = np.where(width > k, home * 2 + bits[:, bit], home)
                yield part[seen], t, prefix, prefix == home[seen]


def links(known: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(id, n, root): for each vector and cell in which it has links, their number (copies counted)
    and a smaller or equal id it is connected with. ``known``: ``classes``."""
    sizes = written(known.groupBy("label", "dim").agg(F.count("*").alias("n")), "sizes")
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    table_bits = max(TABLE_BITS, math.ceil(math.log2(max(1, largest / block))))
    coder_of = coders(known, total, table_bits, cosine)
    deal = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / block))).cast("int")
    vectors = known.join(sizes.select("label", "dim", deal.alias("deal")), ["label", "dim"]).select(
        "label", "dim", "deal", "id", "copies", F.col("v").cast("array<double>").alias("v")
        if known.schema["v"].dataType != T.ArrayType(T.FloatType()) else F.col("v"))
    place = [known.schema[c] for c in ("label", "dim")] + [
        T.StructField("t", T.IntegerType()), T.StructField("prefix", T.LongType())]
    names = ["label", "dim", "t", "prefix"]

    def count(batches):
        for batch in batches:
            for rows, t, prefix, own in visits(batch, coder_of, table_bits, cosine):
                n = len(rows)
                table = pa.table([batch.column("label").take(pa.array(rows)),
                                  batch.column("dim").take(pa.array(rows)), pa.array([t] * n, pa.int32()),
                                  pa.array(prefix), pa.array(own.astype(np.int64)),
                                  pa.array(np.ones(n, np.int64))], [*names, "owners", "all"])
                summed = table.group_by(names).aggregate([("owners", "sum"), ("all", "sum")])
                yield from summed.select([*names, "owners_sum", "all_sum"]).to_batches()

    counted = T.StructType([*place, T.StructField("owners", T.LongType()), T.StructField("all", T.LongType())])
    full = vectors.mapInArrow(count, counted).groupBy(*names).agg(
        F.sum("owners").alias("owners"), F.sum("all").alias("all")).where(
        (F.col("owners") > 2 * block) | (F.col("all") > 8 * block)).select(
        *names, F.ceil(F.col("owners") / block).cast("int").alias("rows"),
        F.ceil(F.col("all") / (4 * block)).cast("int").alias("columns"))

    def dealt(batches):
        for batch in batches:
            for rows, t, prefix, own in visits(batch, coder_of, table_bits, cosine):
                taken = [batch.column(c).take(pa.array(rows)) for c in ("label", "dim")]
                rest = [batch.column(c).take(pa.array(rows)) for c in ("deal", "id", "copies", "v")]
                yield pa.RecordBatch.from_arrays(
                    [*taken, pa.array([t] * len(rows), pa.int32()), pa.array(prefix), pa.array(own), *rest],
                    [*names, "own", "deal", "id", "copies", "v"])

    schema = T.StructType([*place, T.StructField("own", T.BooleanType()), *[
        vectors.schema[c] for c in ("deal", "id", "copies", "v")]])
    put = vectors.mapInArrow(dealt, schema).join(written(full, "full"), names, "left")
    mine = F.pmod(F.xxhash64("id"), F.coalesce("rows", F.lit(1))).cast("int")
    theirs = F.pmod(F.xxhash64("id", F.lit(1)), F.coalesce("columns", F.lit(1))).cast("int")
    across = F.sequence(F.lit(0), F.coalesce("columns", F.lit(1)) - 1)
    down = F.sequence(F.lit(0), F.coalesce("rows", F.lit(1)) - 1)
    cells = F.array_union(
        F.when(F.col("own"), F.transform(across, lambda j: F.struct(mine.alias("i"), j.alias("j")))).otherwise(
            F.array().cast("array<struct<i:int,j:int>>")),
        F.transform(down, lambda i: F.struct(i.alias("i"), theirs.alias("j"))))
    put = put.withColumn("cell", F.explode(cells)).select(
        *names, "deal", "id", "copies", "v", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"),
        (F.col("own") & (F.col("cell.i") == mine)).alias("owner"), (F.col("cell.j") == theirs).alias("visitor"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, t = table["dim"][0].as_py(), table["t"][0].as_py()
        coder = _coder(coder_of, dim, table_bits, cosine)
        id_, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        width = min(table["deal"][0].as_py(), len(coder.tables[t]))
        a, b = matches(coder, _matrix(pa.concat_arrays(table["v"].chunks), dim), t,
                       table["prefix"][0].as_py(), width, table["owner"].to_numpy(),
                       table["visitor"].to_numpy(), id_, cosine)
        # A vector may be here as an owner and as a visitor: one number for both.
        ids, where = np.unique(id_, return_inverse=True)
        a_, b_ = where[a], where[b]
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, a_, copies[b])
        np.add.at(n, b_, copies[a])
        seen = n > 0
        return pa.table({"id": ids[seen], "n": n[seen], "root": ids[roots(len(ids), a_, b_)][seen]})

    return put.groupBy(*names, "i", "j").applyInArrow(run, "id bigint, n bigint, root bigint")


def mark(rows: DataFrame, name: str, cosine: float = COSINE, block: int = BLOCK,
         key: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """All columns and ``name``: n_links, component_id and kept of each row."""
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                        F.col(f"`{key}`").alias("vec_id"), F.col(f"`{column}`").alias("v"),
                        F.col(f"`{label}`").alias("label"))
    able = whole.where(usable("label", "v"))
    known = classes(able.select("vec_id", "v", "label"))
    found = written(links(known, cosine, block), "links")
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    # Of the vectors with links: how many, and the smallest vec_id they are connected with.
    linked = found.groupBy("id").agg(F.sum("n").alias("n")).join(joined, "id", "left").select(
        "id", "n", F.coalesce("component", "id").alias("component"))
    linked = written(linked.join(known.select("id", "vec_id"), "id"), "linked")
    least = linked.groupBy("component").agg(F.min("vec_id").alias("least"))
    about = known.join(linked.join(least, "component").select("id", "n", "least"), "id", "left").select(
        "label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"))
    joined_rows = able.join(about, ["label", "v"]).select("row", "vec_id", "n_links", "component_id")
    alone = whole.where(~usable("label", "v")).select(
        "row", "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined_rows.unionAll(alone).select("row.*", F.struct(
        "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).alias(name))
