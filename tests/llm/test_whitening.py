import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k=8):
    """What the rows should be, by a dense solver. (vec_id, component) -> values."""
    used = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in used])
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for (i, _), row, c in zip(used, x.tolist(), centred):
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(row, s))
        for j in range(len(e)):
            out[i, j + 1] = (n, deviation, c @ u[:, j] / math.sqrt(e[j]), e[j] / np.trace(v))
    return out


def same(found, expected):
    got = {(r.vec_id, r.component): r for r in found}
    assert got.keys() == expected.keys()
    signs = {}
    for key, (n, deviation, whitened, explained) in sorted(expected.items()):
        r = got[key]
        sign = signs.setdefault(key[1], 1.0 if r.whitened * whitened > 0 else -1.0)
        assert (r.n, r.deviation, int(r.deviation_exact)) == (n, deviation, deviation)
        assert r.whitened == pytest.approx(sign * whitened, abs=1e-8)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9


def vectors(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(c)) for c in row] for row in rng.normal(size=(n, dim)) * np.linspace(1, 2, dim) * scale]


def test_against_a_dense_solver(spark):
    rows = list(enumerate(vectors(300, 12, 1)))
    rows += [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12)]
    rows += [(2000 + i, rows[0][1]) for i in range(40)]      # copies count
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    same(whitening.components(df).collect(), plain(rows))


def test_the_query_reads_the_whole_table(spark, tmp_path):
    rows = list(enumerate(vectors(200, 9, 2)))
    spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path))
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(found.collect(), plain(rows))


def test_large_entries_stay_exact(spark):
    """Products beyond 2^53, deviations beyond a long."""
    rows = list(enumerate(vectors(50, 3, 3, scale=1e9)))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    expected = plain(rows)
    for r in whitening.components(df).collect():
        n, deviation, whitened, explained = expected[r.vec_id, r.component]
        assert int(r.deviation_exact) == deviation and r.deviation is None
        assert abs(r.whitened) == pytest.approx(abs(whitened), abs=1e-8)


def test_degenerate_tables(spark):
    assert whitening.components(spark.createDataFrame([], SCHEMA)).collect() == []
    one = whitening.components(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert {(r.vec_id, r.component, r.deviation, r.whitened, r.explained) for r in one} == {
        (i, c, 0, None, None) for i in (1, 2) for c in (1, 2)}
    flat = [(i, [float(i % 5), 2.0 * (i % 5), 1.0], 0) for i in range(20)] + [(99, [], 0), (None, [1.0, 2.0, 1.0], 0)]
    got = whitening.components(spark.createDataFrame(flat, SCHEMA)).collect()
    assert len(got) == 21 * 3
    first = [r for r in got if r.component == 1]
    assert all(r.whitened is not None and r.explained == pytest.approx(1.0) for r in first)
    assert all(r.whitened is None and r.explained == 0 for r in got if r.component > 1)


def test_lengths_are_fitted_apart_and_columns_kept(spark):
    a, b = vectors(40, 4, 4), vectors(30, 2, 5)
    rows = [(i, v) for i, v in enumerate(a)] + [(100 + i, v) for i, v in enumerate(b)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], SCHEMA).withColumn("found", F.lit("kept")).withColumn("dim", F.lit(1))
    expected = {**plain(rows[:40]), **plain(rows[40:])}
    same(whitening.components(df).collect(), expected)
    whitened = whitening.whiten(df, whitening.fit(df), "w")
    assert whitened.columns == [*df.columns, "w"]
    assert {r.found for r in whitened.collect()} == {"kept"}


@pytest.mark.parametrize("d", [1, 2, 7, 8, 9, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "few", "steps", "close"])
def test_leading_components_are_complete(d, kind):
    rng = np.random.default_rng(d)
    v = {"random": lambda: np.cov(rng.normal(size=(d, 400))).reshape(d, d), "equal": lambda: 3 * np.eye(d),
         "few": lambda: (lambda a: a.T @ a)(rng.normal(size=(2, d))),
         "steps": lambda: np.diag(np.repeat([5.0, 1.0], [min(3, d), max(0, d - 3)])),
         "close": lambda: np.diag(1 + 1e-7 * np.arange(d))}[kind]()
    e, x = whitening.leading(v, 8)
    full = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.allclose(e, full, rtol=1e-12, atol=1e-12 * full[0])
    seen = e > 0
    assert np.allclose(x[:, seen].T @ x[:, seen], np.eye(seen.sum()), atol=1e-12)
    assert np.allclose(v @ x, x * e, atol=1e-12 * full[0])


def test_inertia_counts_eigenvalues_above():
    a = np.random.default_rng(3).normal(size=(15, 15))
    v = a @ a.T
    inertia = whitening.Inertia(v)
    for at in (0.0, 1.0, 7.3, 30.0):
        assert inertia.above(at) == (np.linalg.eigvalsh(v) > at).sum()
