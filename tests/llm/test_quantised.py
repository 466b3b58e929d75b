import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import quantised, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """One (vec_id, n_links, component_id, kept) per row, by comparing all rows."""
    n = len(rows)
    able = [l is not None and bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
            for _, v, l in rows]
    unit = [np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() if ok else None
            for (_, v, _), ok in zip(rows, able)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    linked = [[j for j in range(n) if j != i and able[i] and able[j] and rows[i][2] == rows[j][2]
               and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(linked[i]), component, rows[i][0] == component))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "m.n_links", "m.component_id", "m.kept").collect()), key=str)


def clouds(seed, n, dim, spread):
    """Vectors around a few centres, at cosines on both sides of the threshold, and loose ones."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=dim) * rng.choice(spread) if i % 3 else rng.normal(size=dim)
        out.append((i, [float(c) for c in np.float32(v)], int(rng.integers(0, 2))))
    return out


@pytest.mark.parametrize("dim, block", [(64, 4096), (64, 16), (16, 8), (3, 8), (1, 4), (80, 16)])
def test_against_all_pairs(spark, dim, block):
    rows = clouds(dim, 260, dim, [0.02, 0.1, 0.14, 0.16])
    rows += [(1000 + i, rows[1][1], rows[1][2]) for i in range(30)]             # copies
    rows += [(1100 + i, [2 * c for c in rows[4][1]], rows[4][2]) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(quantised.mark(df, "m", block=block)) == plain(rows)


def test_hard_rows(spark):
    one, far = [1.0, 2.0, 3.0], [3.0, -2.0, 0.0]
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0] * 3, 1),
            (7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 1.0], 1),
            (None, one, 1), (None, far, 2), (None, far, 2), (None, None, None), (10, [1e-38 * c for c in one], 1),
            (11, [1e37 * c for c in one], 1), (12, [1.0, 2.0], 1), (13, [1.0, 2.0, 3.05], 1), (1, far, 1),
            (14, [-c for c in one], 1), (15, one, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(quantised.mark(df, "m")) == plain(rows)
    assert quantised.mark(spark.createDataFrame([], SCHEMA), "m").collect() == []


def test_columns_are_kept(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1)], SCHEMA)
    for extra in ("row", "v", "id", "copies", "dim", "n", "root", "least", "n_links", "cell"):
        df = df.withColumn(extra, F.lit(extra))
    marked = quantised.mark(df, "m")
    assert marked.columns == [*df.columns, "m"] and marked.first().cell == "cell"


def test_a_dense_group_gives_rows_by_vector(spark):
    """900 different vectors, all near: cells return rows for vectors, not for pairs."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    rows = [(i, [float(c) for c in centre + 0.03 * rng.normal(size=64)], 1) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<float>, label int")
    found = quantised.links(quantised.classes(df), block=256).collect()
    assert len(found) < 60 * 900
    assert {r.root for r in found} <= {r.id for r in found}
    assert sum(r.n for r in found) == 900 * 899


def test_values_do_not_depend_on_company():
    rng = np.random.default_rng(2)
    x = quantised.unit(rng.normal(size=(500, 64)))
    coder = quantised.Coder(*quantised.learn(x), 10, 0.98)
    whole = coder.rotate(x)
    assert all((coder.rotate(x[i:i + k]) == whole[i:i + k]).all() for i, k in ((0, 1), (3, 7), (499, 1)))


def test_learned_signs_are_balanced_and_fit_better_than_a_random_turn():
    rng = np.random.default_rng(3)
    x = quantised.unit(rng.normal(size=(2000, 16)) * np.linspace(0.2, 3, 16))
    mean, turn = quantised.learn(x)
    z = (x - mean) @ turn
    assert np.allclose(turn.T @ turn, np.eye(16), atol=1e-10)
    assert (np.abs((z > 0).mean(axis=0) - 0.5) < 0.1).all()
    random = (x - mean) @ np.linalg.qr(rng.normal(size=(16, 16)))[0]
    loss = lambda y: ((np.sign(y) - y) ** 2).sum()
    assert loss(z) < loss(random)


def test_query(spark, tmp_path):
    rows = clouds(9, 200, 64, [0.05, 0.14])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op12_embedding_near_dedup"](spark, str(tmp_path))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
