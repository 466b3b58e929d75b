import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from estatelens.llm import mixing, neighbours, rules
from tests.llm.cases import SCHEMA, frame, hard_texts, prose, windows_kept
from tests.llm.test_dedup import jaccard_classes
from tests.llm.test_models import plain_counts


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Share, cut what is above its cap, share the excess again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def planned(docs):
    return mixing.plan(docs, "p").select("doc_id", "source", "text", "p.*").collect()


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, None: 5}, {"a": 1000, "b": 3, "c": 5, "\U00010000": 2, "￿": 9},
    {"a": 0, "b": 10}, {None: 7}, {"b": 50, "a": 1, "": 4}])
def test_targets_and_taken_words(spark, sizes):
    rows, doc = [], 0
    for source, size in sizes.items():
        cut = [size // 2, size // 3]
        for n in [*cut, size - sum(cut)]:
            rows.append((doc, prose(doc, n), source))
            doc += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = planned(docs)
    want = plain_targets(sizes)
    for source in sizes:
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert np.allclose([r.target for r in own], want[source])
        assert abs(sum(r.taken for r in own) - want[source]) <= 0.5 + 1e-6
        assert all(r.taken <= 3 * r.size for r in own)
        epochs = int(want[source] + 0.5) // max(sizes[source], 1)
        assert all(epochs * r.size <= r.taken <= (epochs + 1) * r.size for r in own)
    assert sorted(got) == sorted(planned(docs.repartition(3)))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert taken == {r.doc_id: r.taken for r in got if r.taken}


def test_hard_rows(spark):
    docs = frame(spark, hard_texts())
    rows = planned(docs)
    assert len(rows) == len(hard_texts())
    assert {r.size for r in rows if not (r.text or "").strip(" \t\n\v\f\r")} == {0}
    assert mixing.mix(docs).columns == docs.columns
    assert sum(len(r.text.encode().split()) for r in mixing.mix(docs).collect()) == sum(r.taken for r in rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert planned(empty) == [] and mixing.mix(empty).collect() == []


def test_better_texts_come_earlier(spark):
    """Two equal halves, one of symbols: the clean half is drawn more often."""
    rows = [(i, "word " * 10 if i % 2 else "#$% " * 10, "a") for i in range(400)]
    rows += [(1000 + i, "word " * 40, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = [r for r in planned(docs) if r.source == "a"]
    clean, symbols = (sum(r.taken for r in got if r.doc_id % 2 == k) for k in (1, 0))
    assert clean > 2 * symbols > 0


def test_first_words():
    assert mixing.first_words("  a\nbé c", 2) == "  a\nbé"
    assert mixing.first_words("a b", 2) == "a b"


# ------------------------------------------------------------------------------ neighbours
def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def exact(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = min(usable.get(i, v), v)
    out = set()
    for q in (i for i in usable if i % 20 == 0):
        a = np.array(usable[q], np.float32).astype(float)
        scored = sorted((-float(a @ np.array(v, np.float32).astype(float)), i)
                        for i, v in usable.items() if i != q and len(v) == len(a))
        out |= {(q, r, i, round(-s, 9)) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def found(df):
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect()}


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=3).round(1).tolist()) for i in rng.permutation(90)]
    rows += [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]),
             (180, [float("nan"), 1.0, 1.0]), (200, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]),
             (220, [1.0, 2.0]), (221, [2.0, 1.0]), (223, [2.0, 1.0]), (20, [9.0, 9.0, 9.0]), rows[0]]
    table = vectors(spark, rows)
    got = neighbours.nearest(table, table.where("vec_id % 20 = 0"))
    assert found(got) == exact(rows, 20)
    few = neighbours.nearest(table, table.where("vec_id % 20 = 0"), block=16, chunk=2)
    assert found(few) == exact(rows, 20)
    empty = vectors(spark, [])
    assert neighbours.nearest(empty, empty).collect() == []


def test_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 24)) * rng.uniform(0.2, 2, (6000, 1))       # lengths differ
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = vectors(spark, rows)
    got = found(neighbours.nearest(table, table.where("vec_id % 20 = 0"), block=3000))
    x = x.astype(np.float32).astype(float)
    score = x[::20] @ x.T
    score[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    want = {(20 * q, int(i)) for q, row in enumerate(score) for i in np.argsort(-row)[:20]}
    assert len({(q, i) for q, _, i, _ in got} & want) >= 0.95 * len(want)
    assert all(abs(s - x[q] @ x[i]) < 1e-9 for q, _, i, s in got)


def test_equal_vectors_come_by_vec_id(spark):
    """Hundreds of equal vectors among others: ties never hang on how many rows are scored at once."""
    rng = np.random.default_rng(3)
    same, few = rng.normal(size=24), rng.normal(size=24)
    rows = [(i, [float(c) for c in (same if i % 3 else few if i % 2 else rng.normal(size=24))]) for i in range(900)]
    got = {}
    df = vectors(spark, rows)
    for r in sorted(neighbours.nearest(df, df.where("vec_id % 20 = 0")).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for found in got.values():
        assert len(found) == 20
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for (a, s), (b, t) in zip(found, found[1:]):
            if rows[a][1] == rows[b][1]:
                assert s == t and a < b
    x = np.array([v for _, v in rows])
    index = neighbours.Index(x, np.arange(900), float(np.linalg.norm(x, axis=1).max()), 20)
    for q in range(0, 900, 20):
        _, ids, score = index.search(x[q:q + 1], np.array([q]), 20)
        assert [*zip(ids, score)] == sorted(zip(ids, score), key=lambda p: (-p[1], p[0]))


@pytest.mark.parametrize("size", [1e-200, 1e-160, 1.0, 1e150])
def test_vectors_of_any_size_take_part(spark, size):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) * size for c in rng.normal(size=6)]) for i in range(60)] + [(60, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0")).collect()
    assert {(r.query_id, r.rank) for r in got} == {(q, k) for q in (0, 20, 40) for k in range(1, 21)}
    if size > 1e-100:
        for r in got:
            if r.rank == 1:
                others = [(-float((np.array(v) * np.array(rows[r.query_id][1])).sum()), i) for i, v in rows[:60] if i != r.query_id]
                assert min(others)[1] == r.vec_id


# ------------------------------------------------------------------------------ pipeline
HELPERS = ["_place", "_part", "_amounts", "_inside", "_before", "_mix", "_mix_source", "_work", "_size", "_up_to",
           "_plan", "_tie", "_spans", "_shared_id", "_shared_tie", "_stats", "_verdict", "tie", "row", "size"]


@pytest.mark.parametrize("case", ["empty", "nulls", "hard", "clashing"])
def test_stages_take_hard_tables(spark, case, tmp_path):
    """Empty tables, rows of nulls, hard texts and clashing columns pass every stage."""
    home = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{home}/documents.parquet")
    texts = {"empty": [], "nulls": [(None, None)] * 3 + [(1, None)] * 2, "hard": hard_texts(),
             "clashing": hard_texts()}[case]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], real.schema)
    if case == "hard":
        docs = docs.unionAll(real.limit(40))
    for name in HELPERS if case == "clashing" else ():
        docs = docs.withColumn(name, F.lit(name))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, home)
        if name == "best_fit_packing":
            assert out.count() >= 0
            break
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if case == "clashing":
            assert all(r[h] == h for r in docs.collect() for h in HELPERS)
            docs = before if docs.isEmpty() else docs


def test_every_stage_against_plain_versions(spark, tmp_path):
    """Each stage on all its predecessor kept, written and read again in between."""
    home = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{home}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "substring_dedup", "source_mixing", "best_fit_packing"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], home).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    assert all(t.columns == columns for t in tables[:-1])
    first, good, alone, cut, mixed, packed = (t.collect() for t in tables)

    labels = spark.read.parquet(f"{home}/labels.parquet")
    learned = rules.learn(docs, labels)
    verdict = {r.doc_id: r.v for r in rules.judge(docs, learned, "v").collect()}
    for row in first:
        counts = plain_counts(row.text)
        assert tuple(verdict[row.doc_id])[:5] == counts
        assert verdict[row.doc_id].base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
    assert {r.doc_id for r in good} == {d for d, v in verdict.items() if v.kept}
    before = {r.doc_id: r for r in first}
    assert all(r == before[r.doc_id] for r in good)

    classes = jaccard_classes([(r.doc_id, r.text) for r in good])
    assert sorted(r.doc_id for r in alone) == sorted({c for _, c in classes})

    want = {d: (n, gone, sha) for d, n, gone, _, sha in windows_kept(
        [(r.doc_id, r.text) for r in alone], 50, True)}
    texts = {r.doc_id: r.text for r in cut}
    assert set(texts) == {d for d, (n, gone, _) in want.items() if gone == 0 or gone < n}
    for doc, text in texts.items():
        plain = b" ".join(text.encode().split())
        assert hashlib.sha256(plain).hexdigest() == want[doc][2]
        assert text == before[doc].text or want[doc][1]
    assert all(r.n_chars == len(r.text) for r in cut)

    sizes = {}
    for r in cut:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.encode().split())
    target = plain_targets(sizes)
    for source in sizes:
        taken = sum(len(r.text.encode().split()) for r in mixed if r.source == source)
        assert abs(taken - target[source]) <= 0.5 + 1e-6
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in mixed)

    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(r.doc_id for r in mixed)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0
