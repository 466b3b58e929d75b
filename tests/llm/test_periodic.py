import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from estatelens.llm import periodic, queries
from tests.llm.cases import SCHEMA, frame, hard_texts, prose


def plain_runs(w):
    """Every maximal stretch of smallest period q and length >= max(24, 3 q), by trying all."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q):
                stretch = w[i:i + length]
                if all(any(stretch[t] != stretch[t + s] for t in range(length - s)) for s in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_loop(doc, w):
    h = zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_row(doc, text, loop=True):
    w = [x.decode() for x in (text or "").encode().split()]
    w = plain_loop(doc, w) if loop else w
    runs = plain_runs(w)
    dead = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dead)))


def looping(seed, count):
    """Documents with loops of many periods, nested, cut, next to each other and at the ends."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += prose(rng.random(), rng.randint(0, 30)).split()
            base = [rng.choice("abcd") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 40]))]
            if rng.random() < 0.3:          # a loop within the period
                base = base[:3] * 9 + base
            w += (base * 12)[:rng.randint(1, max(24, 4 * len(base)))]
        out.append((i, " ".join(w)))
    return out


def test_query_against_brute_force(spark, tmp_path):
    texts = hard_texts() + [(100 + i, t) for i, t in looping(1, 120)]
    frame(spark, texts).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert found.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                 "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r)[:8] for r in found.collect()), key=str)
    assert got == sorted((plain_row(d, t) for d, t in texts), key=str)
    assert sum(r[1] for r in got) > 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=12).flatmap(
    lambda b: st.integers(1, 60).map(lambda n: (b * 60)[:n])), max_size=5))
def test_runs_of_small_alphabets(parts):
    w = [x for p in parts for x in p]
    codes = np.array([7, 7, *w, 7], np.int64)           # neighbours belong to other documents
    offsets = np.array([0, 2, 2 + len(w), 3 + len(w)])
    assert periodic.find(codes, offsets).get(1, []) == plain_runs(w)


def test_a_very_long_loop_is_one_extension():
    base = np.random.default_rng(1).integers(0, 1 << 30, 70_001)
    codes = np.concatenate([base, base, base, base[:5]])
    assert periodic.find(codes, np.array([0, len(codes)])) == {0: [(0, len(codes), 70_001)]}
    same = np.zeros(1_000_000, np.int64)
    assert periodic.find(same, np.array([0, len(same)])) == {0: [(0, len(same), 1)]}


def test_collapse_changes_only_looping_texts(spark):
    loop = "start " + "a b c " * 20 + "end"
    docs = frame(spark, [(1, loop), (2, " two  spaces\n"), (3, None), (4, "")]).withColumnRenamed("stats", "found")
    got = periodic.collapse(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {
        1: "start a b c end", 2: " two  spaces\n", 3: None, 4: ""}


def test_empty_table_and_kept_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.mark(empty, "x").collect() == [] and periodic.looped(empty).collect() == []
    one = frame(spark, [(1, "a b")])
    assert periodic.mark(one, "x").columns == [*one.columns, "x"]


@pytest.mark.parametrize("n", [1, 2, 50, 333])
def test_looped_words(n):
    w = [str(i) for i in range(n)]
    for doc in range(200):
        places = periodic.looped_words(doc, n)
        assert ([w[i] for i in places] if places is not None else w) == plain_loop(doc, w)
