import random
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelens.llm import components, neardup, shared, substring, suffixes
from tests.llm.cases import SCHEMA, VOCABULARY, frame, hard_texts, prose, windows_kept


def marked(module, docs, search):
    rows = module.mark(docs, "marked", search).select(
        "doc_id", "marked.n_items", "marked.n_removed", "marked.n_spans",
        F.sha2("marked.kept", 256).alias("sha")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def spliced(seed, n_docs):
    """Documents made of shared passages with edits and own words; ids not in order."""
    rng = random.Random(seed)
    passages = [prose(100 + i, rng.randint(30, 90)).split() for i in range(6)]
    texts = []
    for i in rng.sample(range(1000), n_docs):
        out = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(passages))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = rng.choice(VOCABULARY)
            a = rng.randrange(10)
            out += part[a:] + [rng.choice(VOCABULARY) for _ in range(rng.randint(0, 20))]
        texts.append((i, rng.choice((" ", "\n")).join(out)))
    return texts


@pytest.mark.parametrize("hot", [20_000, 2])
@pytest.mark.parametrize("module", [substring, suffixes])
def test_windows_against_brute_force(spark, module, hot):
    texts = hard_texts() + spliced(5, 60)
    search = replace(module.SEARCH, hot_segments=hot, block_segments=50)
    docs = frame(spark, texts)
    assert marked(module, docs, search) == windows_kept(texts, 50, module is substring)


@pytest.mark.parametrize("module", [substring, suffixes])
def test_empty_table_and_kept_columns(spark, module):
    assert module.mark(spark.createDataFrame([], SCHEMA), "x").collect() == []
    one = frame(spark, [(1, "a b")])
    assert module.mark(one, "x").columns == [*one.columns, "x"]


def test_remove_drops_texts_that_lose_everything(spark):
    passage = prose(1, 60)
    docs = frame(spark, [(1, passage), (2, passage), (3, "own  words " + passage), (4, None), (5, "")])
    got = {r.doc_id: r.text for r in substring.remove(docs).collect()}
    assert got == {1: passage, 3: "own words", 4: None, 5: ""}


def test_column_wise_order_is_the_suffix_order():
    rng = random.Random(1)
    strings = [bytes(rng.choices(b"ab\xffc", k=rng.randint(0, 12))) for _ in range(40)]
    transform, owner, length = suffixes.column_wise(strings)
    suffix = [strings[o][len(strings[o]) - n:] for o, n in zip(owner.tolist(), length.tolist())]
    assert len(suffix) == sum(len(s) + 1 for s in strings) and suffix == sorted(suffix)
    used = sorted(set(b"".join(strings)))
    for symbol, o, n in zip(transform.tolist(), owner.tolist(), length.tolist()):
        s = strings[o]
        assert symbol == (0 if n == len(s) else used.index(s[len(s) - n - 1]) + 1)


# ------------------------------------------------------------------------------ near copies
def jaccard_classes(texts):
    sets = {}
    for doc, text in texts:
        w = (text or "").split()
        if doc is not None and w:
            own = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or Counter([tuple(w)])
            sets.setdefault(doc, []).append((own, len(w) < 5))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            for s, short_s in sets[a]:
                for t, short_t in sets[b]:
                    if (s == t) if short_s or short_t else (s & t).total() >= 0.8 * (s | t).total():
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return sorted(((d, None if d is None else find(d) if d in root else d) for d, _ in texts), key=str)


def copies(seed, n_groups):
    """Chains of near copies: some are alike only through others."""
    rng = random.Random(seed)
    texts, doc = [], 100
    for g in range(n_groups):
        base = prose(200 + g, 120).split()
        for _ in range(rng.randint(1, 8)):
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(VOCABULARY)
            texts.append((doc, " ".join(base)))
            doc += 1
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("cell", [512, 2])
def test_classes_against_all_pairs(spark, cell):
    texts = hard_texts() + copies(7, 12)
    got = neardup.classes(frame(spark, texts), cell=cell).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == jaccard_classes(texts)


@pytest.mark.parametrize("cell", [512, 2])
def test_counts_of_shingles_decide(spark, cell):
    """Sets of shingles alone would link 1 with 2 and 3, and would part 4 from 5."""
    base, other = prose(31, 100), prose(32, 60)
    texts = [(1, base), (2, base + " " + base), (3, " ".join([base] * 40)),
             (4, "a b " * 300), (5, "a b " * 300 + "c"), (6, "a b " * 150),
             (7, " ".join([other] * 10)), (8, " ".join([other] * 9)), (9, " ".join([other] * 6))]
    texts += copies(8, 4)
    got = {r.doc_id: r.class_id for r in neardup.classes(frame(spark, texts), cell=cell).collect()}
    assert {d: got[d] for d in range(1, 10)} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9}
    assert sorted(got.items(), key=str) == jaccard_classes(texts)


def test_numbered_occurrences_overlap_by_lesser_counts():
    rng = np.random.default_rng(3)
    names = rng.integers(0, 2 ** 63, 20, dtype=np.uint64)
    doc = np.sort(rng.integers(0, 2, 500))
    pick = rng.integers(0, 20, 500)
    owner, key = neardup.numbered(doc, names[pick])
    one, two = (set(key[owner == d].tolist()) for d in (0, 1))
    a, b = (Counter(pick[doc == d].tolist()) for d in (0, 1))
    assert len(one) == a.total() and len(two) == b.total() and len(one & two) == (a & b).total()
    assert set(names[pick[doc == 0]].tolist()) <= one            # first occurrences keep the hash


def test_keep_one(spark):
    texts = hard_texts()
    classes = dict(jaccard_classes(texts))
    kept = neardup.keep_one(frame(spark, texts))
    assert kept.columns == frame(spark, texts).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    want = [d for d in classes if d is not None and classes[d] == d] + [None, None]
    assert ids == sorted(want, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup.classes(empty).collect() == [] and neardup.keep_one(empty).collect() == []


def test_darts_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    names = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    a, b = rng.integers(1, 9, 200), rng.integers(1, 9, 200)         # on names 0-199 and 100-299
    element = np.concatenate([names[:200], names[100:]])
    doc = np.repeat([0, 1], 200)
    k = 4000
    sign = neardup.signatures(element, doc, 2, k, np.concatenate([a, b]).astype(float))
    full = np.zeros((2, 300))
    full[0, :200], full[1, 100:] = a, b
    want = np.minimum(*full).sum() / np.maximum(*full).sum()
    assert abs((sign[0] == sign[1]).mean() - want) < 4 * (want / k) ** 0.5
    plain = neardup.signatures(element, doc, 2, k)
    assert abs((plain[0] == plain[1]).mean() - 1 / 3) < 4 * (1 / 3 / k) ** 0.5


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 60), (60, 60), (70, 71), (71, 70)]
    got = {r.id: r.component for r in components.components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, 50: 40, 60: 40, 71: 70}


def test_segments_that_nobody_shares_are_not_cut(spark):
    """A filter holds every key and few others; segments are looked up before they leave Python."""
    keys = spark.range(0, 200_000, 2).selectExpr("xxhash64(id) as m")
    log, bits = shared._filter(keys, keys.count())
    known = np.frombuffer(bits, np.uint64)
    every = np.array([r.m for r in spark.range(200_000).selectExpr("xxhash64(id) as m").collect()], np.int64)
    at, mask = shared._bits(every, log)
    through = known[at] & mask == mask
    assert through[::2].all() and through[1::2].mean() < 0.02
    docs = spark.createDataFrame([(i, "".join(chr(97 + (i * 7919 + k * k * (i + 3)) % 26) for k in range(400)), i)
                                  for i in range(20)], "doc_id long, text string, tie long")
    none = shared._filter(keys.limit(0), 0)
    assert shared._segments(docs, suffixes.SEARCH).count() > 0
    assert shared._segments(docs, suffixes.SEARCH, spark.sparkContext.broadcast(none)).count() == 0
