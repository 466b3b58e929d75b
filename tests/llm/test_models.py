import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estatelens.llm import langid, rules, toxicity
from tests.llm.cases import SCHEMA, frame, hard_texts, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------------ quality rules
def plain_counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    starts = {}
    for i in range(len(w) - 7):
        starts.setdefault(tuple(w[i:i + 8]), []).append(i)
    again = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def test_counts_against_plain_python(spark):
    texts = hard_texts() + [(50, "a b\n a b\na b\n\n\x0b\na b"), (51, "# * é|é <>\n" * 9)]
    got = rules.with_counts(frame(spark, texts), "x").select(
        "doc_id", *[f"x.{c}" for c in rules.COUNTS[:5]]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, *plain_counts(t))) for d, t in texts)


def junk(seed):
    return " ".join(f"{w}***" for w in prose(seed, 60).split())


def labelled(spark):
    texts = [(i, junk(i) if i % 4 == 0 else prose(i, 60)) for i in range(400)]
    labels = [(i, int(i % 4 != 0)) for i in range(400)] + [(7, None), (None, 0), (9999, 0)]
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_rules_find_junk_and_leave_the_rest(spark):
    docs, labels = labelled(spark)
    learned = rules.learn(docs, labels)
    assert learned
    new = frame(spark, [(1, junk(1001)), (2, prose(1002, 60)), (3, "too short"), (4, None),
                        (5, "again and again " * 40), (None, prose(1003, 60))])
    got = {r.doc_id: r.x for r in rules.judge(new, learned, "x").collect()}
    assert {d: x.kept for d, x in got.items()} == {1: False, 2: True, 3: False, 4: False, 5: False,
                                                   None: True}
    assert got[1].rule == 1 and not got[1].base_failed and got[5].base_failed
    kept = rules.keep_good(new, learned)
    assert kept.columns == new.columns and kept.count() == 2


def test_the_list_is_an_ordered_expression():
    table = pd.DataFrame({c: np.zeros(300) for c in rules.COUNTS})
    table["n_words"] = 100
    table["n_symbols"] = np.where(np.arange(300) < 100, 50 + np.arange(300) % 7, np.arange(300) % 5)
    learned = rules.cover(table, np.arange(300) < 100)
    assert learned == [(rules.Condition("symbols_per_word", True, learned[0][0].threshold),)]
    assert 0.04 < learned[0][0].threshold <= 0.5


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs, labels = labelled(spark)
    assert rules.learn(docs, none) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert rules.learn(empty, labels) == [] and rules.judge(empty, [], "x").collect() == []


# ------------------------------------------------------------------------------ languages
def tongues(spark, n=240):
    syllables = {"aa": ("ba", "bo", "bi", "lu", "la"), "bb": ("ke", "ko", "tu", "te", "to")}
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        text = " ".join("".join(rng.choice(syllables[lang], rng.integers(1, 4))) for _ in range(40))
        rows.append((i, text, lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !", "aa"), (None, rows[0][1], None),
             (0, rows[0][1], "aa")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_of_held_out_rows(spark):
    docs = tongues(spark)
    samples = langid.learn(docs)
    assert set(samples) == {"aa", "bb"}
    rows = langid.identify(docs, samples, "x").withColumn(
        "held", langid.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held and r.doc_id < 1000]
    assert len(held) > 30 and all(r.x.lang_pred == r.lang for r in held)
    assert all(r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
               for r in rows)
    assert all(0 <= r.x.score <= 1 for r in rows)
    assert {r.doc_id: r.x.lang_pred for r in rows if (r.doc_id or 0) >= 1000} == {
        1000: "und", 1001: "und", 1002: "und"}
    assert [r.x.lang_pred for r in rows if r.doc_id is None] == ["aa"]


def test_learning_does_not_see_held_out_rows(spark):
    docs = tongues(spark)
    changed = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    assert langid.learn(changed) == langid.learn(docs)


def test_excerpts_skip_copies_and_headers_and_fill_the_budget(spark):
    header = "common header " * 40
    rows = [(i, header + f"{prose(i, 300)}", "aa") for i in range(300)]
    rows += [(1000 + i, "copied text", "aa") for i in range(500)]
    rows += [(2000 + i, prose(i, 10), "bb") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples = langid.learn(docs, sample_docs=50, sample_chars=10_000)
    long, short = samples["aa"], samples["bb"]
    assert sum(map(len, long)) == 10_000 and len(long) in (50, 51)
    assert long.count("copied text") <= 1
    assert sum("header" in t for t in long) < 30              # most of a text is no header
    texts = dict((i, t) for i, t, _ in rows)
    assert all(any(t in own for own in texts.values()) for t in long[:5])
    assert len(short) > 200 and len(set(short)) == len(short)  # texts of some 30 characters: 50 would not fill it
    assert samples == langid.learn(docs.orderBy(F.desc("doc_id")), sample_docs=50, sample_chars=10_000)


def test_phrases_are_longest_matches():
    samples = {"a": ["abcabd", "xyz"], "b": ["qqq"]}
    parser = langid.Parser(samples)
    texts = ["abdxyzabc", "q" * 7, "caba", "xyab?"]

    def plain(text, sample):
        n, i = 0, 0
        while i < len(text):
            k = 1
            while i + k < len(text) and any(text[i:i + k + 1] in s for s in sample):
                k += 1
            n, i = n + 1, i + k
        return n

    points = [langid._points(t) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in points])])
    got = parser.phrases(parser.code[np.concatenate(points)], offsets)
    assert got.tolist() == [[plain(t, samples[k]) for k in "ab"] for t in texts]


def test_nothing_labelled_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.learn(empty) == {} and langid.identify(empty, {}, "x").collect() == []
    [row] = langid.identify(frame(spark, [(1, "abc")]), {}, "x").collect()
    assert tuple(row.x) == ("und", 0.0)


def script(seed, first, letters, n=200):
    """Words of one to four letters of an alphabet that begins at a code point, some more frequent."""
    rng = np.random.default_rng(seed)
    share = np.arange(1, letters + 1) ** -0.5
    word = lambda: "".join(chr(first + c) for c in rng.choice(letters, rng.integers(1, 5), p=share / share.sum()))
    return " ".join(word() for _ in range(n))


SCRIPTS = {"el": (0x3b1, 24), "en": (0x61, 26), "hi": (0x905, 50), "ja": (0x3041, 80),
           "ko": (0xac00, 1500), "ru": (0x430, 32), "zh": (0x4e00, 3000)}


def test_languages_in_many_scripts(spark):
    rows = [(1000 * k + i, script(1000 * k + i, *SCRIPTS[lang]), lang)
            for k, lang in enumerate(SCRIPTS) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    samples = langid.learn(docs)
    assert len(set("".join(t for k in ("ko", "zh") for t in samples[k]))) > 2000
    got = langid.identify(docs, samples, "x").where(langid.held_out(F.col("doc_id"))).collect()
    assert {r.lang for r in got} == set(SCRIPTS) and all(r.x.lang_pred == r.lang for r in got)


def test_phrases_over_a_large_alphabet():
    sample = [script(i, 0x4e00, 3000) for i in range(20)]
    parser = langid.Parser({"en": [script(1, 0x61, 26)], "zh": sample})
    text = script(99, 0x4e00, 3000, 60)
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and any(text[i:i + k + 1] in s for s in sample):
            k += 1
        n, i = n + 1, i + k
    points = langid._points(text)
    assert len(points) <= langid.SEGMENT
    assert parser.phrases(parser.code[points], np.array([0, len(points)]))[0, 1] == n


def test_a_rare_tiny_language_takes_no_others(spark):
    rows = [(1000 * k + i, script(1000 * k + i, *SCRIPTS[lang]), lang)
            for k, lang in enumerate(("en", "ru", "zh")) for i in range(40)]
    tiny = [(5000 + i, text, f"t{i}") for i, text in enumerate(["a", " ", "\u4e00 ", "ab \u0430"] * 2)]
    docs = spark.createDataFrame([*rows, *tiny], "doc_id bigint, text string, lang string")
    samples = langid.learn(docs)
    assert sum(k[0] == "t" for k in samples) >= 4
    got = langid.identify(docs, samples, "x").where(
        (F.col("doc_id") < 5000) & langid.held_out(F.col("doc_id"))).collect()
    assert len(got) > 20 and all(r.x.lang_pred == r.lang for r in got)


def test_a_language_with_one_short_row_is_found():
    latin = {k: [script(100 * n + i, 0x61 + 2 * n, 12, 60) for i in range(50)] for n, k in enumerate(("aa", "bb"))}
    parser = langid.Parser({**latin, "cc": [script(900, 0x69, 12, 60)], "dd": ["a"]})
    texts = [script(1000 + i, 0x69, 12, 80) for i in range(20)]
    assert parser.predict(pa.array(texts))[0] == ["cc"] * 20


# ------------------------------------------------------------------------------ toxicity
def crowd(spark, n=600):
    """Toxic: an insult, or a group together with a threat (each alone is harmless)."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        w = prose(i, 40).split()
        kind = i % 6
        w += {0: ["Idiot!"], 1: ["group", "threat"], 2: ["group"], 3: ["threat"]}.get(kind, [])
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(kind < 2)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "idiot"), (9000, None), (9001, "")],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, 1), (3, None), (4, 0)],
                                   "doc_id bigint, toxic int")
    return docs, labels, {i: t for i, _, t in rows}


def test_pairs_of_terms_are_learned(spark):
    docs, labels, truth = crowd(spark)
    machine = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, machine, "x").withColumn(
        "held", toxicity.held_out(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held and r.doc_id in truth]
    assert len(held) > 100
    assert sum((r.x >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in held) >= 0.98 * len(held)
    empties = {r.x for r in rows if r.doc_id in (9000, 9001)}
    assert len(empties) == 1 and empties.pop() < toxicity.THRESHOLD
    assert [r.x for r in rows if r.doc_id is None][0] > toxicity.THRESHOLD


def test_pairs_of_balanced_terms_are_learned(spark):
    """Every term is as common in toxic texts as in others; only pairs tell."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(800):
        a, b = i % 2, i // 2 % 2
        w = [*prose(i, 40).split(), ("red", "blue")[a], ("cat", "dog")[b]]
        rng.shuffle(w)
        rows.append((i, " ".join(w), int(a == b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, toxic int")
    got = toxicity.score(docs, toxicity.learn(docs, labels), "x").where(
        toxicity.held_out(F.col("doc_id"))).collect()
    truth = {i: t for i, _, t in rows}
    assert len(got) > 150
    assert sum((r.x >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in got) >= 0.98 * len(got)


def test_learning_does_not_see_held_out_labels(spark):
    docs, labels, _ = crowd(spark, 200)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    one, two = toxicity.learn(docs, labels), toxicity.learn(docs, flipped)
    assert one.bias == two.bias and (one.weight == two.weight).all() and (one.factor == two.factor).all()


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_labels_of_one_kind(spark, toxic):
    docs = frame(spark, hard_texts())
    labels = spark.createDataFrame([(i, toxic) for i in range(5, 12) if toxic is not None],
                                   "doc_id bigint, toxic int")
    scores = {r.x for r in toxicity.score(docs, toxicity.learn(docs, labels), "x").collect()}
    assert len(scores) == 1 and (scores.pop() > 0.9) == (toxic == 1)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert toxicity.score(empty, toxicity.learn(empty, labels), "x").collect() == []


def test_machine_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = toxicity.Machine(np.zeros(1, int), 0.3, rng.normal(size=5), rng.normal(size=(5, 3)))
    term = np.array([0, 2, 4])
    want = 0.3 + machine.weight[term].sum() + sum(
        machine.factor[a] @ machine.factor[b] for a, b in ((0, 2), (0, 4), (2, 4)))
    assert np.isclose(machine.raw(np.zeros(3, int), term, 1)[0], want)
    assert toxicity.term_buckets(pa.array(["Word, ... word"]))[0].tolist()[1] == -1
