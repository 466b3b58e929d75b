"""Quality rules learned as a decision list.

Statistics of a text (counts of words, characters, symbols, repeated lines and words) become
ratios; sequential covering learns rules for rejected texts from labelled ones. A rule is grown
condition by condition (the threshold with the best information gain), pruned on held-back rows by
dropping conditions from its end, and kept while it is right often enough there; the rows it covers
are taken out, and the next rule is learned. The result is one ordered Spark expression, the same
``when ... when ... otherwise`` at any size of table.

Bounded: learning uses at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash.
Judging uses every row.

Nulls: null text has no words. A null doc_id is judged, but never used for learning. A null label
is no label; a document with several labels counts as rejected if one says so. Without labels the
list is empty and everything that passes the fixed rules stays. Repeated rows get the same verdict.
Other columns are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from estatelens.llm import words

SAMPLE_ROWS = 20_000
MIN_PRECISION, MIN_COVER, MAX_CONDITIONS, CUTS = 0.95, 10, 3, 64
REPEAT_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_capitals", "n_marks")
COUNTS_TYPE = T.StructType([T.StructField(c, T.LongType(), False) for c in COUNTS])
# Ratio -> (numerator, denominator); the decision list's thresholds are on these.
RATIOS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "capitals_per_char": ("n_capitals", "word_chars"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


SPACES = _table(b" \t\n\v\f\r")
SYMBOLS = _table(b"#*$%&|<>")
CAPITALS = _table(bytes(range(65, 91)))
MARKS = _table(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
CONTINUATION = _table(bytes(range(0x80, 0xC0)))


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    up_to = np.concatenate([[0], np.cumsum(flags)])
    return up_to[offsets[1:]] - up_to[offsets[:-1]]


def _repeated_lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def _repeat_words(codes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Words per document within windows of n words that the document has twice or more."""
    places = words.inside(offsets, n)
    if not len(places):
        return np.zeros(len(offsets) - 1, np.int64)
    doc = words.owners(offsets)
    with np.errstate(over="ignore"):
        key = words.mix(words.windows(codes, n)[places]
                        + words.mix(doc[places].astype(np.uint64) + np.uint64(1)))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = places[count[inverse] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + n, -1)
    return _per_document(np.cumsum(edge[:-1]) > 0, offsets)


def count(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of every text, exact over the whole text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, np.uint8)
    at = ends - ends[0]
    flat, offsets = words.split(texts)
    lines = np.array([_repeated_lines(t) for t in texts.to_pylist()], np.int64).reshape(-1, 2)
    return {
        "n_words": np.diff(offsets),
        "word_chars": np.diff(at) - _per_document((SPACES + CONTINUATION)[buf], at),
        "n_symbols": _per_document(SYMBOLS[buf], at),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": _repeat_words(words.of_words(flat), offsets, REPEAT_WINDOW),
        "n_lines": lines[:, 0],
        "n_capitals": _per_document(CAPITALS[buf], at),
        "n_marks": _per_document(MARKS[buf], at),
    }


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def with_counts(docs: DataFrame, name: str) -> DataFrame:
    """All columns and, as struct column ``name``, the statistics of ``text``."""
    def run(batches):
        for batch in words.slices(batches, nbytes=2 << 20):
            got = count(batch.column("text").cast(pa.string()))
            stats = pa.StructArray.from_arrays([pa.array(got[c]) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns, stats], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField(name, COUNTS_TYPE, False)]))


def base_failed(stats: str) -> Column:
    """The fixed rules: too short, or too many words in repeated windows."""
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < MIN_WORDS) | (repeated * 100 > n * MAX_REPEAT_PERCENT)


# ------------------------------------------------------------------------------ learning
@dataclass(frozen=True)
class Condition:
    """``ratio`` at least or at most ``threshold``."""
    ratio: str
    at_least: bool
    threshold: float

    def holds(self, table: pd.DataFrame) -> np.ndarray:
        values = table[self.ratio].to_numpy()
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self, stats: str) -> Column:
        value = ratio(self.ratio, stats)
        return value >= F.lit(self.threshold) if self.at_least else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def ratio(name: str, stats: str) -> Column:
    top, below = RATIOS[name]
    value = F.col(f"{stats}.{top}").cast("double")
    return value if below is None else value / F.greatest(F.col(f"{stats}.{below}"), F.lit(1))


def _ratios(counts: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({
        name: counts[top] * 1.0 if below is None else counts[top] / counts[below].clip(lower=1)
        for name, (top, below) in RATIOS.items()})


def _all(rule: Rule, table: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(table), bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _grow(table: pd.DataFrame, bad: np.ndarray, left: np.ndarray) -> Rule:
    """Add the condition with the best gain (covered bad rows times the rise of their log share)
    until no good row is covered or no condition helps."""
    rule: Rule = ()
    covered = left.copy()
    while len(rule) < MAX_CONDITIONS:
        pos, neg = int((covered & bad).sum()), int((covered & ~bad).sum())
        if pos == 0 or neg == 0:
            break
        now, best, best_gain = np.log2(pos / (pos + neg)), None, 1e-9
        for name in RATIOS:
            values = table[name].to_numpy()
            cuts = np.unique(np.quantile(values[covered], np.linspace(0, 1, CUTS + 1)))
            for at_least in (True, False):
                for cut in cuts.tolist():
                    hit = covered & (values >= cut if at_least else values <= cut)
                    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
                    if p < MIN_COVER or p + n == pos + neg:
                        continue
                    gain = p * (np.log2(p / (p + n)) - now)
                    if gain > best_gain:
                        best, best_gain = Condition(name, at_least, cut), gain
        if best is None:
            break
        rule += (best,)
        covered &= best.holds(table)
    return rule


def _prune(rule: Rule, table: pd.DataFrame, bad: np.ndarray, left: np.ndarray) -> Rule:
    """The beginning of the rule with the best (bad - good) / covered on held-back rows."""
    best, best_worth = rule, -2.0
    for k in range(len(rule), 0, -1):
        hit = left & _all(rule[:k], table)
        if hit.any():
            worth = float((hit & bad).sum() - (hit & ~bad).sum()) / float(hit.sum())
            if worth >= best_worth:
                best, best_worth = rule[:k], worth
    return best


def cover(counts: pd.DataFrame, bad: np.ndarray, min_precision: float = MIN_PRECISION) -> list[Rule]:
    """Sequential covering over a table of statistics; every third row is held back for pruning."""
    table = _ratios(counts).reset_index(drop=True)
    held = np.arange(len(table)) % 3 == 2
    left, rules = np.ones(len(table), bool), []
    while (left & bad & ~held).sum() >= MIN_COVER:
        rule = _grow(table, bad, left & ~held)
        if not rule:
            break
        rule = _prune(rule, table, bad, left & held)
        hit = _all(rule, table) & left
        judged = hit & held if (hit & held).sum() >= MIN_COVER else hit
        if (hit & bad).sum() < MIN_COVER or (judged & bad).sum() < min_precision * judged.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
          min_precision: float = MIN_PRECISION) -> list[Rule]:
    """The decision list from ``labels`` (doc_id, quality: 1 good, 0 bad)."""
    marked = (labels.where("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    one = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id")                   # at most sample_rows rows
    counted = with_counts(one, "stats").groupBy("doc_id").agg(
        F.min(F.struct("stats", "quality")).alias("row"))        # one row of repeated ids
    counted = counted.where(~base_failed("row.stats"))       # those are rejected before the list
    rows = counted.select("row.stats.*", "row.quality", F.xxhash64("doc_id").alias("at")).toPandas()
    rows = rows.sort_values("at", kind="stable")
    return cover(rows, (rows["quality"] == 0).to_numpy(), min_precision)


def verdict(rules: list[Rule], stats: str) -> tuple[Column, Column]:
    """(kept by the list, number of the rule that rejected): ordered conditional expressions."""
    number = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules, 1):
        both = rule[0].column(stats)
        for condition in rule[1:]:
            both = both & condition.column(stats)
        number = number.when(both, F.lit(i))
    number = number.otherwise(F.lit(None).cast("int"))
    return number.isNull(), number


def judge(docs: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """All columns and struct ``name``: the statistics, base_failed, kept, rule."""
    stats = fresh_name(docs, "_stats")
    kept, number = verdict(rules, stats)
    out = with_counts(docs, stats)
    failed = base_failed(stats)
    return out.withColumn(name, F.struct(
        *[F.col(f"{stats}.{c}").alias(c) for c in COUNTS], failed.alias("base_failed"),
        (~failed & kept).alias("kept"), number.alias("rule"))).drop(stats)


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that pass, with their own columns."""
    name = fresh_name(docs, "_verdict")
    return judge(docs, rules, name).where(F.col(f"{name}.kept")).drop(name)
