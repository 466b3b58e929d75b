"""Language of a text by cross parsing.

For every language a suffix automaton is built over a bounded sample of labelled text. A text is
parsed against it greedily: follow the automaton while the symbols read so far occur somewhere in
the sample, and where they do not, end the phrase and begin the next one. Text of the language
needs few, long phrases. Their cost in bits is the cross entropy; the language with the least wins.

A phrase of one symbol, known to the sample or not, is spelled out at the logarithm of the number of
symbols of all samples together, the same in every language. A longer one names a place at the
logarithm of its own sample's length, which counts as at least the number of symbols. So a sample
gains only by phrases of two symbols or more, however short it is. Each costs a bit to say which.

Texts are parsed whole, in segments of ``SEGMENT`` symbols (a phrase also ends with its segment),
and many segments advance at once, one symbol per step.

Bounded: per language ``SAMPLE_CHARS`` characters of labelled rows. Different texts only, those with
the smallest hash first; each gives ``SAMPLE_CHARS / SAMPLE_DOCS`` characters from a place that its
hash draws, so copies count once and headers that documents share do not fill the sample. Short
texts leave their share to the next ones, up to ``MORE_DOCS`` times ``SAMPLE_DOCS`` texts. Every code
point of the samples is a symbol. Prediction reads every whole text.

Nulls: null text and text without a letter get ``und`` with score 0; so does everything if nothing
is labelled. A null lang is no label, a null doc_id is predicted but not learned from. Ties go to
the language first by code point. Repeated rows get equal results; other columns are kept; an
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from estatelens.llm import words

SAMPLE_DOCS, SAMPLE_CHARS, SEGMENT = 150, 45_000, 512
MORE_DOCS = 8
UNKNOWN = "und"
RESULT = T.StructType([T.StructField("lang_pred", T.StringType(), False),
                       T.StructField("score", T.DoubleType(), False)])


def held_out(doc_id: Column) -> Column:
    """Rows that no language is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _points(text: str) -> np.ndarray:
    """Code points of the text in lower case."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def automaton(codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of a sequence, without those by symbol 0: see ``packed``."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in codes:
        here = len(step)
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = here
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[p] + 1 == longest[q]:
                link[here] = q
            else:                       # q also ends longer strings: split off the shorter ones
                short = len(step)
                step.append(dict(step[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                link[q] = link[here] = short
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = short
                    p = link[p]
        last = here
    for moves in step:
        moves.pop(0, None)
    return packed(step, max(codes, default=0) + 1)


def packed(step: list[dict[int, int]], n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Moves in one row of slots: the move from state s by symbol c lies in slot s + c if s owns it.
    States are numbered anew for that; the root, which has every symbol, is 0, and no move leads
    back to it. As many slots as moves, and some more, whatever the alphabet."""
    size = np.array([len(moves) for moves in step])
    number, taken, used = np.zeros(len(step), np.int64), {0}, bytearray(4 * len(step) + 2 * n_symbols)
    for c in step[0]:
        used[c] = 1
    begin = 1
    for state in np.argsort(-size, kind="stable")[:int((size > 1).sum())].tolist():
        if not state:                           # the root stays 0
            continue
        symbols = sorted(step[state])
        slot, tries = begin, 0
        while True:
            slot = used.find(0, slot)
            if slot < 0 or slot + n_symbols >= len(used):
                slot = max(slot, begin)
                used.extend(bytes(len(used)))
                continue
            at = slot - symbols[0]
            if at > 0 and at not in taken and not any(used[at + c] for c in symbols[1:]):
                break
            slot, tries = slot + 1, tries + 1
        if tries > 8:                           # nearly full up to here
            begin = slot
        number[state] = at
        taken.add(at)
        for c in symbols:
            used[at + c] = 1
    # States of one move take the free slots in turn; those whose number is taken, later ones.
    rest = 1 + np.flatnonzero(size[1:] == 1)
    symbol = np.array([next(iter(step[s])) for s in rest.tolist()], np.int64)
    full, numbers, begin = np.frombuffer(bytes(used), bool), np.array(sorted(taken)), 1
    while len(rest):
        full = np.pad(full, (0, len(rest) + max(begin - len(full), 0)))
        slots = begin + np.flatnonzero(~full[begin:])[:len(rest)]
        at = slots - symbol
        once = np.zeros(len(rest), bool)
        once[np.unique(at, return_index=True)[1]] = True
        good = once & (at > 0) & ~np.isin(at, numbers)
        number[rest[good]] = at[good]
        numbers, begin = np.concatenate([numbers, at[good]]), int(slots[-1]) + 1
        rest, symbol = rest[~good], symbol[~good]
    none = 1 + np.flatnonzero(size[1:] == 0)
    number[none] = numbers.max() + 1 + np.arange(len(none))
    moves = np.array([(s, c, t) for s, m in enumerate(step) for c, t in m.items()], np.int64).reshape(-1, 3)
    slot = number[moves[:, 0]] + moves[:, 1]
    owner = np.full(number.max() + n_symbols, -1, np.int32)
    to = np.zeros(len(owner), np.int32)
    owner[slot], to[slot] = number[moves[:, 0]], number[moves[:, 2]]
    return owner, to


class Parser:
    """Automata of all languages, built once per worker from the samples."""

    _made: dict[int, "Parser"] = {}

    @classmethod
    def of(cls, samples: dict[str, list[str]]) -> "Parser":
        key = hash(tuple((k, *v) for k, v in sorted(samples.items())))
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(samples)
        return cls._made[key]

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples, key=lambda x: x.encode())
        parts = {k: [_points(t) for t in samples[k]] for k in self.langs}
        every = np.concatenate([p for k in self.langs for p in parts[k]] or [np.zeros(0, np.uint32)])
        point = np.unique(every)
        self.n_symbols = len(point) + 1
        self.code = np.zeros(0x110000, np.int32)        # 0: a symbol that no sample has
        self.code[point] = np.arange(1, self.n_symbols)
        self.moves, self.cost = [], []
        for k in self.langs:
            codes: list[int] = []
            for p in parts[k]:                          # 0 parts the excerpts; it is never matched
                codes += [*self.code[p].tolist(), 0]
            owner, to = automaton(codes)
            room = max(self.n_symbols - len(owner), 0) + self.n_symbols     # any state plus any symbol
            owner, to = np.pad(owner, (0, room), constant_values=-1), np.pad(to, (0, room))
            first = np.where(owner[:self.n_symbols] == 0, to[:self.n_symbols], 0)
            self.moves.append((owner, to, first))
            self.cost.append(1 + math.log2(max(len(codes), self.n_symbols)))
        self.spelled = 1 + math.log2(self.n_symbols)

    def phrases(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of every text against every language: texts x languages."""
        return self.parse(codes, offsets)[0]

    def parse(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases, and those of one symbol, of every text against every language."""
        n = np.diff(offsets)
        per_text = -(-n // SEGMENT)
        text = np.repeat(np.arange(len(n)), per_text)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        begin = offsets[:-1][text] + nth * SEGMENT
        length = np.minimum(offsets[1:][text] - begin, SEGMENT)
        order = np.argsort(-length, kind="stable")
        text, begin, length = text[order], begin[order], length[order]
        active = np.searchsorted(-length, -np.arange(SEGMENT), side="left")
        state = [np.zeros(len(text), np.int32) for _ in self.langs]
        count = [np.zeros(len(text), np.int32) for _ in self.langs]
        short = [np.zeros(len(text), np.int32) for _ in self.langs]
        begun = [np.zeros(len(text), bool) for _ in self.langs]    # by the symbol before
        for t in range(int(length[0]) if len(length) else 0):
            k = active[t]                               # segments longer than t
            c = codes[begin[:k] + t]
            for lang, (owner, target, first) in enumerate(self.moves):
                s = state[lang][:k]
                slot = s + c
                stuck = owner[slot] != s
                # Stuck: a phrase ends before this symbol, which begins the next. A symbol that
                # the sample does not have leads to the root: it is a phrase of its own.
                stuck |= s == 0
                state[lang][:k] = np.where(stuck, first[c], target[slot])
                count[lang][:k] += stuck
                before = begun[lang][:k]
                short[lang][:k] += before & stuck
                before[:] = stuck
        short = [a + b for a, b in zip(short, begun)]               # the last of a segment
        return tuple(np.stack([np.bincount(text, weights=c, minlength=len(n)) for c in counts], axis=1)
                     for counts in (count, short))

    def bits(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cost of every text in every language: texts x languages."""
        count, short = self.parse(codes, offsets)
        return (count - short) * np.array(self.cost) + short * self.spelled

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        strings = pc.fill_null(texts, "").to_pylist()
        points = [_points(s) for s in strings]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in points])]).astype(np.int64)
        flat = np.concatenate([*points, np.zeros(0, np.uint32)])
        distinct, inverse = np.unique(flat, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in distinct.tolist()], bool)[inverse]
        up_to = np.concatenate([[0], np.cumsum(letter)])
        known = (up_to[offsets[1:]] > up_to[offsets[:-1]]) if self.langs else np.zeros(len(strings), bool)
        if not known.any():
            return [UNKNOWN] * len(strings), np.zeros(len(strings))
        entropy = self.bits(self.code[flat], offsets)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(best)), best]
        if len(self.langs) > 1:
            second = np.partition(entropy, 1, axis=1)[:, 1]
            score = second / np.maximum(least + second, 1e-9)     # 0.5: a tie
        else:
            score = np.ones(len(best))
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())],
                np.where(known, score, 0.0))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Excerpts per language, from labelled rows that are not held out."""
    share = max(sample_chars // sample_docs, 1)
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    labelled = docs.where(lang.isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id")) & (F.length(text) > 0))
    digest = F.xxhash64(F.lit("text"), text)
    last = F.greatest(F.length(text) - share, F.lit(0))             # the last place to begin at
    begin = F.pmod(F.xxhash64(F.lit("place"), text), last + 1).cast("int")
    # The rank's window keeps its first rows before the shuffle; texts alike are one row by then.
    texts = labelled.select(lang.alias("lang"), digest.alias("digest"),
                            F.substring(text, begin + 1, F.lit(share)).alias("text"))
    texts = texts.groupBy("lang", "digest").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("digest"))
    first = texts.withColumn("place", place).where(F.col("place") <= MORE_DOCS * sample_docs)
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1))
    rows = (first.withColumn("before", F.coalesce(before, F.lit(0)))
            .where(F.col("before") < sample_chars)
            .select("lang", "place", F.expr(f"substring(text, 1, {sample_chars} - before)").alias("text"))
            .orderBy("lang", "place").collect())           # sample_chars per language at most
    out: dict[str, list[str]] = {}
    for row in rows:
        if row.text:
            out.setdefault(row.lang, []).append(row.text)
    return out


def identify(docs: DataFrame, samples: dict[str, list[str]], name: str) -> DataFrame:
    """All columns and struct ``name``: lang_pred and score of ``text``."""
    def run(batches):
        parser = Parser.of(samples)
        for batch in words.slices(batches):
            langs, score = parser.predict(batch.column("text").cast(pa.string()))
            out = pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score)],
                                             ["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField(name, RESULT, False)]))
