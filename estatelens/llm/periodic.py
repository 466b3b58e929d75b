"""Runs of repeated words: seeds on diagonals, extended, collapsed to their first period.

A run of smallest period q and length at least max(24, 3 q) matches itself, q words further on, over
at least max(24 - q, 2 q) words. So every run of period 1 to 15 shows as a gram of 16 words that
comes again q words later, every run of period 16 to 31 as a gram of 32, and so on: grams are at
least one period long, which is why the *next* place of a gram is exactly one period away and no
other pair of places needs to be looked at. Grams double in length from one index to the next; a gram
that a document has once is dropped, so the larger indexes hold little but repeats.

Each pair of places is a seed on the diagonal of its lag. Along a diagonal the seed is compared word
by word in both directions. A table of the furthest place covered per lag suppresses seeds inside an
extension that was made, so no stretch of a diagonal is compared twice.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; words are equal when their bytes are. Each document is its own, in one task: time is
n log n in its words, memory linear. Null and empty texts have no words. Repeated rows are judged
alike. Empty tables give no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from estatelens.llm import words

LEAST, TIMES = 24, 3                # a run is at least this long, and this many periods
FIRST_GRAM = 16                     # least of max(LEAST - q, (TIMES - 1) q) over all periods q
BLOCK = 1 << 10                     # words compared at a time, growing

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_runs", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("n_dropped", T.LongType()), T.StructField("collapsed", T.StringType())])


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense names of equal keys, and how many have each."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return names.astype(np.int64), counts


def seeds(codes: np.ndarray, offsets: np.ndarray):
    """(places, lags) of seeds for one gram length after the other, smallest first.

    ``codes``: exact numbers of the words of all documents of a slice.
    """
    owner = words.owners(offsets)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    sizes = np.diff(offsets)
    long_enough = np.repeat(sizes >= LEAST, sizes)
    at = np.flatnonzero(long_enough)
    if not len(at):
        return
    name = np.full(len(codes), -1, np.int64)
    got, counts = _names(owner[at] * (int(codes.max()) + 1) + codes[at])
    gram, longest = 1, int(sizes.max())
    while True:
        repeated = counts[got] > 1
        at, got = at[repeated], got[repeated]
        if gram >= FIRST_GRAM and len(at):
            order = np.lexsort((at, got))
            first, second = at[order[:-1]], at[order[1:]]
            lag = second - first
            low = 1 if gram == FIRST_GRAM else gram // 2
            seed = (got[order[:-1]] == got[order[1:]]) & (lag >= low) & (lag < gram)
            yield first[seed], lag[seed]
        # A run with a period of ``gram`` or more has three of them.
        if not len(at) or (gram >= FIRST_GRAM and longest < TIMES * gram):
            return
        name[:] = -1
        name[at] = got
        whole = at + 2 * gram <= ends[at]
        at, got = at[whole], got[whole]
        after = name[at + gram]
        whole = after >= 0
        at = at[whole]
        got, counts = _names(got[whole] * (len(counts) + 1) + after[whole])
        gram *= 2


def _agreement(codes: np.ndarray, a: int, b: int, limit: int, step: int) -> int:
    """How many words from a and b on (step 1) or back (step -1) are equal, at most ``limit``."""
    same, block = 0, BLOCK
    while same < limit:
        size = min(block, limit - same)
        if step > 0:
            x, y = codes[a + same:a + same + size], codes[b + same:b + same + size]
        else:
            x, y = codes[a - same - size + 1:a - same + 1][::-1], codes[b - same - size + 1:b - same + 1][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return same + int(differ[0])
        same, block = same + size, block * 2
    return same


def find(codes: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Document -> (start, length, period) of its runs, by start, then period."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for places, lags in seeds(codes, offsets):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # A seed next to one of the same lag lies inside that one's extension.
        apart = np.ones(len(places), bool)
        apart[1:] = (np.diff(places) != 1) | (np.diff(lags) != 0)
        docs = np.searchsorted(offsets, places[apart], "right") - 1
        covered: dict[int, int] = {}
        for place, lag, doc in zip(places[apart].tolist(), lags[apart].tolist(), docs.tolist()):
            if covered.get(lag, -1) > place:
                continue
            begin, end = int(offsets[doc]), int(offsets[doc + 1])
            ahead = _agreement(codes, place, place + lag, end - place - lag, 1)
            floor = max(begin, covered.get(lag, 0))
            back = _agreement(codes, place - 1, place + lag - 1, place - floor, -1)
            covered[lag] = place + ahead
            start, length = place - back, back + ahead + lag
            if length >= max(LEAST, TIMES * lag):
                runs.setdefault(doc, []).append((start - begin, length, lag))
    return {doc: sorted(found, key=lambda r: (r[0], r[2])) for doc, found in runs.items()}


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the greatest exact length / period; ties: smallest start, then period."""
    best = runs[0]
    for run in runs[1:]:             # in order, so only a greater one replaces
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: all but those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def mark(docs: DataFrame, name: str) -> DataFrame:
    """All columns and ``name``: the runs of ``text``, the greatest one (start, length, period; null
    without runs) and the text that is left, its words joined by one space."""
    names = [*docs.columns, name]

    def run(batches):
        for batch in words.slices(batches):
            flat, offsets = words.split(batch.column("text").cast(pa.string()))
            coded = flat.dictionary_encode() if len(flat) else None
            codes = coded.indices.to_numpy().astype(np.int64) if coded else np.zeros(0, np.int64)
            runs = find(codes, offsets)
            rows = []
            for doc, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
                own = runs.get(doc, [])
                kept = flat[a:b] if b > a else None
                n_kept = b - a
                if own:
                    stays = collapsed(b - a, own)
                    kept, n_kept = kept.filter(pa.array(stays)), int(stays.sum())
                best = greatest(own) if own else (None, None, None)
                rows.append({
                    "n_words": b - a, "n_runs": len(own), "start": best[0], "length": best[1],
                    "period": best[2],
                    "runs": [dict(zip(("start", "length", "period"), r)) for r in own],
                    "n_dropped": b - a - n_kept,
                    "collapsed": " ".join(kept.to_pylist()) if kept is not None else ""})
            added = pa.array(rows, _arrow())
            yield pa.RecordBatch.from_arrays([*batch.columns, added], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, FOUND)]))


def _arrow() -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(FOUND)


def collapse(docs: DataFrame) -> DataFrame:
    """The documents with repeats collapsed: texts that have a run become their kept words, joined
    by one space; all others stay as they are."""
    name = "found"
    while name in docs.columns:
        name += "_"
    marked = mark(docs, name)
    text = F.when(F.col(f"`{name}`.n_runs") > 0, F.col(f"`{name}`.collapsed")).otherwise(F.col("text"))
    return marked.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns])


# ------------------------------------------------------------------------- the query's own texts
def looped_words(doc_id: int, n: int) -> np.ndarray | None:
    """Place of the original word at each place of a document that is made to loop, else None."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def looped(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by crc32 of their id, with a tail that repeats a stretch of words.

    Their words are joined by one space. Rows without doc_id stay as they are.
    """
    at = docs.columns.index("text")
    ids = docs.columns.index("doc_id")

    def run(batches):
        for batch in words.slices(batches):
            texts = batch.column(at).cast(pa.string())
            made = texts.to_pylist()
            hit = [i for i, doc in enumerate(batch.column(ids).to_pylist())
                   if doc is not None and made[i] and zlib.crc32(str(doc).encode()) % 10 == 0]
            if hit:
                flat, offsets = words.split(texts.take(pa.array(hit)))
                for k, i in enumerate(hit):
                    own = flat[int(offsets[k]):int(offsets[k + 1])]
                    places = looped_words(batch.column(ids)[i].as_py(), len(own))
                    if places is not None:
                        made[i] = " ".join(own.take(pa.array(places)).to_pylist())
            columns = list(batch.columns)
            columns[at] = pa.array(made, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
