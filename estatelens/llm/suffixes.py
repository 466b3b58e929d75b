"""Suffix-array deduplication in bytes, by column-wise construction.

Contract: a byte goes if a string of ``WINDOW`` bytes covers it that also starts in a document with
a smaller doc_id, judged on the input; matches never cross documents.

Column-wise construction of the Burrows-Wheeler transform of a collection: in round t, every
string's suffix of length t is inserted, for all strings at once. A string's next symbol goes to
the place of its last suffix in the transform, and the new suffix's place is the number of smaller
symbols there and of equal symbols before it: one stable counting sort of the transform per round,
read and written in sequence. After as many rounds as the longest string has symbols all suffixes
are in order, and neighbours with a common prefix of ``WINDOW`` bytes are equal strings.

Whole documents would need as many rounds as the longest text has bytes, with every round reading
all of the corpus. Only prefixes of ``WINDOW`` bytes matter here, so the strings of a collection are
the segments of ``shared``, at most 84 bytes long, and a collection is a block of segments whose
minimizers are equal or hash together: equal strings are always in the same collection.

Nulls: null text is empty. Rows without doc_id lose nothing and take nothing from others. Rows of
equal doc_id do not take from each other. Empty tables give no rows; other columns are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from estatelens.llm import shared

WINDOW, BLOCK_SEGMENTS = 50, 8_000


def column_wise(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, string, length): the collection's Burrows-Wheeler transform (symbols dense from
    1 up, 0 at a string's beginning), and which suffix of which string stands at each place."""
    m = len(strings)
    size = np.fromiter(map(len, strings), np.int64, m)
    end = np.cumsum(size)
    joined = np.frombuffer(b"".join(strings), np.uint8)
    dense = np.zeros(256, np.uint8)
    used = np.unique(joined)             # UTF-8 leaves 13 byte values unused: never more than 255
    dense[used] = np.arange(1, len(used) + 1)
    joined = dense[joined]
    transform = np.zeros(m, np.uint8)    # round 0: the empty suffixes, in order of the strings
    place = np.arange(m)
    longest = int(size.max(initial=0))
    for t in range(1, longest + 1):
        active = np.flatnonzero(size >= t)
        transform[place[active]] = joined[end[active] - t]
        unread = np.count_nonzero(transform == 0)
        new = m + _ranks(transform)[place[active]] - unread
        grown = np.empty(len(transform) + len(active), np.uint8)
        old = np.ones(len(grown), bool)
        old[new] = False
        grown[old], grown[new] = transform, 0
        transform = grown
        place[active] = new
    # Which suffix stands where: from each string's empty suffix on, its symbols read off in turn.
    owner, length = np.zeros(len(transform), np.int32), np.zeros(len(transform), np.int16)
    place = np.arange(m)
    owner[place] = place
    rank = _ranks(transform)
    for t in range(1, longest + 1):
        active = np.flatnonzero(size >= t)
        place[active] = rank[place[active]]
        owner[place[active]], length[place[active]] = active, t
    return transform, owner, length


def _ranks(symbols: np.ndarray) -> np.ndarray:
    """Place of each symbol in stable order: a counting sort of single bytes."""
    rank = np.empty(len(symbols), np.int32)
    rank[np.argsort(symbols, kind="stable")] = np.arange(len(symbols), dtype=np.int32)
    return rank


def compare(segments: list[bytes], first: np.ndarray, n: int = WINDOW) -> list[list[int]]:
    """For each segment, its windows that a segment of a smaller document has."""
    _, owner, length = column_wise(segments)
    long = length >= n
    owner, length = owner[long].astype(np.int64), length[long].astype(np.int64)
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    begin = np.cumsum(size) - size
    place = size[owner] - length
    at = begin[owner] + place
    joined = np.frombuffer(b"".join(segments), np.uint8)
    equal = np.ones(max(len(at) - 1, 0), bool)
    for k in range(n):                   # common prefix of neighbours, column by column
        column = joined[at + k]
        equal &= column[1:] == column[:-1]
    group = np.flatnonzero(np.append(True, ~equal)) if len(at) else np.zeros(0, np.int64)
    out: list[list[int]] = [[] for _ in segments]
    if not len(at):
        return out
    doc = first[owner]
    least = np.repeat(np.minimum.reduceat(doc, group), np.diff(np.append(group, len(doc))))
    for i in np.flatnonzero(least < doc).tolist():
        out[owner[i]].append(int(place[i]))
    return out


SEARCH = shared.Search(shared.ByteItems(), WINDOW, compare, BLOCK_SEGMENTS)


def mark(docs: DataFrame, name: str, search: shared.Search = SEARCH) -> DataFrame:
    """All columns and struct ``name``: n_items (bytes), n_removed, n_spans, kept."""
    return shared.mark(docs, search, name)
