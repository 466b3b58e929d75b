"""Substring deduplication by relative Lempel-Ziv parsing, in words.

Contract: a word goes if a window of ``WINDOW`` consecutive words covers it whose words also start
in a document with a smaller doc_id, judged on the input.

Documents are parsed relative to reference blocks: a block indexes the phrases of ``WINDOW`` words
of its segments, and each segment is factored greedily against the phrases of smaller documents,
the longest match first found going on word by word. A factor of at least ``WINDOW`` words is a
duplicate span. A greedy factor may end inside a window that occurs elsewhere, so parsing resumes
``WINDOW - 1`` words before the factor's end: all windows across its boundary are looked up too.

Parsing every document against every block would cost documents times blocks. A document can only
have such a factor in a block with which it shares a window, hence a minimizer (``shared``); its
segments go to that block and no other, which finds the same factors.

Nulls: null text has no words. Rows without doc_id lose nothing and take nothing from others. Rows
of equal doc_id do not take from each other. Empty tables give no rows; other columns are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from estatelens.llm import shared
from estatelens.llm.rules import fresh_name

WINDOW, BLOCK_SEGMENTS = 50, 8_000


class ReferenceBlock:
    """Phrases of the segments added so far: the place where each came first."""

    def __init__(self, n: int):
        self.n = n
        self.texts: list[tuple[list[bytes], int]] = []
        self.index: dict[bytes, tuple[int, int]] = {}

    def add(self, items: list[bytes], doc: int) -> None:
        self.texts.append((items, doc))
        for i in range(len(items) - self.n + 1):
            self.index.setdefault(b" ".join(items[i:i + self.n]), (len(self.texts) - 1, i))

    def factor(self, items: list[bytes], i: int, doc: int) -> int:
        """Words from ``i`` on that match a text of a smaller document; 0 below n words."""
        found = self.index.get(b" ".join(items[i:i + self.n]))
        if found is None or self.texts[found[0]][1] >= doc:
            return 0
        text, at = self.texts[found[0]][0], found[1]
        length = self.n
        while (i + length < len(items) and at + length < len(text)
               and items[i + length] == text[at + length]):
            length += 1
        return length

    def parse(self, items: list[bytes], doc: int) -> list[tuple[int, int]]:
        """Factors (begin, length) of at least n words, with windows across boundaries checked."""
        out, i = [], 0
        while i + self.n <= len(items):
            length = self.factor(items, i, doc)
            if length:
                out.append((i, length))
                i += length - self.n + 1
            else:
                i += 1
        return out


def compare(segments: list[bytes], first: np.ndarray, n: int = WINDOW) -> list[list[int]]:
    """For each segment, its windows that a segment of a smaller document has."""
    block = ReferenceBlock(n)
    out: list[list[int]] = [[] for _ in segments]
    for at in np.argsort(first, kind="stable").tolist():
        items, doc = segments[at].split(), int(first[at])
        out[at] = sorted({k for i, length in block.parse(items, doc)
                          for k in range(i, i + length - n + 1)})
        block.add(items, doc)
    return out


SEARCH = shared.Search(shared.WordItems(), WINDOW, compare, BLOCK_SEGMENTS)


def mark(docs: DataFrame, name: str, search: shared.Search = SEARCH) -> DataFrame:
    """All columns and struct ``name``: n_items, n_removed, n_spans, kept (words by one space)."""
    return shared.mark(docs, search, name)


def remove(docs: DataFrame) -> DataFrame:
    """The rows with repeated words taken out of ``text``. Texts that lose nothing stay as they
    are; rows that lose all their words go."""
    name = fresh_name(docs, "_marked")
    marked = mark(docs, name)
    removed, kept = F.col(f"{name}.n_removed"), F.col(f"{name}.kept").cast("string")
    left = marked.where((removed == 0) | (removed < F.col(f"{name}.n_items")))
    return left.withColumn("text", F.when(removed > 0, kept).otherwise(F.col("text"))).drop(name)
