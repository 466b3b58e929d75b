"""Token ids of whole texts by a public tokenizer file, through a cache of words.

The tokenizer drops white space and never joins text across it, so the ids of a text are the ids
of its words, one after the other. Every distinct word of a slice is looked up once, by a 128-bit
hash in sorted arrays; words of ordinary letters that are new are cut into letter runs, digits and
other runs and go to the tokenizer's model, any other word goes through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from estatelens.llm import words

TOKENIZER = "word_bpe_49k.json"
# Entries per worker (about 40 bytes each); a full cache starts anew, with the same results.
CACHED_WORDS, CACHED_RUNS = 3_000_000, 150_000
SLICE_BYTES = 4 << 20

# Letters whose lower case and normal form are a character of the same block.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_PLAIN = re.compile(f"[!-~{_LETTERS}]+")
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Words:
    """Ids of words, kept for the life of a Python worker."""

    _made: dict[str, "Words"] = {}

    @classmethod
    def of(cls, path: str) -> "Words":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # Byte-level spelling: printable bytes stand for themselves, the rest for 256 and up.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = [b for b in range(256) if b not in set(shown)]
        self.spelled = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(spare)}
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)       # sorted low halves of the words' hashes
        self.checks = np.zeros(0, np.uint64)     # high halves
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.runs: dict[str, list[int]] = {}
        self.ids = array("I")

    def _spell(self, word: str) -> None:
        """Append the ids of a new word."""
        if not _PLAIN.fullmatch(word) or "<|" in word:
            self.ids.extend(self.whole.encode(word, add_special_tokens=False).ids)
            return
        for run in _RUNS.findall(word.lower()):
            ids = self.runs.get(run)
            if ids is None:
                spelt = run if run.isascii() else (
                    run.encode().decode("latin-1").translate(self.spelled))
                ids = [t.id for t in self.model.tokenize(spelt)]
                if len(self.runs) < CACHED_RUNS:
                    self.runs[run] = ids
            self.ids.extend(ids)

    def _find(self, distinct: list[str]) -> np.ndarray:
        """Entry of every word; new ones are added."""
        digest = xxhash.xxh3_128_digest
        both = np.frombuffer(b"".join(map(digest, distinct)), np.uint64).reshape(-1, 2)
        key, check = both[:, 0], both[:, 1]
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, max(len(self.keys) - 1, 0))
        found = (self.keys[near] == key) & (self.checks[near] == check) if len(self.keys) else (
            np.zeros(len(key), bool))
        new = np.flatnonzero(~found)
        if not len(new):
            return near
        bounds = array("q", [len(self.ids)])
        for i in new.tolist():
            self._spell(distinct[i])
            bounds.append(len(self.ids))
        bounds = np.array(bounds)
        order = np.argsort(key[new], kind="stable")
        where = at[new][order]
        self.keys = np.insert(self.keys, where, key[new][order])
        self.checks = np.insert(self.checks, where, check[new][order])
        self.first = np.insert(self.first, where, bounds[:-1][order])
        self.count = np.insert(self.count, where, np.diff(bounds)[order])
        return np.searchsorted(self.keys, key)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids (uint32) of the texts, ``end`` behind each, and document offsets."""
        if len(self.keys) > CACHED_WORDS:
            self.clear()
        flat, offsets = words.split(texts)
        coded = pc.dictionary_encode(flat)
        entry = self._find(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.append(np.frombuffer(self.ids, np.uint32), np.uint32(end))
        first = np.append(self.first[entry], len(ids) - 1)
        count = np.append(self.count[entry], 1)
        codes = np.insert(codes, offsets[1:], len(entry))      # the end id as a last word
        first, count = first[codes], count[codes]
        up_to = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(first - up_to[:-1], count)
        take += np.arange(len(take))
        return ids[take], up_to[offsets + np.arange(len(offsets))]
