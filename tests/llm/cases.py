"""Documents with the cases every operator must take, and plain versions to compare with."""

import hashlib
import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, m string, stats string"

VOCABULARY = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def hard_texts() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, null ids, repeated rows, equal ids, ties, copies, long texts."""
    passage, long = prose(1, 80), prose(2, 6000)
    near = long.split()
    near[3000] = "changed"
    return [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "word"), (5, "word"),
        (6, passage), (7, prose(3, 30) + "\n" + passage + "  " + prose(4, 30)),
        (8, passage.replace(" ", "\n")), (9, long), (10, " ".join(near)), (10, " ".join(near)),
        (11, prose(5, 120)), (11, prose(6, 120)), (None, passage), (None, None),
        (12, "x " * 300), (13, "x " * 300 + "y"), (14, "é中\U0001f642 " * 60),
        (15, "中文" * 100), (16, "中文" * 99 + "z"), (17, prose(1, 49)), (0, prose(1, 50)),
    ]


def frame(spark, texts):
    sources = ("b", None, "a", "\U00010000", "￿")
    langs = ("en", None, "de")
    rows = [(i, t, langs[k % 3], sources[k % 5], None, None, "m", "s")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def windows_kept(rows, n, as_words):
    """(items, removed, spans, sha256) per row: windows of n items that a smaller id also has."""
    def items(text):
        data = (text or "").encode()
        return data.split() if as_words else [bytes([b]) for b in data]

    first = {}
    for doc, text in rows:
        it = items(text)
        for k in range(len(it) - n + 1) if doc is not None else ():
            w = tuple(it[k:k + n])
            first[w] = min(doc, first.get(w, doc))
    out = []
    for doc, text in rows:
        it = items(text)
        dead = [False] * len(it)
        for k in range(len(it) - n + 1) if doc is not None else ():
            if first[tuple(it[k:k + n])] < doc:
                dead[k:k + n] = [True] * n
        kept = (b" " if as_words else b"").join(x for x, d in zip(it, dead) if not d)
        spans = sum(d and not p for d, p in zip(dead, [False] + dead))
        out.append((doc, len(it), sum(dead), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)
