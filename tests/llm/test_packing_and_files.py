import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from estatelens.llm import dac, packing, tokens
from tests.llm.cases import SCHEMA, frame, hard_texts


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokens.default_path())
    return lambda text: whole.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_cached_ids_are_the_tokenizers_ids(encode):
    rng = random.Random(1)
    parts = [*"aAÉßİσΣ0²'sT \t\n\x0b\x1c .,<|>!ﬁÅ漢\U0001f642̀-",
             "<|endoftext|>", "don't", "I'LL", " ", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3000)] + [None, ""]
    ids, offsets = tokens.Words.of(tokens.default_path()).encode(pa.array(texts), 7)
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == [*encode(text), 7]


def check_packed(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_cover_every_document_and_sequences_have_no_gaps(spark, encode):
    texts = hard_texts()
    rows = packing.pack_documents(frame(spark, texts), capacity=256).collect()
    check_packed(rows, 256)
    want = []
    for doc, text in texts:
        ids = [*encode(text), packing.END_ID]
        want += [(doc, i // 256, i, len(ids[i:i + 256]), crc(ids[i:i + 256]))
                 for i in range(0, len(ids), 256)]
    assert sorted(map(str, want)) == sorted(
        str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit(np.array([6, 7, 3, 4]), 10)
    assert bins.tolist() == [1, 0, 0, 1] and offsets.tolist() == [0, 0, 7, 6]


def test_tree_of_partitions_packs_nearly_as_well_as_one(spark):
    rng = random.Random(3)
    lengths = [rng.choice((rng.randint(1, 40), rng.randint(1, 100))) for _ in range(3000)]
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    table = spark.createDataFrame(rows, packing.PIECE)
    packed = packing.pack(table, capacity=100, fan_in=2).collect()
    assert len(packed) == len(lengths)
    assert check_packed(packed, 100) <= -(-sum(lengths) // 100) * 1.2


def test_bins_that_nothing_fits_into_leave(spark):
    table = spark.createDataFrame([(i, 0, 0, 60, 0) for i in range(50)], packing.PIECE)
    assert check_packed(packing.pack(table, capacity=100, fan_in=2).collect(), 100) == 50


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(empty).collect() == []
    assert dac.read_documents(dac.write_files(empty)).collect() == []


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2 ** 32 - 1, 0], list(range(5000))])
def test_codes_round_trip_and_random_access(ids):
    ids = np.array(ids, np.uint32)
    file = dac.File(dac.encode([1, None], np.array([0, len(ids)]), ids))
    assert file.tokens().tolist() == ids.tolist()
    assert [file.token(i) for i in range(len(ids))] == ids.tolist()
    assert file.doc_ids == [1, None]
    with pytest.raises(IndexError):
        file.token(len(ids))


def test_files_give_back_every_document_in_order(spark, encode):
    texts = hard_texts()
    files = dac.write_files(frame(spark, texts), file_tokens=500)
    assert files.count() > 2
    rows = dac.read_documents(files).collect()
    want = sorted((str(d), len(encode(t)) + 1, crc([*encode(t), dac.END_ID])) for d, t in texts)
    assert want == sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows)
    rows.sort(key=lambda r: r.start)
    at, last = 0, -1
    for r in rows:
        assert r.start == at and (r.doc_id is None or r.doc_id >= last)
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    positions = spark.createDataFrame([(0,), (at - 1,), (at,), (700,)], "position bigint")
    got = {r.position: r.token for r in dac.lookup(files, positions).collect()}
    whole = np.concatenate([dac.File(bytes(f.data)).tokens()
                            for f in files.orderBy("part", "number").collect()])
    assert got == {p: int(whole[p]) for p in (0, at - 1, 700)}
