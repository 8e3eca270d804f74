import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tickloom.llm.packing import Encoder, _best_fit, cuts, pack, pack_documents, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, piece string, k1 string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def texts(spark):
    odd = ["", " ", "  a", "a  b \n c\t d ", "\n\n x", "it's  we'll 12 34.5 --é  x", "😀  y \u0085z", "a <|endoftext|> b", "x\r\n y", "日本 語", " \x1c q", "don't 'S ' s", "ab" * 4000 + " x" + "\n" * 6000]
    return odd + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]


def test_ids_equal_the_tokenizer(spark, tokenizer):
    encoder = Encoder(PATH)
    for text in texts(spark):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]


def test_cuts():
    assert cuts(1024, 1024) == [(0, 1024)] and cuts(1, 1024) == [(0, 1)]
    assert cuts(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)] and cuts(2048, 1024) == [(0, 1024), (1024, 1024)]


@pytest.mark.parametrize("seed", range(6))
def test_packing_is_whole_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    lengths = [min(100, max(1, int(rng.choice([rng.gauss(45, 9), rng.uniform(1, 100), 34, 51])))) for _ in range(800)]
    bins = pack(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    assert -(-sum(lengths) // 100) <= len(bins) <= len(_best_fit(lengths, 100))


def test_local_search_empties_a_bin():
    lengths = [50, 47, 30, 26, 26, 21]  # best fit: 50+47, 30+26+26, 21; exchanges leave two bins
    assert len(_best_fit(lengths, 100)) == 3 and sum(lengths) == 200
    assert len(pack(lengths, 100)) <= 3
    whole = pack(lengths, 100, breadth=None)
    assert sorted(i for b in whole for i in b) == list(range(6)) and len(whole) <= 3
    assert pack([], 100) == [] and pack([100, 100], 100) == [[0], [1]]


def test_documents(spark, tokenizer):
    rows = [(i, t, None, "x") for i, t in enumerate(texts(spark))] + [(None, None, None, None), (3, texts(spark)[3], None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pack_documents(df, PATH, block_pieces=100).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(cuts(len(ids), 1024)):
            want.append((str(doc_id), k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024
    again = {r.sequence_id: bytes(r.ids) for r in sequences(df, PATH, block_pieces=100).collect()}
    assert {k: len(v) // 4 for k, v in again.items()} == {k: sum(n for _, n in v) for k, v in places.items()}
    r = max(got, key=lambda x: x.length)
    assert zlib.crc32(again[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32


def test_copies_of_a_row_are_dealt_to_all_blocks(spark):
    rows = [(1, "one and the same row", None, None)] * 400 + [(i, f"row {i}", None, None) for i in range(2, 102)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = pack_documents(df, PATH, block_pieces=50).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert len({(r.sequence_id, r.offset) for r in got}) == 500
    blocks = {}
    for r in got:
        blocks[r.sequence_id >> 32] = blocks.get(r.sequence_id >> 32, 0) + 1
    assert len(blocks) == 10 and max(blocks.values()) < 100
    spread = pack_documents(df.repartition(7, "doc_id"), PATH, block_pieces=50).collect()
    assert sorted(map(str, spread)) == sorted(map(str, got))


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
