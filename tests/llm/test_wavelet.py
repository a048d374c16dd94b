import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelmart.llm.wavelet import WaveletMatrix, document_digests, encode, read_shards, write_shards
from parcelmart.shared import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=50, deadline=None, database=None)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 70_000)), max_size=60), st.integers(0, 5))
def test_answers_agree_with_the_plain_list(ids, token):
    matrix = WaveletMatrix(encode(np.array(ids, dtype=np.uint32)))
    assert matrix.decode().tolist() == ids and [matrix.access(i) for i in range(len(ids))] == ids
    spots = [i for i, x in enumerate(ids) if x == token]
    assert matrix.occurrences(token) == spots and matrix.count(token) == len(spots)
    assert matrix.select(token, len(spots)) == -1 and matrix.count(10**6) == 0
    for at in range(len(ids) + 1):
        assert matrix.rank(token, at) == ids[:at].count(token)


def test_many_blocks():
    ids = np.random.default_rng(1).zipf(1.3, 30_000) % 50_000
    matrix = WaveletMatrix(encode(ids))
    assert (matrix.decode() == ids).all()
    for at in (0, 1, 4095, 4096, 8192, 29_999):
        assert matrix.access(at) == ids[at] and matrix.rank(1, at) == (ids[:at] == 1).sum()
    assert ids[matrix.select(2, 1000)] == 2 and matrix.rank(2, matrix.select(2, 1000)) == 1000
    with pytest.raises(ValueError):
        WaveletMatrix(b"x" * 40)


ROWS = [(5, "five words in a row"), (1, "one\n two"), (9, None), (3, ""), (7, "long " * 60_000), (2, "a  b"), (3, "again"),
        (None, "no id"), (11, "a <|endoftext|> b<|endoftext|>"), *[(i, f"text {i} " * (i % 9)) for i in range(20, 300)]]


@pytest.mark.parametrize("shard_ids", [100, 1 << 18])
def test_round_trip(spark, shard_ids):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS start")
    path = scratch_path(spark, "test-shards")
    write_shards(docs, path, BYTE_BPE, shard_ids)
    tokenizer, start, expected = Tokenizer.from_file(BYTE_BPE), 0, []
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "").ids, 0], dtype="<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in document_digests(read_shards(spark, path)).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected


def test_empty_table(spark):
    path = scratch_path(spark, "test-empty")
    write_shards(spark.createDataFrame([], "doc_id long, text string"), path, BYTE_BPE)
    assert document_digests(read_shards(spark, path)).collect() == []
