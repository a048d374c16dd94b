import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelmart.llm import common, tokens
from parcelmart.llm.packing import LIMIT, pack_documents, plan_sequences
from parcelmart.llm.tokens import Encoder

WORD_BPE, BYTE_BPE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module", params=[(WORD_BPE, False), (BYTE_BPE, True)])
def pair(request):
    return plain(request.param[0]), Encoder(*request.param)


def test_stored_words_change_no_id(pair):
    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(st.sampled_from([" ", " ", "\n", "\t", "\xa0", ".", ",", "'s", "It", "é", "é", "ßen", "İ", "7",
                                     "Σ", "word", "Ünd", "\x1c", "<|endoftext|>", "ŉ", "　", "中"])).map("".join))
    def agree(text):
        assert np.frombuffer(pair[1](text), "<u4").tolist() == pair[0](text)

    agree()


def test_every_latin_letter_and_its_neighbours(pair):
    letters = [chr(c) for c in [*range(0x40, 0x260), 0x3C3, 0x1E9E]]
    text = " ".join(f"a{x}b {x}a. \n{x}a {x} ba{x}, 7{x}" for x in letters)
    assert np.frombuffer(pair[1](text), "<u4").tolist() == pair[0](text)
    for line in (f"a{x}b {x}a.\n{x}a ba{x}, 7{x}" for x in letters):
        assert np.frombuffer(pair[1](line), "<u4").tolist() == pair[0](line)
    for odd in (" a", "a ", "a  b", "\na", "a\n", "a\n b", "a \nb", "a\n\nb", " ", "\n", "a"):
        assert np.frombuffer(pair[1](odd), "<u4").tolist() == pair[0](odd)


@settings(max_examples=60, deadline=None, database=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), max_size=20))
def test_every_piece_is_planned_once(histogram):
    plan, used = plan_sequences(histogram, 64), Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 64
        for length in pattern:
            used[length] += times
    assert used == Counter(histogram)
    total = sum(k * n for k, n in histogram.items())
    assert sum(n for _, n in plan) <= 2 * total / 64 + 1


def test_exact_complements_are_found():
    assert sum(n for _, n in plan_sequences({60: 5, 4: 5, 40: 3, 14: 3, 10: 3, 31: 2, 11: 6}, 64)) == 10
    assert plan_sequences({}) == []


ROWS = [(1, "one two three"), (2, None), (3, ""), (4, "a b " * 4000), (5, "x " * 2047), (6, "y " * 2048),
        (1, "one two three"), (None, "no id"), *[(i, "w " * (i % 700)) for i in range(10, 400)]]


def test_pieces_are_whole_and_gapless(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS piece", "'x' AS length")
    rows, encode = pack_documents(docs, WORD_BPE).collect(), plain(WORD_BPE)
    expected = Counter()
    for doc_id, text in ROWS:
        ids = np.array([*encode(text or ""), 0], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), LIMIT)):
            part = ids[at:at + LIMIT]
            expected[doc_id, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= LIMIT and len(ends) <= sum(ends.values()) / LIMIT + 2


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORD_BPE).collect() == []


def test_other_work_lets_go_of_the_stored_words():
    """A worker keeps its words for the tasks that encode, and gives their memory back once it turns to something else."""
    kept = lambda batches: (b for b in batches if tokens.encoder(WORD_BPE, False)("some words here"))
    for _ in range(2):
        assert list(common.tidy(kept, tokens.WORDS)([1, 2])) == [1, 2]
        assert len(tokens.encoder(WORD_BPE, False).words)
    first = tokens.encoder(WORD_BPE, False)
    assert list(common.tidy(iter, tokens.WORDS)([3])) == [3] and tokens.encoder(WORD_BPE, False) is first
    assert list(common.tidy(iter)([4])) == [4] and not tokens._ENCODERS
