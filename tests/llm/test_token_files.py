"""Simple-8b: exact round trips; token files: ids, order and offsets."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seriesmill.llm import queries, simple8b, token_files, tokens
from seriesmill.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=400), max_size=6))
def test_round_trip(lists):
    arrays = [np.array(x, np.uint64) for x in lists]
    for array, coded in zip(arrays, simple8b.encode(arrays), strict=True):
        assert np.array_equal(simple8b.decode(coded), array)


@pytest.mark.parametrize("top", [1, 2, 200, 50257, 2**40, 2**63])
def test_long_arrays_and_single_blocks(top):
    draw = np.random.default_rng(top)
    array = draw.integers(0, top, 5000, np.uint64)
    coded = simple8b.encode([array, array[:1024], array[:0]])
    assert np.array_equal(simple8b.decode(coded[0]), array)
    assert np.array_equal(simple8b.decode(coded[0], 2, 4), array[2048:4096])
    assert np.array_equal(simple8b.decode(coded[0], 4), array[4096:])
    assert np.array_equal(simple8b.decode(coded[1]), array[:1024])
    assert len(simple8b.decode(coded[2])) == 0


def test_words_hold_as_many_values_as_fit():
    assert len(simple8b.encode([np.zeros(1024, np.uint64)])[0]) < 150
    ids = np.full(1024, 50000, np.uint64)
    assert len(simple8b.encode([ids])[0]) < 342 * 8 + 60


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [[*e.ids, 2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").orderBy("doc_id").collect()}
    rows = {r.doc_id: r for r in queries.op6_token_files(spark, sf).collect()}
    start = 0
    for doc_id, ids in zip(texts, plain(texts.values()), strict=True):
        r = rows.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not rows


def test_nulls_repeated_rows_long_texts_and_empty_table(spark):
    texts = [(5, "a b c"), (5, "a b c"), (5, "z"), (None, None), (2, ""), (3, "word " * 60000), (9, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS part")
    rows = sorted(token_files.read_tokens(token_files.write_tokens(frame, PATH)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 2, 3, 5, 5, 5, 9]
    at = 0
    for r in rows:
        assert (r.start, len(r.ids)) == (at, 4 * r.n_tokens)
        at += r.n_tokens
    empty = token_files.read_tokens(token_files.write_tokens(frame.limit(0), PATH))
    assert empty.count() == 0


def test_a_new_word_of_small_batches_is_cut_once(monkeypatch):
    asked = []
    made = tokens._Pieces.made
    monkeypatch.setattr(tokens._Pieces, "made", lambda self, pieces: asked.extend(pieces) or made(self, pieces))
    monkeypatch.setattr(tokens, "PIECES_KEPT", 0)
    texts = ["one raremadeupword two", None, "one raremadeupword", ""] * 5
    batches = [pa.record_batch({"text": pa.array(texts[i : i + 2], pa.string())}) for i in range(0, len(texts), 2)]
    own = tokens.Encoder(PATH, special=True)
    found = [own.encode_batch(b.column(0)) for b in tokens.grouped(iter(batches))]
    got = [[*flat[a:b], 2] for flat, at in found for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == plain(texts)
    assert asked.count(" raremadeupword") == 1
    monkeypatch.setattr(tokens, "GROUP_BYTES", 1)
    assert [b.num_rows for b in tokens.grouped(iter(batches))] == [2] * 10
    assert not list(tokens.grouped(iter([])))
