"""Byte-pair encoding by a segment tree: the library's ids and texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seriesmill.llm import bpe, queries
from seriesmill.llm.common import table
from seriesmill.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.TreeEncoder(PATH)
WORDS = Encoder(PATH, special=True)


def same(encoder, texts):
    ids, at = encoder.encode_batch(pa.array(texts, pa.string()))
    want = [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    return ids, at, want


CASES = [
    "", None, " ", "  ", "a", "x" * 5000, "ab" * 33, "aaaa " * 100, "été à la carte", "\n\n a \n", "end ", " start",
    "don't we'll I'VE", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "x <|endoftext|", "漢字かな ١٢٣ 🙂 é", "tab\tb\r\nc d\x85",
]


@pytest.mark.parametrize("encoder", [OWN, WORDS])
def test_ids_of_cases(encoder):
    ids, at, want = same(encoder, CASES)
    assert OWN.decode(ids, at) == [LIBRARY.decode(w, skip_special_tokens=False) for w in want]
    assert [i.tolist() for i in encoder.encode_batch(pa.array([], pa.string()))] == [[], [0]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("aabth e\n's1<|endoftext|>é漢", max_size=120)), max_size=8))
def test_ids_of_any_texts(texts):
    for encoder in (OWN, WORDS):
        same(encoder, texts)


def test_long_pieces_and_matrices():
    draw = random.Random(4)
    pieces = ["".join(draw.choice("abcdeth") for _ in range(n)) for n in (1, 2, 3, 63, 64, 65, 66, 67, 1000, 30000)] * 3
    same(OWN, pieces)
    for piece in pieces:
        if 1 < len(piece) <= bpe.LONGEST + 1:
            width = 1 << max(1, (len(piece) - 2).bit_length())
            matrix = bpe._encode_matrix([piece.encode()], OWN.merges, width)[0]
            assert np.frombuffer(matrix, "<u4").tolist() == bpe.encode_long(piece.encode(), OWN.merges)


@given(st.lists(st.integers(0, 50256), max_size=30))
def test_decoding_of_any_ids(ids):
    assert OWN.decode(np.array(ids, np.int64), [0, len(ids)]) == [LIBRARY.decode(ids, skip_special_tokens=False)]


def digest(raw):
    return hashlib.sha256(raw).hexdigest()


def expected(texts):
    made = []
    for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False):
        decoded = LIBRARY.decode(e.ids, skip_special_tokens=False)
        made.append((len(e.ids), digest(np.array(e.ids, "<u4").tobytes()), digest(decoded.encode())))
    return made


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = queries.op13_bpe_round_trip(spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == dict(zip(texts, expected(texts.values()), strict=True))
    assert len(rows) == len(texts)


def test_nulls_repeated_rows_clashing_names_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "word, " * 50000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS id")
    got = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, t or "") for i, t in rows)
    assert bpe.decode(bpe.encode(frame.limit(0), PATH), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))
