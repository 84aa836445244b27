"""Packing: every id in exactly one piece, sequences without gaps, little padding."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from seriesmill.llm import packing, queries, tokens
from seriesmill.llm.common import table
from seriesmill.llm.tokens import Encoder, encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_give_the_ids_of_the_library():
    texts = [
        "", None, "Hello  world\n\n  it's 10 o'clock, don't!", "a\x85b\xa0 c\x1cd \t\n", "École ², ½ ʼn ɏ ɐ",
        "漢字 “quoted” it’s", "''s 're 'REx '", "x" * 3000, " ", "\n \n", "<|endoftext|> a", "ÀÖ×÷ªµº¼¾", "😀 a", "1²3",
    ]
    own = Encoder(PATH)
    for text, ids in zip(texts, plain(texts), strict=True):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text


def check(rows, texts):
    """rows: of pack(); texts: by doc_id, each once."""
    ids = dict(zip(texts, ([*i, 1] for i in plain(texts.values())), strict=True))
    places, sequences = {}, {}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0
        crc = r.ids_crc32 if "ids_crc32" in r else zlib.crc32(r.ids)
        assert crc == zlib.crc32(np.array(part, "<u4").tobytes())
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, want in ids.items():
        at = 0
        for start, length in sorted(places[doc_id]):
            assert start == at
            at += length
        assert at == len(want)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_query_packs_every_id_once(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    check(queries.op2_packing(spark, sf).collect(), texts)


def test_small_shards_and_special_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 5)
    texts = {i: f"word{i} and more " * (i * 7) for i in range(40)} | {100: None, 101: "", 102: "漢 " * 5000}
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in texts.items()], "doc_id long, text string, id int, n int")
    check(packing.pack(frame, PATH).collect(), texts)


def test_neighbours_are_similar():
    rests = [np.array(x, "<u4") for x in ([1, 2, 3, 4], [9, 9, 8], [1, 2, 3, 7], [5, 6])]
    counts = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=10)
    index = packing.Index(rests, counts, 4, 3.25)
    assert index.neighbours(0).tolist() == [0, 2]
    assert index.neighbours(3).tolist() == [3]


def test_nulls_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(None, None), (None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = packing.pack(frame, PATH).collect()
    tokens = len(plain(["a b"])[0]) + 1
    assert sum(r.length for r in rows) == 1 + 3 * tokens
    assert packing.pack(frame.limit(0), PATH).count() == 0


def test_shards_hold_the_neighbours_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    draw = np.random.default_rng(3)
    common = lambda: draw.zipf(1.3, 60) % 300
    topics = [draw.integers(300, 5000, 30) for _ in range(200)]
    # four rests of each topic with half of its terms, far apart in the table
    rests = [np.concatenate([common(), draw.choice(topics[i % 200], 15, False)]).astype("<u4") for i in range(800)]
    counts = np.bincount(np.concatenate([np.unique(r) for r in rests]))
    index = packing.Index(rests, counts, len(rests), float(np.mean([len(r) for r in rests])))
    nearest = [next(int(r) for r in index.neighbours(i) if r != i) for i in range(800)]
    assert np.mean([n % 200 == i % 200 for i, n in enumerate(nearest)]) > 0.9
    rows = [(i, bytearray(packing._narrow(r))) for i, r in enumerate(rests)]
    dealt = packing.shards_by_content(spark.createDataFrame(rows, "row long, rest binary"), counts, len(rests)).collect()
    shard = {r.row: r.shard for r in dealt}
    assert sorted(shard) == list(range(800)) == sorted(r.row for r in dealt)
    assert max(np.unique(list(shard.values()), return_counts=True)[1]) <= 40
    recall = np.mean([shard[i] == shard[n] for i, n in enumerate(nearest)])
    assert recall > 0.7


def test_added_tokens_have_the_ids_of_the_plain_library(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ["<|endoftext|> a", "a b<|endoftext|>", "a <|endoftext|><|endoftext|>\n c", "漢<|endoftext|>", "<|endoftext| >"]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == ids
    assert 50256 in tokenizer.encode(texts[0], add_special_tokens=False).ids
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts[:1])), "doc_id long, text string"), PATH).collect()
    assert b"".join(r.ids for r in sorted(rows, key=lambda r: r.start)) == np.array(
        [*tokenizer.encode(texts[0], add_special_tokens=False).ids, 1], "<u4"
    ).tobytes()


def test_used_rests_are_no_neighbours():
    rests = [np.array(r, "<u4") for r in ([5, 6, 7], [5, 6], [5, 9], [5, 6, 7, 8])]
    counts = np.bincount(np.concatenate(rests), minlength=10)
    index = packing.Index(rests, counts, 4, 2.75)
    every = index.neighbours(0).tolist()
    unused = np.array([True, False, True, True])
    assert 1 in every
    assert index.neighbours(0, unused).tolist() == [r for r in every if r != 1]


def test_links_form_no_ring():
    draw = np.random.default_rng(2)
    rows = draw.permutation(400).astype(np.int64)
    signs = draw.integers(0, 3, (400, packing.HASHES)).astype(">i4")
    signs[100:200] = signs[100]  # copies
    signs[200:210] = packing.NOWHERE  # nothing in common with any other
    best = {}
    for low, high in ((0, 250), (250 - packing.FOLLOWING, 400)):
        of = slice(low, high)
        for one, two, same in zip(*packing.links(rows[of], signs[of], np.zeros(high - low, np.int32)), strict=True):
            assert 0 < same <= packing.HASHES
            best[int(one)] = max(best.get(int(one), (0, -1)), (int(same), int(two)))
    assert len(best) == 390
    for node in best:
        path = [node]
        while (further := best[path[-1]][1]) not in path:
            path.append(further)
        assert further == path[-2]


def test_texts_share_the_pieces_of_their_words(monkeypatch):
    asked = []
    made = tokens._Pieces.made
    monkeypatch.setattr(tokens._Pieces, "made", lambda self, pieces: asked.extend(pieces) or made(self, pieces))
    texts = ["a raremadeupword, raremadeupword.\nraremadeupword", "b raremadeupword; x raremadeupword\n", "c\n", "", None, "d "]
    flat, at = Encoder(PATH, special=True).encode_batch(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain(texts)
    assert asked.count(" raremadeupword") == asked.count("raremadeupword") == 1
