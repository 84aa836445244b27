"""Byte-pair encoding and decoding by a segment tree over the ranks of adjacent pairs.

A piece of a text begins as its bytes' ids. The leaves of a segment tree hold the merge rank of each pair
of neighbours, with the place of the pair; every inner node holds the lesser of its children. So the root
is the pair of lowest rank, the leftmost of those. It is merged, which changes the pair on each side and takes
one away: three leaves and the nodes above them, a logarithm of the piece's length. This goes on until
the root says that no pair can be merged.

The pieces of a batch that its words need are encoded together: trees of the same size are the rows of a
matrix, and a step merges the root's pair of every piece that still has one. A long piece has a tree of
its own. Distinct words are encoded once in a batch, and ids of short ones are kept by the worker.

Decoding puts the bytes of the ids together, and reads them as UTF-8 with a replacement character for what
is none. Special tokens are decoded as their strings.

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows are rows of their
own; an empty table gives none. Texts are encoded whole, whatever their length. The result has the id
column, ids and text only, whatever other columns are called.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seriesmill.llm.common import arrow_rows, documents_only
from seriesmill.llm.tokens import _BYTES, _PIECE, LONGEST_KEPT, Encoder

_LETTER_BYTES = {letter: byte for byte, letter in _BYTES.items()}

#: Pairs of a piece that is encoded in a matrix with others; a longer one has a tree of its own.
LONGEST = 64
#: Leaves of the trees of a matrix.
LEAVES = 1 << 21
#: No merge: above any rank and place.
NONE = np.int64(2**63 - 1)
#: Words kept, some 200 bytes each.
WORDS_KEPT = 250_000
_PLACE = 32


class Merges:
    """The merge rules of a byte-level BPE: rank and result of each pair of ids, and the bytes of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model, step, decoder = config["model"], config["pre_tokenizer"] or {}, config["decoder"] or {}
        flags = ("single_word", "lstrip", "rstrip")
        added = config.get("added_tokens") or []
        if (
            model.get("type") != "BPE" or step.get("type") != "ByteLevel" or decoder.get("type") != "ByteLevel"
            or config["normalizer"] is not None or step.get("add_prefix_space") or not step.get("use_regex", True)
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            or any(t[f] for t in added for f in flags)
        ):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocabulary = model["vocab"]
        self.size = max([*vocabulary.values(), *(t["id"] for t in added)]) + 1
        self.of_byte = np.zeros(256, np.int64)
        self.bytes_of = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(_LETTER_BYTES[ord(c)] for c in token)
        for byte, letter in _BYTES.items():
            self.of_byte[byte] = vocabulary[chr(letter)]
        for token in added:
            self.bytes_of[token["id"]] = token["content"].encode()
        self.added = {t["content"]: t["id"] for t in added}
        rules = [(vocabulary[a] * self.size + vocabulary[b], r, vocabulary[a + b]) for r, (a, b) in enumerate(model["merges"])]
        self.rule = {pair: (rank, made) for pair, rank, made in rules}
        pairs, ranks, results = (np.array(c, np.int64) for c in zip(*rules, strict=True))
        order = np.argsort(pairs)
        self.pairs, self.ranks, self.results = pairs[order], ranks[order], results[order]
        lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def leaves(self, left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What leaves hold: rank and place of the pairs, NONE for those that have no rule."""
        pairs = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, (self.ranks[at] << _PLACE) | places, NONE)

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.results[np.searchsorted(self.pairs, left * self.size + right)]


def encode_long(piece: bytes, merges: Merges) -> list[int]:
    """The ids of one piece, with a tree in a list."""
    ids, n, rule, size = merges.of_byte[np.frombuffer(piece, np.uint8)].tolist(), len(piece), merges.rule, merges.size
    none = int(NONE)
    width = 1 << max(1, (n - 2).bit_length())

    def leaf(i: int, j: int) -> int:
        found = rule.get(ids[i] * size + ids[j])
        return none if found is None else (found[0] << _PLACE) | i

    tree = [none] * (2 * width)
    tree[width : width + n - 1] = [leaf(i, i + 1) for i in range(n - 1)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    while tree[1] != none:
        i = tree[1] & ((1 << _PLACE) - 1)
        j = after[i]
        ids[i] = rule[ids[i] * size + ids[j]][1]
        ids[j] = -1
        after[i] = further = after[j]
        if j < width:
            put(j, none)
        if further < n:
            before[further] = i
            put(i, leaf(i, further))
        else:
            put(i, none)
        if before[i] >= 0:
            put(before[i], leaf(before[i], i))
    return [i for i in ids if i >= 0]


def _encode_matrix(pieces: list[bytes], merges: Merges, width: int) -> list[bytes]:
    """The ids of pieces of 2 to ``width`` + 1 bytes each, a row with its tree for each piece."""
    count = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, count)
    # ids of a row, a place beyond the last one, and the links between those that are left
    ids = np.full((count, width + 2), -1, np.int64)
    inside = np.arange(width + 2) < lengths[:, None]
    ids[inside] = merges.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.tile(np.arange(1, width + 3), (count, 1))
    before = np.tile(np.arange(-1, width + 1), (count, 1))
    tree = np.full((count, 2 * width), NONE, np.int64)
    pair = inside[:, 1 : width + 1]
    places = np.broadcast_to(np.arange(width), (count, width))
    tree[:, width:][pair] = merges.leaves(ids[:, :width][pair], ids[:, 1 : width + 1][pair], places[pair])
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(rows: np.ndarray, at: np.ndarray, values: np.ndarray | np.int64) -> None:
        node = width + at
        tree[rows, node] = values
        while len(node) and node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pairs(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Leaves of pairs; one without a right side, whose id is -1, has no rule."""
        return np.where(
            ids[rows, right] < 0, NONE, merges.leaves(ids[rows, left], np.maximum(ids[rows, right], 0), left)
        )

    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        i = tree[rows, 1] & ((1 << _PLACE) - 1)
        j = after[rows, i]
        further = after[rows, j]
        ids[rows, i] = merges.made(ids[rows, i], ids[rows, j])
        ids[rows, j] = -1
        after[rows, i] = further
        before[rows, np.minimum(further, width + 1)] = i
        there = j < width
        put(rows[there], j[there], NONE)
        put(rows, i, pairs(rows, i, np.minimum(further, width + 1)))
        back = before[rows, i]
        has = back >= 0
        put(rows[has], back[has], pairs(rows[has], back[has], i[has]))
        rows = rows[tree[rows, 1] != NONE]
    left = ids >= 0
    flat, ends = ids[left].astype("<u4"), np.cumsum(left.sum(axis=1))
    return [flat[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def encode_pieces(pieces: list[bytes], merges: Merges) -> list[bytes]:
    """The ids of each piece, as little-endian unsigned 32-bit integers."""
    made: list[bytes] = [b""] * len(pieces)
    by_width: dict[int, list[int]] = {}
    for number, piece in enumerate(pieces):
        if len(piece) < 2:
            made[number] = merges.of_byte[list(piece)].astype("<u4").tobytes()
        elif len(piece) > LONGEST + 1:
            made[number] = np.array(encode_long(piece, merges), "<u4").tobytes()
        else:
            by_width.setdefault(1 << max(1, (len(piece) - 2).bit_length()), []).append(number)
    for width, numbers in by_width.items():
        step = max(1, LEAVES // width)
        for start in range(0, len(numbers), step):
            part = numbers[start : start + step]
            for number, ids in zip(part, _encode_matrix([pieces[n] for n in part], merges, width), strict=True):
                made[number] = ids
    return made


class TreeEncoder(Encoder):
    """Ids by the segment tree; from the library come the pieces of texts beyond Latin letters alone."""

    def __init__(self, path: str):
        super().__init__(path, special=True)
        self.merges = Merges(path)
        self.kept: dict[str, bytes] = {}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.merges.added, key=len, reverse=True))) or r"(?!)")

    def _joined(self, groups: list[list[bytes]]) -> list[bytes]:
        """The ids of groups of pieces; each distinct piece is encoded once."""
        distinct = list(dict.fromkeys(piece for group in groups for piece in group))
        ids = dict(zip(distinct, encode_pieces(distinct, self.merges), strict=True))
        return [b"".join(map(ids.__getitem__, group)) for group in groups]

    def first_ids(self, words: list[str]) -> list[bytes]:
        return self._joined([[p.encode() for p in _PIECE.findall(word)] for word in words])

    def words_ids(self, words: list[str]) -> pa.LargeBinaryArray:
        made = list(map(self.kept.get, words))
        new = [i for i, ids in enumerate(made) if ids is None]
        for i, ids in zip(new, self.first_ids([" " + words[i] for i in new]), strict=True):
            made[i] = ids
            if len(words[i]) <= LONGEST_KEPT and len(self.kept) < WORDS_KEPT:
                self.kept[words[i]] = ids
        return pa.array(made, pa.large_binary())

    def encode(self, text: str | None) -> bytes:
        """The ids of any text; strings of added tokens are cut out first."""
        made, at = [], 0
        for found in self.cut.finditer(text or ""):
            made += [self._part(text[at : found.start()]), np.array([self.merges.added[found[0]]], "<u4").tobytes()]
            at = found.end()
        return b"".join([*made, self._part((text or "")[at:])])

    def _part(self, text: str) -> bytes:
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text) if text else ()
        return self._joined([[bytes(map(_LETTER_BYTES.__getitem__, map(ord, p))) for p, _ in pieces]])[0]

    def decode(self, ids: np.ndarray, starts: Iterable[int]) -> list[str]:
        """The texts of the ids between each two starts, the last one being the end."""
        lengths = self.merges.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.merges.starts[ids] - ends + lengths, lengths) + np.arange(total)
        raw, bounds = self.merges.all_bytes[at].tobytes(), np.r_[0, ends][list(starts)].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.cache
def tree_encoder(path: str) -> TreeEncoder:
    """One encoder in each worker process. The file lies at the same path on every machine."""
    return TreeEncoder(path)


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): little-endian unsigned 32-bit integers of each text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = tree_encoder(tokenizer).encode_batch(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), _binary(ids, starts)], names=["id", "ids"])

    rows = documents_only(docs, id_column, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return arrow_rows(rows, each, f"id {kind}, ids binary").withColumnRenamed("id", id_column)


def _binary(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(ids, "<u4")
    return pa.array([data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())


def decode(encoded: DataFrame, tokenizer: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, ids, text) of encoded rows; null ids are none."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [v or b"" for v in batch.column(1).to_pylist()]
        starts = np.cumsum([0, *(len(v) // 4 for v in values)])
        texts = tree_encoder(tokenizer).decode(np.frombuffer(b"".join(values), "<u4"), starts)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["id", "ids", "text"])

    rows = documents_only(encoded, id_column, ids).toDF("id", "ids")
    kind = rows.schema["id"].dataType.simpleString()
    return arrow_rows(rows, each, f"id {kind}, ids binary, text string").withColumnRenamed("id", id_column)
