"""Token ids of whole texts by the tokenizers library.

A byte-level BPE cuts a text into pieces by a pattern and encodes each piece by itself. So the ids of a
piece are had from the library's model once and kept; a text is the sequence of its pieces' ids. Where a
text holds letters beyond Latin ones, or with a tokenizer of another kind, the library gets the whole text.

A batch of texts is split at its spaces and dictionary-encoded at once: each distinct word of the batch is
cut into pieces, each distinct piece looked up a single time, and the ids of words and texts are put together by index.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept, some 200 bytes each, and the longest one that is kept, in characters.
PIECES_KEPT, LONGEST_KEPT = 500_000, 40
#: Bytes of a batch that small batches are put together to.
GROUP_BYTES = 8 << 20

# The pieces of byte-level BPE below U+0250. The pattern's letters, numbers and white space there.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\\t-\\r \u0085 "
_PIECE = re.compile(
    f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
_BEYOND = re.compile("[^\x00-ɏ]")
#: The first byte in UTF-8 of U+0240: no lesser byte begins a letter beyond U+024F.
_BEYOND_BYTE = 0xC9


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte: itself if it is printed, else the next one from U+0100."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return dict(zip(printed, printed, strict=True)) | {b: 256 + i for i, b in enumerate(others)}


_BYTES = _byte_letters()
#: The letter of each byte, in UTF-16.
_LETTER_OF = np.array([_BYTES[b] for b in range(256)], "<u2")


#: Beside other white space a space may be part of a longer piece; texts with these go by pieces.
_OTHER_SPACES = "\t\x0b\x0c\r\x85\xa0"
_NEAR_SPACES = ("  ", "\n ", " \n")


_ID = operator.attrgetter("id")


class _Pieces(dict):
    """Ids of pieces by the tokenizer's model, little-endian unsigned 32-bit integers."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        made = self.made([piece])[0]
        if len(piece) <= LONGEST_KEPT and len(self) < PIECES_KEPT:
            self[piece] = made
        return made

    def made(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, whether it is known or not."""
        raw = list(map(str.encode, pieces))
        letters = _LETTER_OF[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-16-le")
        ends = list(itertools.accumulate(map(len, raw), initial=0))
        # tokens are let go at once: many objects held would be gone through by the garbage collector again and again
        ids: list[int] = []
        sizes, tokenize = [], self.model.tokenize
        for a, b in itertools.pairwise(ends):
            found = tokenize(letters[a:b])
            sizes.append(len(found))
            ids.extend(map(_ID, found))
        return _slices(ids, sizes)

    def of_all(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; unknown ones are made together, and kept as far as there is room."""
        found = list(map(self.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        unknown = [pieces[i] for i in new]
        made = self.made(unknown)
        for i, ids in zip(new, made, strict=True):
            found[i] = ids
        if (room := PIECES_KEPT - len(self)) > 0:
            kept = ((piece, ids) for piece, ids in zip(unknown, made, strict=True) if len(piece) <= LONGEST_KEPT)
            self.update(itertools.islice(kept, room))
        return found


def _near(data: np.ndarray) -> bool:
    """Whether UTF-8 has one of _NEAR_SPACES."""
    space = data == ord(" ")
    white = data == ord("\n")
    white |= space
    return bool((space[1:] & white[:-1]).any() or (white[1:] & space[:-1]).any())


def _strings(values: pa.Array) -> list[str]:
    """The values, made by Arrow at once; ``to_pylist`` goes one by one."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _slices(ids: list[int], sizes: list[int]) -> list[bytes]:
    """The ids cut into parts of these sizes."""
    raw = np.array(ids, "<u4").tobytes()
    ends = itertools.accumulate((4 * size for size in sizes), initial=0)
    return [raw[a:b] for a, b in itertools.pairwise(ends)]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    With ``special`` the strings of special tokens in a text give their ids, as the library has it unless told
    otherwise; else they are ordinary text.
    """

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.pieces = _Pieces(self.tokenizer.model)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        #: Strings that the library cuts out of a text before its pieces.
        self.added = [t["content"] for t in config.get("added_tokens") or () if special or not t["special"]]
        step = config["pre_tokenizer"] or {}
        self.by_pieces = (
            sys.byteorder == "little"
            and config["normalizer"] is None
            and step.get("type") == "ByteLevel"
            and step.get("use_regex", True)
            and not step.get("add_prefix_space", True)
            and not config["model"].get("ignore_merges")
        )

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_pieces or _BEYOND.search(text) or any(token in text for token in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        if any(c in text for c in _OTHER_SPACES) or any(pair in text for pair in _NEAR_SPACES):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text)))
        # no piece goes on over a space that follows something else
        first, *words = text.split(" ")
        distinct = list(dict.fromkeys(words))
        ids = dict(zip(distinct, self.words_ids(distinct).to_pylist(), strict=True))
        return self.first_ids([first])[0] + b"".join(map(ids.__getitem__, words))

    def first_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words without a space in front."""
        return [b"".join(map(self.pieces.__getitem__, _PIECE.findall(word))) for word in words]

    def words_ids(self, words: list[str]) -> pa.LargeBinaryArray:
        """Ids of distinct words with a space in front: all are cut into pieces in one go, and put together by index."""
        pieces = pa.array(_PIECE.findall(" " + " ".join(words)) if words else [], pa.string()).dictionary_encode()
        which = pieces.indices.to_numpy()
        heads = np.flatnonzero(pc.starts_with(pieces.dictionary, " ").to_numpy(zero_copy_only=False)[which])
        if len(heads) != len(words):  # white space of two words became one piece
            return pa.array(self.first_ids([" " + word for word in words]), pa.large_binary())
        ids = pa.array(self.pieces.of_all(_strings(pieces.dictionary)), pa.large_binary()).take(pieces.indices)
        _, ends, flat = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1)[np.r_[heads, len(ids)]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), flat])

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a batch, and where those of each begin, with the end of the last."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        odd = self._odd(texts)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        words = pc.split_pattern(plain, " ")
        first = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
        flat = words.flatten()
        coded = flat.dictionary_encode()
        known = len(coded.dictionary)
        firsts = self.first_ids(_strings(flat.take(pa.array(first))))
        for i in np.flatnonzero(odd).tolist():
            firsts[i] = self.encode(texts[i].as_py())
        which = coded.indices.to_numpy().astype(np.int64)
        which[first] = known + np.arange(len(first))
        made = pa.concat_arrays([self.words_ids(_strings(coded.dictionary)), pa.array(firsts, pa.large_binary())])
        ids = made.take(pa.array(which))
        _, ends, flat = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1) // 4
        return np.frombuffer(flat, "<u4", int(ends[-1])), np.r_[ends[first], ends[-1]]

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts can't be split at their spaces."""
        raw = b"\n".join(texts.cast(pa.binary()).to_pylist())
        data = np.frombuffer(raw, np.uint8)
        strings = [*_OTHER_SPACES, *_NEAR_SPACES, *self.added]
        beyond = bool((data >= _BEYOND_BYTE).any())
        # a byte is found much faster than two
        others = (s.encode() for s in (*_OTHER_SPACES, *self.added))
        if self.by_pieces and not beyond and not _near(data) and not any(s[:1] in raw and s in raw for s in others):
            return np.zeros(len(texts), bool)
        return np.array(
            [
                not self.by_pieces or bool(_BEYOND.search(t)) or any(s in t for s in strings)
                for t in texts.to_pylist()
            ],
            bool,
        )


def grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of GROUP_BYTES or a little more; a word is looked up once in each of them."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder in each worker process. The file lies at the same path on every machine."""
    return Encoder(path, special=True)
