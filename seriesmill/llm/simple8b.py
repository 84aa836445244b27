"""Simple-8b coding of unsigned integers in 64-bit words, with escapes and blocks.

A word is a selector in the upper four bits and values of one width in the lower sixty. Values are coded
in blocks of 1024, each of which starts a new word, so that a block decodes by itself; values of more
than sixty bits are escapes, kept whole beside the words. Coding and decoding work on all blocks at once.

A segment is, in this order and little-endian: the header, the word offset and the escape offset of each
block and of the end (unsigned 32-bit), the escapes and the words (unsigned 64-bit).
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

BLOCK = 1024
MAGIC = b"S8B1"
#: magic, values, blocks, words, escapes
HEADER = struct.Struct("<4sQIII")

# Width and number of values for each selector. Fixed values; selector 0 is an escape, 1 a run of zeros.
WIDTHS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
_LIMITS = np.array([1 << w for w in WIDTHS[1:]], np.uint64)
_COUNT = np.array(COUNTS, np.int64)
_REACH = max(COUNTS)
#: The first selector whose width holds a value, for values up to the greatest two-byte one.
_CLASSES = (np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right") + 1).astype(np.int8)


def _selectors(classes: np.ndarray) -> np.ndarray:
    """For each place the first selector, so that of most values, into which the values from there fit."""
    rows, width = classes.shape
    most = {1: classes}
    size = 1
    while 2 * size <= _REACH:
        last = most[size]
        wide = last.copy()
        np.maximum(last[:, : width - size], last[:, size:], out=wide[:, : width - size])
        most[2 * size] = wide
        size *= 2
    best = np.zeros((rows, width), np.int8)
    for selector in range(15, 0, -1):
        count = COUNTS[selector]
        size = 1 << (count.bit_length() - 1)
        top = most[size]
        if count > size:
            shift = count - size
            top = top.copy()
            np.maximum(top[:, : width - shift], most[size][:, shift:], out=top[:, : width - shift])
        best[top <= selector] = selector
    return best


def encode(segments: Sequence[np.ndarray]) -> list[bytes]:
    """One coded segment for each array of unsigned integers."""
    sizes = np.array([len(s) for s in segments], np.int64)
    blocks = -(-sizes // BLOCK)
    total = int(blocks.sum())
    if not total:
        return [HEADER.pack(MAGIC, 0, 0, 0, 0) + bytes(8) for _ in segments]
    values = np.zeros((total, BLOCK + _REACH), np.uint64)
    lengths = np.full(total, BLOCK, np.int64)
    ends = np.cumsum(blocks)
    for segment, size, end, n in zip(segments, sizes, ends, blocks, strict=True):
        flat = np.zeros(n * BLOCK, np.uint64)
        flat[:size] = segment
        values[end - n : end, :BLOCK] = flat.reshape(n, BLOCK)
        if n and size % BLOCK:
            lengths[end - 1] = size % BLOCK
    if int(values.max()) < len(_CLASSES):
        classes = _CLASSES[values.view(np.int64)]
    else:
        classes = (np.searchsorted(_LIMITS, values.ravel(), side="right") + 1).astype(np.int8).reshape(values.shape)
    best = _selectors(classes)
    # all blocks advance by one word at a time
    at, alive, steps = np.zeros(total, np.int64), np.arange(total), []
    while len(alive):
        chosen = best[alive, at[alive]]
        steps.append((alive, at[alive], chosen))
        at[alive] += _COUNT[chosen]
        alive = alive[at[alive] < lengths[alive]]
    block, place, selector = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(block * BLOCK + place, kind="stable")
    block, place, selector = block[order], place[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    per_block = np.bincount(block, minlength=total)
    escape = selector == 0
    escapes = values[block[escape], place[escape]]
    escapes_of = np.bincount(block[escape], minlength=total)
    first = np.concatenate([[0], np.cumsum(escapes_of)])
    words[escape] |= (np.arange(len(escapes)) - first[block[escape]]).astype(np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            offsets = np.arange(COUNTS[s])
            part = values[block[mine, None], place[mine, None] + offsets]
            words[mine] |= np.bitwise_or.reduce(part << (offsets * WIDTHS[s]).astype(np.uint64), axis=1)
    word_at = np.concatenate([[0], np.cumsum(per_block)])
    made = []
    for size, end, n in zip(sizes, ends, blocks, strict=True):
        b = end - n
        own = words[word_at[b] : word_at[end]]
        out = escapes[first[b] : first[end]]
        made.append(
            HEADER.pack(MAGIC, size, n, len(own), len(out))
            + (word_at[b : end + 1] - word_at[b]).astype("<u4").tobytes()
            + (first[b : end + 1] - first[b]).astype("<u4").tobytes()
            + out.astype("<u8").tobytes()
            + own.astype("<u8").tobytes()
        )
    return made


def _parts(segment: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    magic, size, blocks, words, escapes = HEADER.unpack_from(segment)
    if magic != MAGIC:
        raise ValueError("no Simple-8b segment")
    at = HEADER.size
    arrays = []
    for kind, n in (("<u4", blocks + 1), ("<u4", blocks + 1), ("<u8", escapes), ("<u8", words)):
        arrays.append(np.frombuffer(segment, kind, n, at))
        at += arrays[-1].nbytes
    return size, *arrays


def decode(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of the blocks ``first`` to before ``last``; of all blocks by default."""
    size, word_at, escape_at, escapes, words = _parts(segment)
    last = len(word_at) - 1 if last is None else last
    if first >= last:
        return np.empty(0, np.uint64)
    words = words[word_at[first] : word_at[last]]
    block = np.repeat(np.arange(last - first), np.diff(word_at[first : last + 1].astype(np.int64)))
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[selector]
    start = np.cumsum(count) - count
    new = np.r_[True, block[1:] != block[:-1]]
    place = start - start[np.flatnonzero(new)][block]
    out = np.zeros((last - first, BLOCK + _REACH), np.uint64)
    low = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == 0:
            out[block[mine], place[mine]] = escapes[escape_at[first + block[mine]] + low[mine].astype(np.int64)]
        elif s > 1:
            offsets = np.arange(COUNTS[s])
            part = (low[mine, None] >> (offsets * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << WIDTHS[s]) - 1)
            out[block[mine, None], place[mine, None] + offsets] = part
    flat = out[:, :BLOCK].ravel()
    return flat[: min(size - first * BLOCK, (last - first) * BLOCK)]
