"""Hashes of all words of a text at once.

The hash of a part of a text is the sum of its bytes' terms, byte times a power of a fixed odd number, shifted
back to the part's start; so one running sum gives the hashes of all parts. Such a sum has pairs of texts of
a thousand letters and more that collide whatever the number is. Where different words must not be
taken for each other, :meth:`Text.word_hashes` mixes the bytes of the words themselves, eight at a time.
"""

from __future__ import annotations

import functools

import numpy as np
import xxhash

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.cumprod(made, dtype=np.uint64)


class _Tables:
    size = 0
    up = down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > 1 << 22:  # not kept
            return _powers(_BASE, n), _powers(_INVERSE, n)
        if n > self.size:
            self.size = max(1 << 14, 1 << n.bit_length())
            self.up, self.down = _powers(_BASE, self.size), _powers(_INVERSE, self.size)
        return self.up[:n], self.down[:n]


_tables = _Tables()


class Text:
    """The bytes of a text, the bounds of its words (runs without ASCII white space), hashes of parts."""

    def __init__(self, raw: bytes):
        self.data = np.frombuffer(raw, np.uint8)
        self.space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        solid = np.ones(len(raw) + 2, bool)
        solid[0] = solid[-1] = False
        np.logical_not(self.space, out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self._raw = raw

    @functools.cached_property
    def _running(self) -> tuple[np.ndarray, np.ndarray]:
        up, down = _tables.get(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up[:-1], dtype=np.uint64, out=sums[1:])
        return sums, down

    def parts(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums, down = self._running
        return (sums[ends] - sums[starts]) * down[starts]

    def words(self) -> np.ndarray:
        return self.parts(self.starts, self.ends)

    def word_hashes(self) -> np.ndarray:
        """A hash of each word, made of its bytes; those of up to eight bytes and one length are all different."""
        size = self.ends - self.starts
        padded = self._raw + bytes(16)
        eight = np.ndarray((len(self._raw) + 9,), "<u8", padded, strides=(1,))
        made = _spread((eight[self.starts] & _LOW_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64) * MIX)
        longer = np.flatnonzero(size > 8)
        if len(longer):
            rest = eight[self.starts[longer] + 8] & _LOW_BYTES[np.minimum(size[longer] - 8, 8)]
            made[longer] = _spread(made[longer] ^ _spread(rest + MIX))
            for i in longer[size[longer] > 16].tolist():
                made[i] = xxhash.xxh3_64_intdigest(self._raw[self.starts[i] : self.ends[i]])
        return made


#: Marks of the first bytes of eight, by their number.
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _spread(values: np.ndarray) -> np.ndarray:
    """Spread over all bits; different values stay different."""
    made = values ^ (values >> np.uint64(30))
    made *= np.uint64(0xBF58476D1CE4E5B9)
    made ^= made >> np.uint64(27)
    made *= np.uint64(0x94D049BB133111EB)
    made ^= made >> np.uint64(31)
    return made


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread over all bits."""
    made = hashes ^ (hashes >> np.uint64(32))
    made *= MIX
    made ^= made >> np.uint64(29)
    return made
