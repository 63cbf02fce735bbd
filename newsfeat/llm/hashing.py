"""Word hashes of many texts at once, inside a task.

A text is a byte string.  The texts of a block lie behind one another in one
array, divided by a line feed; a running sum of ``table[byte] * P**i`` gives
the polynomial hash of every word without a Python step per word.  A hash
depends on the word's bytes alone, never on its place or its block.
Everything is 64-bit arithmetic modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INVERSE = pow(_P, -1, 2**64)

BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: The same with A-Z hashed like a-z.
BYTE_VALUES_LOWER = BYTE_VALUES.copy()
BYTE_VALUES_LOWER[65:91] = BYTE_VALUES[97:123]

#: 1 for the bytes of a word ``[^\x20\x09-\x0D]+``, 0 for its separators.
IS_WORD = np.ones(256, np.uint8)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0

#: 0 for white space, 1 for letters, digits, ``_`` and bytes of longer
#: characters, 2 for the remaining signs.
WORD_OR_SIGN = np.where(IS_WORD == 0, 0, 2).astype(np.uint8)
for _lo, _hi in ((48, 57), (65, 90), (95, 95), (97, 122), (128, 255)):
    WORD_OR_SIGN[_lo:_hi + 1] = 1

_up = _down = np.ones(1, U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if len(_up) < n:
        size = max(n, 2 * len(_up), 1 << 16)
        _up, _down = (np.concatenate([np.ones(1, U64), np.cumprod(np.full(size - 1, base, U64))])
                      for base in (U64(_P), U64(_P_INVERSE)))
    return _up, _down


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow string column; null counts as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges of texts of about ``limit`` bytes together; a longer text
    is a range of its own and is never cut."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


class Block:
    """Runs of equal non-zero class in a block of texts.

    ``start``/``end``: byte ranges of the runs, ``doc``: index of the text of
    each run, ``hash``: its 64-bit hash, ``offset``: first byte of each text.
    """

    def __init__(self, texts: list[bytes], classes: np.ndarray, values: np.ndarray):
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if self.n else np.zeros(0, np.int64)
        kind = classes[self.data]
        change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        edge = np.concatenate([[0], change, [len(kind)]])
        full = kind[edge[:-1]] != 0
        self.start, self.end = edge[:-1][full], edge[1:][full]
        self.doc = np.searchsorted(self.offset, self.start, "right") - 1
        up, self._down = _powers(len(self.data))
        self._sum = np.zeros(len(self.data) + 1, U64)
        np.cumsum(values[self.data] * up[:len(self.data)], out=self._sum[1:])
        self.hash = self.range_hash(self.start, self.end)

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(U64))

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Per text the number of set flags; one flag per byte."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        end = np.concatenate([self.offset[1:] - 1, [len(self.data) - 1]]) if self.n else self.offset
        return total[end] - total[self.offset]


def window_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring word hashes."""
    n = max(0, len(words) - size + 1)
    out = words[:n].copy()
    for k in range(1, size):
        out = out * U64(0xD6E8FEB86659FD93) + words[k:k + n]
    return mix(out)
