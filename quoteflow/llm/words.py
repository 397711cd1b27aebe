"""Words of many texts at once, as arrays.

Arrow keeps the texts of a batch in one buffer. These functions find the words in it and hash them
with array operations, so that no Python object is made for a word. Work goes in pieces of about
`PIECE` bytes, which bounds the memory whatever the size of a batch; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


class Words(NamedTuple):
    """``hashes`` of all words in order; the words of text i stand from ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # in the bytes of the piece
    ends: np.ndarray
    prefixes: tuple[np.ndarray, ...] = ()  # hashes of beginnings; 0 where a word is not longer

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def byte_table(others: bytes | range, lower: bool = True) -> np.ndarray:
    """What each byte becomes: 0 if it parts words, else itself, A to Z in lower case if ``lower``.

    All bytes of characters beyond ASCII are parts of words, so bytes tell as much as characters.
    """
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(others)] = 0
    return table


# Words between white space: everything but space and the controls 9 to 13.
SPACED = byte_table(b" \t\n\x0b\f\r")
# Words of digits, letters and all beyond ASCII.
ALPHANUMERIC = byte_table([b for b in range(128) if not chr(b).isalnum()])


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets into them) for runs of texts of about ``size`` bytes.

    Null counts as the empty text.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finishing steps of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 1), base & _MASK, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def find_words(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> Words:
    """The words of the texts in ``data``. Equal words, and only they but for chance of 2 ** -64, have equal hashes."""
    mapped = table[data]
    inside = mapped != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = edges[1:] - 1
    stops[lasts] = inside[lasts]
    ends = np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mapped * _power(_BASE, len(data)), out=running[1:], dtype=np.uint64)
    back = _power(pow(_BASE, -1, 1 << 64), len(data))[starts] if len(starts) else np.zeros(0, np.uint64)
    begun = running[starts]
    hashes = mix((running[ends] - begun) * back + np.uint64(1))
    lengths = ends - starts
    short = tuple(
        np.where(lengths > n, mix((running[np.minimum(starts + n, ends)] - begun) * back + np.uint64(n + 1)), 0).astype(np.uint64)
        for n in prefixes
    )
    return Words(hashes, first, starts, ends, short)


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of ``size`` words in a row.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    n = len(words.hashes)
    rolled = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(0xD6E8FEB86659FD93) + words.hashes[k : k + len(rolled)])
    found = []
    for begin, end in zip(words.first[:-1], words.first[1:]):
        if end - begin >= size:
            found.append(np.unique(rolled[begin : end - size + 1]))
        elif end > begin:
            whole = np.full(1, end - begin, np.uint64)
            for word in words.hashes[begin:end]:
                whole = mix(whole * np.uint64(0xA0761D6478BD642F) + word)
            found.append(whole)
        else:
            found.append(np.zeros(0, np.uint64))
    return found
