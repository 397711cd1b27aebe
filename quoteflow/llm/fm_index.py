"""A full-text index of word sequences: Burrows-Wheeler transform, wavelet ranks, sampled suffixes."""

from __future__ import annotations

import numpy as np

# Every so many text positions the index knows the place of a suffix.
SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in sorted order, by prefix doubling.

    After each doubling only suffixes that still tie with others are sorted again.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranks = np.empty(n, np.int64)
    sorted_text = text[order]
    heads = np.flatnonzero(np.append(True, sorted_text[1:] != sorted_text[:-1]))
    sizes = np.diff(np.append(heads, n))
    ranks[order] = np.repeat(heads, sizes)
    open_ = np.repeat(sizes > 1, sizes)
    step = 1
    while open_.any():
        slots = np.flatnonzero(open_)
        places = order[slots]
        after = places + step
        follow = np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        group = ranks[places]
        # Suffixes stay in the slots of their group: sort by (group, rank of what follows).
        if n < 1 << 21:
            packed = np.sort((group << 42) | (follow << 21) | places)
            places, follow, group = packed & ((1 << 21) - 1), (packed >> 21) & ((1 << 21) - 1), packed >> 42
        else:
            by = np.lexsort((follow, group))
            places, follow, group = places[by], follow[by], group[by]
        order[slots] = places
        new = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(slots)))
        ranks[places] = np.repeat(slots[heads], sizes)
        open_[slots] = np.repeat(sizes > 1, sizes)
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit of all symbols per level, with running counts of ones."""

    def __init__(self, sequence: np.ndarray, alphabet: int):
        self.n = len(sequence)
        self.levels = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bits = (sequence >> level) & 1
            running = np.zeros(self.n + 1, np.int32)
            np.cumsum(bits, out=running[1:])
            self.ones.append(running)
            self.zeros.append(self.n - int(running[-1]))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        begin = np.zeros(len(symbols), np.int64)
        end = upto.astype(np.int64)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbols >> (self.levels - 1 - k)) & 1 == 1
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at positions."""
        at, found = at.astype(np.int64), np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            found = (found << 1) | bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return found


class FMIndex:
    """Finds all occurrences of sequences of symbols in a text of symbols from 0 to ``alphabet - 1``.

    Symbol 0 parts documents and is in no sequence that is searched.
    """

    def __init__(self, text: np.ndarray, alphabet: int):
        text = np.append(text.astype(np.int64), 0)
        order = suffix_array(text)
        self.n = len(text)
        self.ranks = WaveletMatrix(text[order - 1], alphabet)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        sampled = order % SAMPLE == 0
        self.sampled_rows = np.zeros(self.n + 1, np.int32)
        np.cumsum(sampled, out=self.sampled_rows[1:])
        self.samples = order[sampled]

    def search(self, sequences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last of the suffixes that begin with each of the sequences.

        ``sequences`` has one in each line, of equal lengths.
        """
        first = np.zeros(len(sequences), np.int64)
        last = np.full(len(sequences), self.n, np.int64)
        alive = np.arange(len(sequences))
        for k in reversed(range(sequences.shape[1])):
            symbols = sequences[alive, k]
            first[alive] = self.before[symbols] + self.ranks.rank(symbols, first[alive])
            last[alive] = self.before[symbols] + self.ranks.rank(symbols, last[alive])
            alive = alive[first[alive] < last[alive]]
        return first, np.maximum(first, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of rows: steps back to sampled suffixes, whose places are known."""
        rows = rows.astype(np.int64)
        found = np.zeros(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            at = rows[left]
            known = self.sampled_rows[at + 1] > self.sampled_rows[at]
            found[left[known]] = self.samples[self.sampled_rows[at[known]]] + steps
            left, at = left[~known], at[~known]
            symbols = self.ranks.access(at)
            rows[left] = self.before[symbols] + self.ranks.rank(symbols, at)
            steps += 1
        return found
