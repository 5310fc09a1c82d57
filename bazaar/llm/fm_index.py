"""An FM-index over a shard's words: wavelet-tree ranks, backward search, sampled positions.

All steps work on many phrases or rows at once. Symbols are integers from 1; 0 is for the caller
to part sequences with. Memory is a few bytes for each symbol and bit of the alphabet.
"""

import numpy as np

# Every so many positions of the text have their place stored.
SAMPLE = 16


class Bits:
    """A bit string with ranks: counts of ones up to each word of 64 bits, and a count inside."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.ones = int(ones.sum())

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        word = i >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Ranks of any symbol in a sequence, a bit of the symbol on each level; the nodes of a level
    lie side by side, those of zeros first."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.depth = max(1, int(alphabet - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.depth):
            one = (symbols >> (self.depth - 1 - level)) & 1 != 0
            bits = Bits(one)
            self.levels.append((bits, len(symbols) - bits.ones))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position i."""
        start = np.zeros_like(i)
        for level, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - level)) & 1 != 0
            at, since = bits.rank(i), bits.rank(start)
            i = np.where(one, zeros + at, i - at)
            start = np.where(one, zeros + since, start - since)
        return i - start

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it stands before."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for bits, zeros in self.levels:
            one, at, since = bits.get(i), bits.rank(i), bits.rank(start)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + at, i - at)
            start = np.where(one, zeros + since, start - since)
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order, by doubling; only what is still tied is sorted."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 1
    while True:
        heads = rank[order]
        tied = np.zeros(n, bool)
        tied[1:] = heads[1:] == heads[:-1]
        tied[:-1] |= tied[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order
        rows = order[slots]
        ahead = rows + width
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        key = heads[slots] * (n + 1) + follow + 1  # below 2**63 for any shard in memory
        place = np.argsort(key, kind="stable")
        key, rows = key[place], rows[place]
        order[slots] = rows
        group = np.concatenate([[True], key[1:] != key[:-1]])
        rank[rows] = np.maximum.accumulate(np.where(group, slots, 0))
        width *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int, sample: int = SAMPLE):
        """``text``: integers from 0 to below ``alphabet``."""
        # One above all else: 0 is the end of the text here.
        text = np.concatenate([text.astype(np.int64) + 1, [0]])
        self.size = len(text)
        suffixes = suffix_array(text)
        self.last = WaveletTree(text[suffixes - 1], alphabet + 1)
        counts = np.bincount(text, minlength=alphabet + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        sampled = suffixes % sample == 0
        self.sampled, self.places = Bits(sampled), suffixes[sampled]

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the rows of the suffixes that begin with each phrase.

        ``phrases`` has a phrase in a row, in its last ``lengths`` columns.
        """
        start = np.zeros(len(phrases), np.int64)
        end = np.full(len(phrases), self.size, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (start < end))
            symbol = phrases[live, -back].astype(np.int64) + 1
            start[live] = self.first[symbol] + self.last.rank(symbol, start[live])
            end[live] = self.first[symbol] + self.last.rank(symbol, end[live])
        return start, np.maximum(end, start)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows begin: steps back to the next sampled position."""
        rows = rows.copy()
        places = np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            at = rows[open_]
            found = self.sampled.get(at)
            places[open_[found]] = self.places[self.sampled.rank(at[found])] + steps
            open_, at = open_[~found], at[~found]
            symbol, before = self.last.get(at)
            rows[open_] = self.first[symbol] + before
            steps += 1
        return places
