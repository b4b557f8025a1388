"""Classes of equal long prefixes, by interval expansion on a Burrows-Wheeler transform, for one block of byte strings."""

from __future__ import annotations

import numpy as np


def _suffix_order(symbols: np.ndarray, stop: np.ndarray, longest: int) -> np.ndarray:
    """Positions in the order of their suffixes; a suffix ends with its string, equal ones stand in the order of strings.

    ``symbols``: 0 where a string ends; ``stop``: for each position, where its string ends.
    """
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(8, np.int64)))
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(7):
        s = padded[j : j + n] * alive
        alive = s > 0
        key = (key << 9) | s
    at, h = np.arange(n), 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)  # separators, the smallest, get 0
        if h >= longest or new[1:].all():
            return np.argsort(rank * n + at)
        ahead = np.minimum(at + h, n - 1)
        key = rank * (n + 1) + np.where(at + h < stop, rank[ahead], 0)
        h *= 2


class _Wavelet:
    """Rank of every symbol in a range at once."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.zeros, self.counts = [], []
        seq = text
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level) & 1
            rank0 = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(1 - bit, out=rank0[1:])
            self.zeros.append(rank0)
            self.counts.append(int(rank0[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))
        all_symbols = np.arange(1 << self.levels)
        base = np.zeros(len(all_symbols), np.int32)
        for k, rank0 in enumerate(self.zeros):
            one = (all_symbols >> (self.levels - 1 - k)) & 1
            base = np.where(one, self.counts[k] + base - rank0[base], rank0[base])
        self.base = base

    def split(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each range and each symbol in it: the symbol, and how often it stands before i and before j."""
        symbol = np.zeros(len(i), np.int32)
        for rank0, zeros in zip(self.zeros, self.counts, strict=True):
            i0, j0 = rank0[i], rank0[j]
            low, high = i0 < j0, (i - i0) < (j - j0)
            i = np.concatenate((i0[low], zeros + (i - i0)[high]))
            j = np.concatenate((j0[low], zeros + (j - j0)[high]))
            symbol = np.concatenate((symbol[low] * 2, symbol[high] * 2 + 1))
        return symbol, i - self.base[symbol], j - self.base[symbol]


def prefix_classes(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which substrings of ``length`` bytes occur more than once: string number, start and class of each occurrence.

    Ranges of the suffix order are extended backwards, breadth first: the ranges of strings of n bytes give those of n + 1,
    and wherever a new range ends for the first time, the suffixes on either side have n bytes in common. The expansion
    stops at ``length``; boundaries that are still open then lie between suffixes with at least that much in common.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    n, m = len(data), len(strings)
    ends = np.cumsum(sizes + 1) - 1
    number = np.repeat(np.arange(m), sizes + 1)
    code = np.zeros(256, np.int64)
    is_end = np.zeros(n, bool)
    is_end[ends] = True
    used = np.unique(data[~is_end])
    code[used] = np.arange(1, len(used) + 1)
    symbols = np.where(is_end, 0, code[data])
    order = _suffix_order(symbols, ends[number], int(sizes.max(initial=0)) + 1)
    before = symbols[order - 1].astype(np.int32)  # the transform; position -1 is the last end
    first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=len(used) + 1))))[: len(used) + 1].astype(np.int32)
    wavelet = _Wavelet(before, len(used) + 1)
    back = np.empty(n, np.int32)
    back[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)

    is_set = np.zeros(n + 1, bool)
    is_set[[0, n]] = True
    lows, highs = [np.array([0], np.int32)], [np.array([n], np.int32)]
    for common in range(length):
        low, high = np.concatenate(lows), np.concatenate(highs)
        if not len(low):
            break
        single = high - low == 1
        alone = low[single]
        alone = back[alone[before[alone] > 0]]
        symbol, a, b = wavelet.split(low[~single], high[~single])
        letter = symbol > 0
        a, b = first[symbol[letter]] + a[letter], first[symbol[letter]] + b[letter]
        low, high = np.concatenate((a, alone)), np.concatenate((b, alone + 1))
        if common == 0:  # every end is a symbol of its own
            low, high = np.concatenate((low, np.arange(m, dtype=np.int32))), np.concatenate((high, np.arange(1, m + 1, dtype=np.int32)))
        open_ = ~is_set[high]
        low, high = low[open_], high[open_]
        is_set[high] = True  # ranges of strings of one length do not overlap, so each boundary is met once
        lows, highs = [low], [high]
    joined = ~is_set[:n]  # a suffix belongs with the one before it
    member = joined.copy()
    member[:-1] |= joined[1:]
    class_of = np.cumsum(~joined)
    at = order[member]
    return number[at], at - (ends - sizes)[number[at]], class_of[member]
