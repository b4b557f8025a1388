"""64-bit hashes of bytes, words and shingles, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random number for each byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1), modulo 2^64; kept, and grown to powers of two."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base][:n]


def forget() -> None:
    """Drops the powers that are kept; they are worked out anew when needed."""
    _POWERS.clear()


class Prefixes:
    """Hashes of any substring of a byte buffer, from one running sum."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers(_BASE, len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = powers(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def windows(self, n: int) -> np.ndarray:
        """Of every substring of n bytes."""
        inverse = powers(_INVERSE, len(self.sums))
        return mix((self.sums[n:] - self.sums[:-n]) * inverse[: len(self.sums) - n])


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without gaps, and each row's place in them (one more than rows); null is empty."""
    texts = column.cast(pa.large_binary()).to_pylist()
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) if t is not None else 0 for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(t for t in texts if t), np.uint8), offsets


#: Byte -> lower-cased if it belongs to a word (ASCII letters and digits, all bytes beyond ASCII), else 0.
WORD_BYTES = np.array([b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0 for b in range(256)], np.uint8)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all rows in order, and how many words each row has."""
    n = len(offsets) - 1
    spaced = np.zeros(len(data) + n, np.uint8)  # a gap after each row, so that no word runs on into the next
    spaced[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = WORD_BYTES[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (spaced > 0).view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    hashes = Prefixes(spaced).of(starts, ends)
    bounds = np.searchsorted(starts, offsets + np.arange(n + 1))
    return hashes, np.diff(bounds)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words of each row, and how many each row has; a row with fewer words has one run of all."""
    ends = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    if len(words) >= size:
        full = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            full = mix(full * np.uint64(_BASE) + words[k : len(words) - size + 1 + k])
        inside = row[size - 1 :] == row[: len(words) - size + 1]
        full, full_row = full[inside], row[: len(words) - size + 1][inside]
    else:
        full, full_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        single = np.zeros(len(short), np.uint64)
        for k in range(size):
            there = counts[short] > k
            at = (ends[short] - counts[short] + k)[there]
            single[there] = mix(single[there] * np.uint64(_BASE) + words[at])
        full, full_row = np.concatenate((full, single)), np.concatenate((full_row, short))
        order = np.argsort(full_row, kind="stable")
        full, full_row = full[order], full_row[order]
    return full, np.bincount(full_row, minlength=len(counts))
