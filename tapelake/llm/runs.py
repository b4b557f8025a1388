"""Periodic runs of words, found by dyadic square catchers.

A run is a stretch of consecutive words with smallest period q, of at least max(MIN_WORDS, 2q) words, that cannot be made
longer on either side with that period. Every completed block of 2^k words, at a place that 2^k divides, is a catcher: it
waits for its copies at the distances for which a run must hold a block of that size together with its copy. A run of
period p and n words has n - p words with a copy p words on, and any stretch of 2^(k+1) - 1 words holds a whole block, so
the catchers of size 2^k watch the periods with 2^(k+1) - 1 <= max(p, MIN_WORDS - p) < 2^(k+2) - 1. Each appended word
completes one window of every size; in bulk, the windows that all words of a batch complete are held against the few
catchers in reach by their hashes, size by size. Caught squares of one period in consecutive blocks are one repetition.
Since the blocks before and after it failed, comparing less than one block of words on either side finds its ends. The
square merges into a known run if it lies inside one whose period divides its own.

Work is proportional to n log n, memory to the longest text of a task. Words are numbered exactly; blocks are found by
hash, and every repetition is then compared word by word, so no result depends on a hash.

Defined results: words are what lies between spaces and the ASCII controls from tab to carriage return. A null or empty
text has no words and no runs; a null doc_id is allowed; repeated rows each get their result; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapelake.llm.common import map_batches, utf8
from tapelake.llm.hashing import mix

MIN_WORDS = 12
#: Comparisons of windows with catchers that are held at once.
_AT_ONCE = 1 << 21
_STEP = 32


def _levels(least: int, longest: int) -> list[tuple[int, int, int]]:
    """(block size, first period, last period): which catchers watch which periods, by increasing period."""
    out: list[tuple[int, int, int]] = []
    p = 1
    while 2 * p <= longest:
        size = 1 << ((max(p, least - p) + 1).bit_length() - 2)
        last = p
        while 2 * (last + 1) <= longest and 1 << ((max(last + 1, least - last - 1) + 1).bit_length() - 2) == size:
            last += 1
            if last >= least:  # from here on the size follows the period alone
                last = min(4 * size - 2, longest // 2)
                break
        out.append((size, p, last))
        p = last + 1
    return out


def _extent(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in the direction of ``step``, equal the word a period later."""
    n, reach = len(words), np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    offsets = np.arange(_STEP) * step
    while len(active):
        here = at[active, None] + reach[active, None] * step + offsets
        there = here + period[active, None]
        inside = (here >= 0) & (there < n)
        equal = inside & (words[np.where(inside, here, 0)] == words[np.where(inside, there, 0)])
        run = np.where(equal.all(1), _STEP, equal.argmin(1))
        reach[active] += run
        active = active[run == _STEP]
    return reach


def _repeats(words: np.ndarray, start: int, end: int, period: int) -> bool:
    return np.array_equal(words[start : end - period], words[start + period : end])


def _caught(hashes: np.ndarray, blocks: np.ndarray, size: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Period, first block and last block of the chains of consecutive catchers that met their copies at one distance."""
    n, chains = len(hashes), []
    if len(blocks):
        own, gap = hashes[blocks], np.diff(blocks) != size
        for low in range(first, last + 1, max(1, _AT_ONCE // len(blocks))):
            periods = np.arange(low, min(last + 1, low + max(1, _AT_ONCE // len(blocks))))
            met = np.zeros((len(periods), len(blocks)), bool)
            for i, p in enumerate(periods):
                within = np.searchsorted(blocks, n - p)
                met[i, :within] = hashes[blocks[:within] + p] == own[:within]
            if not met.any():
                continue
            begins, finishes = met.copy(), met.copy()
            begins[:, 1:] &= ~met[:, :-1] | gap
            finishes[:, :-1] &= ~met[:, 1:] | gap
            row, a = np.nonzero(begins)
            chains.append((periods[row], blocks[a], blocks[np.nonzero(finishes)[1]]))
    if not chains:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*chains, strict=True))


def runs(words: np.ndarray, sizes: np.ndarray, least: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in consecutive texts of ``sizes`` words, by start and period.

    ``words``: numbers of 0 or more; equal words have equal numbers.
    """
    # A word of its own after each text, so that nothing repeats across it.
    sizes = np.asarray(sizes, np.int64)
    lengths = sizes + 1
    ends = np.cumsum(lengths)
    spaced = np.empty(int(lengths.sum()), np.int64)
    is_end = np.zeros(len(spaced), bool)
    is_end[ends - 1] = True
    spaced[is_end] = -1 - np.arange(len(sizes))
    spaced[~is_end] = words
    of_text = np.repeat(sizes, lengths)

    found: dict[tuple[int, int], int] = {}
    furthest, covering = np.zeros(len(spaced), np.int64), np.zeros(len(spaced), np.int64)
    hashes, width = mix(spaced.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)), 1
    # From larger blocks back to smaller ones the hashes of the smaller are needed again.
    known = {1: hashes}

    def hashed(size: int) -> np.ndarray:
        nonlocal hashes, width
        while width < size:
            hashes = mix(hashes[:-width] * np.uint64(0xD6E8FEB86659FD93) + hashes[width:]) if len(hashes) > width else hashes[:0]
            width *= 2
            if width < least:
                known[width] = hashes
        return hashes if width == size else known[size]

    for size, first, last in _levels(least, int(sizes.max(initial=0))):
        own = hashed(size)
        blocks = np.arange(0, len(own), size)
        blocks = blocks[of_text[blocks] >= max(least, 2 * first)]
        period, a, b = _caught(own, blocks, size, first, last)
        if not len(period):
            continue
        inside = (furthest[a] >= b + size + period) & (period % np.maximum(covering[a], 1) == 0)
        period, a, b = period[~inside], a[~inside], b[~inside]
        starts = a - _extent(spaced, a - 1, period, -1)
        stops = b + size + period + _extent(spaced, b + size, period, 1)
        for p, s, e in sorted(zip(period.tolist(), starts.tolist(), stops.tolist(), strict=True)):
            if e - s < max(least, 2 * p) or (s, e) in found:
                continue
            if furthest[s] >= e and p % covering[s] == 0:
                continue
            if not _repeats(spaced, s, e, p):  # two blocks had one hash: look at every word for this period
                same = np.concatenate(([0], (spaced[:-p] == spaced[p:]).view(np.int8), [0]))
                edges = np.flatnonzero(np.diff(same))
                for x, y in zip(edges[::2].tolist(), (edges[1::2] + p).tolist(), strict=True):
                    if y - x >= max(least, 2 * p):
                        found.setdefault((x, y), p)
                continue
            found[s, e] = p
            further = furthest[s:e] < e
            furthest[s:e][further], covering[s:e][further] = e, p
    return sorted(((s, e, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def _measured(docs: DataFrame, edit: Callable[[int | None, int], np.ndarray | None] | None, columns: str, results: Callable, least: int) -> DataFrame:
    """``results`` (of a text's words and runs) for every document, as columns."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t.split() if t else [] for t in utf8(batch, "text")]  # bytes are split at exactly these six
        ids = batch.column("doc_id").to_pylist()
        if edit is not None:
            for i, t in enumerate(texts):
                if t and (order := edit(ids[i], len(t))) is not None:
                    texts[i] = [t[k] for k in order.tolist()]
        sizes = [len(t) for t in texts]
        flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
        words = flat.indices.to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, np.int64)
        starts = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
        of: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        all_runs = runs(words, sizes, least)
        for i, (s, e, p) in zip(np.searchsorted(starts, [r[0] for r in all_runs], "right") - 1, all_runs, strict=True):
            of[i].append((s - int(starts[i]), e - s, p))
        rows = [results(t, r) for t, r in zip(texts, of, strict=True)]
        return {"doc_id": batch.column("doc_id")} | {n: [row[k] for row in rows] for k, n in enumerate(names)}

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id long, {columns}")


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words, with one period kept of every run."""
    if found:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(words)


def find(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start and period) and collapsed (the text with one period of each)."""

    def results(words, found):
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in found], collapsed(words, found).decode()

    return _measured(docs, None, "runs array<struct<start:long,length:long,period:long>>, collapsed string", results, least)


def digest(docs: DataFrame, edit: Callable[[int | None, int], np.ndarray | None] | None = None, least: int = MIN_WORDS) -> DataFrame:
    """The number of runs, the longest one, and digests of all runs and of the collapsed text of every document.

    ``edit`` gets a doc_id and a number of words; it may return which word stands at each place instead.
    """

    def results(words, found):
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        milli = 1000 * length // period if found else None
        return len(found), start, length, period, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, found)).hexdigest()

    columns = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _measured(docs, edit, columns, results, least)
