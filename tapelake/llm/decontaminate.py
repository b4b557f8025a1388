"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The items are cut into words (ASCII letters lower-cased, everything outside ASCII is a word character), the automaton is
built once per block of items and sent to the tasks. Each document is streamed through it: the state after a word tells
the longest match that ends there. A word that no item holds ends every match, so only the runs of words that items hold
are walked.

Blocks hold at most ``block_words`` item words, so what is broadcast is bounded whatever the size of the item table; the
documents pass each block in turn and the hits are united.

Defined results: a null or empty text, and a null item, has no words; an item of fewer words than ``window`` is one
window; repeated items count by item_id, repeated documents each get a row; an empty table gives an empty result (no
documents) or documents without hits (no items). Other columns, of any name, are not read or are kept as they are.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import fresh, map_batches, utf8

WINDOW = 10
BLOCK_WORDS = 100_000
COVERAGE = 0.8

# Byte -> the same byte lower-cased if it belongs to a word, else a space.
_WORD_BYTES = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences; matches do not run from one item into the next."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        whole: dict[int, int] = {}
        ends: dict[int, set] = {}
        names, texts = [], []
        for name, words in items:
            if not words:
                continue
            number = len(names)
            names.append(name)
            texts.append(words)
            self.shortest = min(self.shortest, len(words))
            state = 0
            for word in words:
                state = self._append(state, self.vocabulary.setdefault(word, len(self.vocabulary) + 1))
                if len(words) >= window:
                    ends.setdefault(state, set()).add(number)
            if len(words) < window:
                whole.setdefault(number, len(words))
        self.names = names
        # A short item is found where its own state, or a state whose suffix it is, is met with that length.
        self.short: dict[int, list[tuple[int, int]]] = {}
        for number, n in whole.items():
            state = self._walk(texts[number])
            self.short.setdefault(state, []).append((n, number))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in order:  # an item that holds a string holds its suffixes
            if (up := self.link[state]) > 0 and state in ends:
                ends.setdefault(up, set()).update(ends[state])
        self.items_at = {s: frozenset(x) for s, x in ends.items() if self.length[s] >= window}
        for state in reversed(order):
            if (up := self.link[state]) > 0 and up in self.short:
                self.short[state] = self.short.get(state, []) + self.short[up]

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][self.vocabulary[word]]
        return state

    def _append(self, last: int, symbol: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if symbol in nxt[last]:
            q = nxt[last][symbol]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, symbol, q)
        new = self._state({}, length[last] + 1, 0)
        p = last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def _split(self, p: int, symbol: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def _state(self, nxt: dict, length: int, link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """The word spans [start, end) of all window occurrences, united, and the names of the items they belong to."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
        spans: list[list[int]] = []
        found: set[int] = set()
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < self.shortest:
                continue
            state = n = 0
            for i, symbol in enumerate(ids[a:b].tolist(), a + 1):
                while state and symbol not in nxt[state]:
                    state = link[state]
                    n = length[state]
                if symbol in nxt[state]:
                    state, n = nxt[state][symbol], n + 1
                hit = 0
                if n >= window:
                    at = state
                    while length[link[at]] >= window:
                        at = link[at]
                    found |= self.items_at[at]
                    hit = window
                for short, number in self.short.get(state, ()):
                    if short <= n:
                        found.add(number)
                        hit = max(hit, short)
                if hit:
                    if spans and i - hit <= spans[-1][1]:
                        spans[-1][0] = min(spans[-1][0], i - hit)
                        spans[-1][1] = i
                        while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                            last = spans.pop()
                            spans[-1] = [min(spans[-1][0], last[0]), max(spans[-1][1], last[1])]
                    else:
                        spans.append([i - hit, i])
        return [(a, b) for a, b in spans], {self.names[k] for k in found}


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what lies between them; the parts left are joined by a line end."""
    is_word = np.frombuffer(text.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], is_word.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : starts[a]])
        at = int(ends[b - 1])
    return b"\n".join(p for p in (x.strip() for x in [*parts, text[at:]]) if p)


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in blocks of bounded size, one after the other; no block is held longer than it takes to use it."""
    block, total = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row["text"].encode() if row["text"] is not None else None)
        if block and total + len(words) > block_words:
            yield block
            block, total = [], 0
        block.append((row["item_id"], words))
        total += len(words)
    yield block


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _scan(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int, n_words: str, hits: str, items: str) -> DataFrame:
    """All columns of ``docs`` and the three named ones."""
    spans = "array<struct<start:int,end:int>>"
    out = docs.withColumns({n_words: F.lit(0).cast("long"), hits: F.array().cast(spans), items: F.array().cast("array<string>")})
    names = out.columns
    for block in item_blocks(benchmark, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(Automaton(block, window))

        def scan(batch: pa.RecordBatch, shared=shared) -> dict:
            automaton = shared.value
            counts, all_hits, all_items = [], [], []
            before = zip(batch.column(hits).to_pylist(), batch.column(items).to_pylist(), strict=True)
            for text, (old_hits, old_items) in zip(utf8(batch, "text"), before, strict=True):
                words = words_of(text)
                found, met = automaton.matches(words)
                counts.append(len(words))
                all_hits.append(_united([(x["start"], x["end"]) for x in old_hits] + found))
                all_items.append(sorted({*old_items, *map(str, met)}))
            return {n: batch.column(n) for n in names} | {n_words: counts, hits: all_hits, items: all_items}

        out = map_batches(out, scan, _ddl(out))
    return out


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text, n_words, hits (word spans) and items (ids of the items met, sorted as strings) of every document."""
    return _scan(docs.select("doc_id", "text"), benchmark, window, block_words, "n_words", "hits", "items")


def _united(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def digest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: how many words are hit, and by which items."""
    found = find(docs, benchmark, window)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without the matched spans.

    Every span of ``window`` words or more (or a whole short item) is cut out; a document that the matches cover to the
    share ``coverage`` or more is dropped, and so is one of which nothing is left. All others keep all their columns.
    """
    names = docs.columns
    n_words, hits, items = fresh("words"), fresh("hits"), fresh("items")
    found = _scan(docs, benchmark, window, block_words, n_words, hits, items)

    def cut(batch: pa.RecordBatch) -> dict:
        keep, texts, sizes = [], [], []
        spans = [[(x["start"], x["end"]) for x in row] for row in batch.column(hits).to_pylist()]
        counts = batch.column(n_words).to_pylist()
        for i, text in enumerate(utf8(batch, "text")):
            size = None
            if spans[i]:
                if sum(b - a for a, b in spans[i]) >= coverage * counts[i] or not (text := without(text, spans[i])):
                    continue
                size = len(text.decode())
            keep.append(i)
            texts.append(text)
            sizes.append(size)
        rest = batch.take(pa.array(keep, pa.int64()))
        out = {n: rest.column(n) for n in names} | {"text": pa.array(texts, pa.binary())}
        if "n_chars" in names:
            out["n_chars"] = [old if new is None else new for old, new in zip(rest.column("n_chars").to_pylist(), sizes, strict=True)]
        return out

    return map_batches(found, cut, _ddl(docs))
