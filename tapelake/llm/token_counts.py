"""Token counts of a unigram tokenizer without building its tokens: Aho-Corasick and a count-only Viterbi.

An Aho-Corasick automaton over the vocabulary gives all pieces that end at each character of a word; dynamic programming
carries, for each character, the best score of a way there and how many pieces it has. Ties follow the tokenizer: of equal
scores the piece that starts first wins, and an unknown character, tried only where no piece is that one character, wins
only if it is strictly better. Unknown characters count as their bytes where the vocabulary has all bytes, and otherwise a
run of them counts as one. The distinct words of a batch that are not known yet are worked out together: one run of the
automaton over all of them, then one step for each character place, in which all words are carried on at once.

Words are what lies between white space, with the word mark in front; white space itself has no token. The vocabulary and
its scores are parameters.

Defined results: a null or empty text has no tokens; repeated rows each get their count; an empty table gives an empty
result; other columns are not read. Counting is a map: no shuffle, and a cache of bounded size.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapelake.llm.common import map_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words of one generation; two are kept.
CACHED_WORDS = 200_000
#: Words that are worked out at once, and the length beyond which a word is worked out alone.
_AT_ONCE = 20_000
_LONG = 400

# Unicode white space; Python's own notion has the four ASCII separators too.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_MARKED = re.compile(f"{MARK}[^{MARK}]*")  # a mark inside a word starts a new one
_SEPARATORS = re.compile("[\x1c-\x1f]")


def zipf_vocabulary(model: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece file, scored by rank as if their frequencies followed Zipf's law."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(pieces.id_to_piece(i), -math.log(i + 2)) for i in range(pieces.vocab_size())]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]], cached: int = CACHED_WORDS):
        self.pieces = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        names = {piece: score for piece, score in vocabulary if piece}  # of a piece given twice the last score holds
        for i, piece in enumerate(names):
            self.pieces.add_word(piece, i)
        self.pieces.make_automaton()
        self.sizes = np.array([len(piece) for piece in names], np.int64)
        self.scores = np.array([*names.values()], np.float64)
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.has_bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.cached = cached
        #: Words of this generation and of the one before; a word that is met again moves up.
        self.known: dict[str, tuple[int, float]] = {}
        self.older: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best way through one word, character by character."""
        n = len(word)
        best, count, start = [0.0] + [-math.inf] * n, [0] * (n + 1), [0] * (n + 1)
        single, unknown = [False] * (n + 1), [False] * (n + 1)
        closed = 0

        def close(end: int) -> None:
            if not single[end] and (s := best[end - 1] + self.unknown) > best[end]:
                best[end], unknown[end] = s, True
                if self.has_bytes:
                    count[end] = count[end - 1] + len(word[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not unknown[end - 1])

        sizes, scores = self.sizes, self.scores
        for last, piece in self.pieces.iter(word):
            size, score = int(sizes[piece]), float(scores[piece])
            end = last + 1
            while closed < last:
                closed += 1
                close(closed)
            at = end - size
            s = best[at] + score
            if s > best[end] or s == best[end] and at < start[end]:
                best[end], count[end], start[end] = s, count[at] + 1, at
            single[end] |= size == 1
        while closed < n:
            closed += 1
            close(closed)
        return count[n], best[n]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for many words at once: one run of the automaton, then one step for each character place."""
        n = len(words)
        text = "\n".join([*words, ""])
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        length = np.diff(np.concatenate(([-1], np.flatnonzero(points == 10)))) - 1
        offset = np.cumsum(length + 1) - (length + 1)  # a word's place in the text, and of its first state
        of = np.repeat(np.arange(n), length + 1)
        met = np.fromiter(chain.from_iterable(self.pieces.iter(text)), np.int64).reshape(-1, 2)
        last, piece = met[:, 0], met[:, 1]
        size, word = self.sizes[piece], of[last]
        end = last - offset[word] + 1
        inside = (size <= end) & (end <= length[word])
        end, size, word, piece = end[inside], size[inside], word[inside], piece[inside]
        order = np.lexsort((-size, word, end))  # at each place by word, the piece that starts first in front
        end, size, word, score = end[order], size[order], word[order], self.scores[piece[order]]
        state = offset[word] + end
        from_ = state - size
        best, count, unknown = np.zeros(len(text)), np.zeros(len(text), np.int64), np.zeros(len(text), bool)
        single = np.zeros(len(text), bool)
        single[state[size == 1]] = True
        by_length = np.argsort(-length, kind="stable")
        longest = int(length.max(initial=0))
        alive = np.searchsorted(-length[by_length], -np.arange(longest + 1), "right")  # words with so many characters
        bounds = np.searchsorted(end, np.arange(longest + 2))
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        for place in range(1, longest + 1):
            here = offset[by_length[: alive[place]]] + place
            best[here] = -np.inf
            a, b = bounds[place], bounds[place + 1]
            if a < b:
                to, source = state[a:b], from_[a:b]
                reached = best[source] + score[a:b]
                first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
                top = np.maximum.reduceat(reached, first)
                group = np.repeat(np.arange(len(first)), np.diff(np.append(first, b - a)))
                won = np.flatnonzero(reached == top[group])
                won = won[np.concatenate(([True], group[won[1:]] != group[won[:-1]]))]
                best[to[won]], count[to[won]] = reached[won], count[source[won]] + 1
            left = best[here - 1] + self.unknown
            lost = ~single[here] & (left > best[here])
            at = here[lost]
            best[at], unknown[at] = left[lost], True
            count[at] = count[at - 1] + (width[at - 1] if self.has_bytes else ~unknown[at - 1])
        return count[offset + length], best[offset + length]

    def _learn(self, new: list[str]) -> None:
        """Works out words that are not known."""
        parts = [_MARKED.findall(w) if MARK in w else [MARK + w] for w in (w if w.startswith(MARK) or MARK not in w else MARK + w for w in new)]
        flat = [*chain.from_iterable(parts)]
        long_ = np.array([len(p) > _LONG for p in flat], bool)
        short = [p for p in flat if len(p) <= _LONG]
        counts, scores = np.zeros(len(flat), np.int64), np.zeros(len(flat))
        for i in np.flatnonzero(long_).tolist():
            counts[i], scores[i] = self.word(flat[i])
        places = np.flatnonzero(~long_)
        for at in range(0, len(short), _AT_ONCE):
            there = places[at : at + _AT_ONCE]
            counts[there], scores[there] = self.words(short[at : at + _AT_ONCE])
        first = np.cumsum([0] + [len(x) for x in parts])[:-1]
        if len(first):
            counts, scores = np.add.reduceat(counts, first), np.add.reduceat(scores, first)
        self.known.update(zip(new, zip(counts.tolist(), scores.tolist(), strict=True), strict=True))

    def texts(self, texts: list[str | None]) -> list[tuple[int, float]]:
        """Pieces and score of every text; each distinct word of them is looked up once."""
        split = [(t.split() if not _SEPARATORS.search(t) else [w for w in _SPACE.split(t) if w]) if t else [] for t in texts]
        known, older = self.known, self.older
        distinct = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        new = []
        for w in distinct:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    new.append(w)
        self._learn(new)
        ways = [known[w] for w in distinct]
        counts, scores = np.array([n for n, _ in ways], np.int64), np.array([s for _, s in ways], np.float64)
        places = np.fromiter(map(distinct.__getitem__, chain.from_iterable(split)), np.int64)
        of = np.repeat(np.arange(len(split)), [len(words) for words in split])
        total = np.bincount(of, counts[places], len(split)).astype(np.int64)  # exact: far below 2^53
        score = np.bincount(of, scores[places], len(split))
        if len(known) > self.cached:
            self.known, self.older = {}, known
        return [*zip(total.tolist(), score.tolist(), strict=True)]

    def text(self, text: str | None) -> tuple[int, float]:
        return self.texts([text])[0]


_COUNTERS: dict = {}


def count(docs: DataFrame, model: str, vocabulary=zipf_vocabulary) -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation of every document."""

    def run(batch: pa.RecordBatch) -> dict:
        key = model, vocabulary.__name__
        if key not in _COUNTERS:
            _COUNTERS[key] = Counter(vocabulary(model))
        found = _COUNTERS[key].texts(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "n_tokens": [n for n, _ in found], "score": [s for _, s in found]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, score double")
