"""Hierarchical packing into windows of several lengths.

Documents are tokenised and routed to the shortest tier (context size) that holds them; a longer one is cut into windows
of the longest tier, and its rest is routed. Within a pool of documents each tier is packed from the longest down: the
largest document that fits goes first, the gap a window keeps is filled from the shorter tiers, and at last by cutting a
document of the shortest tier that has any. So every window but the last few of a task is full. What a task has left at
its end is cut into full windows of shorter tiers, and at most one window per task, shorter than the shortest tier, is
padded. Windows are then dealt into step groups, longest first to the group with the fewest tokens, which makes
the groups equally long to within a window.

Packing is a map over the partitions of the input: no shuffle, a pool of bounded size in memory, and the same result when
a lost task runs again.

Defined results: a null or empty text has only the end token; repeated rows are packed each for itself; an empty table
gives an empty result; other columns are ignored. A document is cut wherever a window ends; each id lies in one piece.
"""

from __future__ import annotations

import bisect
import heapq
import operator
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tapelake.llm.common import pieces, resting, utf8, without_collections

TIERS = (256, 512, 1024, 2048)
POOL_TOKENS = 2_000_000
STEP_TOKENS = 32_768
END_ID = 1
CACHED_WORDS = 750_000
#: Runs of letters that are encoded as one text.
RUNS = 20_000
_TO_SPACE = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")


class Recent:
    """A mapping in two generations: what is used goes to the new one, and when that is full the old one is forgotten."""

    def __init__(self, most: int):
        self.most, self.now, self.before = most, {}, {}

    def missing(self, keys: set) -> set:
        """The keys that neither generation has; those of the old one are in the new one afterwards."""
        out = keys.difference(self.now)
        old = out.intersection(self.before)
        self.now.update(zip(old, map(self.before.__getitem__, old), strict=True))
        return out - old

    def turn(self) -> None:
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now


def _latin(word: str) -> bool:
    """Whether a word has only characters below U+0250 and no capital I with a dot: each is composed, and lower case is one character."""
    return word.isascii() or (max(word) < "\u0250" and "\u0130" not in word)


class WordIds:
    """Token ids of a text as bytes of little-endian unsigned 32-bit integers, by way of the words between spaces.

    For tokenizers that split a text into letter runs, digits and symbol runs, drop white space, take no notice of case and
    mark the last piece of each run: a text's ids are then its words' ids, one after the other. Each distinct word is looked
    up once; words that differ in case or in a full stop or comma at the end share the encoding of their stem; and stems
    of letters only are encoded many at a time and told apart by the end mark, Latin ones without being made normal again.
    """

    END_MARK = "</w>"

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core of its own and no more
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Lower-case Latin letters are normal already, and runs of them end at spaces.
        at_spaces, as_bytes = pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain, self.latin = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer, self.latin.pre_tokenizer = at_spaces, pre_tokenizers.Sequence([at_spaces, as_bytes])
        self.known, self.stems = Recent(cached), Recent(cached)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_run = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_run[[i for token, i in vocabulary.items() if token.endswith(self.END_MARK)]] = True
        self.tails = {c: self._each([c])[0] for c in ".,"}

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _runs(self, stems: list[str], tokenizer) -> list[bytes]:
        """Of stems that are one run of letters each."""
        ids = np.array(tokenizer.encode_batch_fast([" ".join(stems)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_run[ids]) + 1
        if len(ends) != len(stems):  # a letter whose lower case is not one run
            return self._each(stems)
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _learn(self, words: set[bytes]) -> None:
        if not words:
            return
        stems, order = self.stems, list(words)
        texts = b" ".join(order).decode().split(" ")
        cut = [text[:-1] if text[-1] in ".," and text[:-1].isalpha() else text for text in texts]
        tails = [b"" if stem is text else self.tails[text[-1]] for stem, text in zip(cut, texts, strict=True)]
        names = [stem.lower() if _latin(stem) else stem for stem in cut]
        missing = stems.missing(set(names))
        plain, latin, letters, others = [], [], [], []
        for stem in missing:
            (others if not stem.isalpha() else plain if stem.isascii() else latin if _latin(stem) else letters).append(stem)
        for runs, tokenizer in ((plain, self.plain), (latin, self.latin), (letters, self.tokenizer)):
            for i in range(0, len(runs), RUNS):
                stems.now.update(zip(runs[i : i + RUNS], self._runs(runs[i : i + RUNS], tokenizer), strict=True))
        stems.now.update(zip(others, self._each(others), strict=True))
        self.known.now.update(zip(order, map(operator.add, map(stems.now.__getitem__, names), tails), strict=True))
        stems.turn()

    def rest(self) -> None:
        """A worker that waits for its next task, perhaps beside other work, holds no words."""
        self.known, self.stems = Recent(self.known.most), Recent(self.stems.most)
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The words of all texts at once: each distinct one is looked up once, its ids are copied to all its places."""
        data = b" ".join([*[t or b"" for t in texts], b""]).translate(_TO_SPACE)
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord(" ")) + 1
        bounds = np.concatenate([[0], ends]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        _, bounds, values = words.dictionary.buffers()
        distinct = values.to_pybytes()[: int(np.frombuffer(bounds, np.int64, len(words.dictionary) + 1)[-1])].split(b" ")[:-1]
        self._learn(self.known.missing({*distinct} - {b""}))
        self.known.now[b""] = b""
        found = [self.known.now[word] for word in distinct]
        self.known.turn()
        flat, sizes, place = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4, words.indices.to_numpy()
        n = sizes[place]
        stops = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[place] - stops[:-1], n) + np.arange(stops[-1])].tobytes()
        # A text's last word is the one that ends where the text does.
        text_ends = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)
        cuts = [0, *(4 * stops[np.searchsorted(ends, text_ends, "right")]).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_ENCODERS: dict[tuple[str, int], WordIds] = {}


def encoder(path: str, cached: int = CACHED_WORDS) -> WordIds:
    """One per Python worker, file and size."""
    if (path, cached) not in _ENCODERS:
        _ENCODERS[path, cached] = WordIds(path, cached)
    return _ENCODERS[path, cached]


class Packer:
    """Packs (document, ids) pools of one task; yields windows, each a list of (document, start, stop)."""

    def __init__(self, tiers=TIERS):
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        self.waiting: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}  # (length, document, start)
        self.tokens = 0

    def add(self, document: int, n: int):
        """Full windows that the document fills alone; its rest waits in its tier."""
        start = 0
        while n - start >= self.longest:
            yield self.longest, [(document, start, start + self.longest)]
            start += self.longest
        if n > start:
            rest = n - start
            self.waiting[self.tiers[bisect.bisect_left(self.tiers, rest)]].append((rest, document, start))
            self.tokens += rest

    def pack(self, last: bool = False):
        """Windows from what waits; unless ``last``, what does not fill a window waits on."""
        for t in self.tiers:
            self.waiting[t].sort()
        for at in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[at]
            while self.waiting[tier]:
                if not last and self.tokens < tier:
                    return
                window, room = [], tier
                while room and self.tokens:
                    piece = self._take(at, room)
                    window.append((piece[1], piece[2], piece[2] + piece[0]))
                    room -= piece[0]
                    self.tokens -= piece[0]
                if room:  # only when nothing waits any more
                    yield from self._shorter(window, tier - room)
                else:
                    yield tier, window

    def _take(self, at: int, room: int) -> tuple[int, int, int]:
        """The longest waiting piece of tier ``at`` or below that fits, else a part of the shortest piece there is."""
        for k in range(at, -1, -1):
            pieces_ = self.waiting[self.tiers[k]]
            i = bisect.bisect_right(pieces_, (room, 1 << 62, 0)) - 1
            if i >= 0:
                return pieces_.pop(i)
        n, document, start = next(self.waiting[self.tiers[k]] for k in range(len(self.tiers)) if self.waiting[self.tiers[k]]).pop(0)
        self._wait(n - room, document, start + room)
        return room, document, start

    def _wait(self, n: int, document: int, start: int) -> None:
        bisect.insort(self.waiting[self.tiers[bisect.bisect_left(self.tiers, n)]], (n, document, start))

    def _shorter(self, window, n: int):
        """A partly filled window as full windows of shorter tiers and one rest."""
        while n:
            size = max((t for t in self.tiers if t <= n), default=n)
            part, need = [], size
            while need:
                document, start, stop = window[0]
                take = min(need, stop - start)
                part.append((document, start, start + take))
                window[0] = (document, start + take, stop)
                if start + take == stop:
                    window.pop(0)
                need -= take
            n -= size
            yield size, part


def _balanced(windows: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """The step group of each window: longest first, to the group with the fewest tokens."""
    groups = max(1, -(-sum(n for n, _ in windows) // step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i][0]):
        n, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (n + windows[i][0], g))
    return out


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " window long, step_id long, ids array<int>"
)


def pack(docs: DataFrame, tokenizer: str, tiers=TIERS, pool_tokens: int = POOL_TOKENS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID, with_ids: bool = True, cached_words: int = CACHED_WORDS, keep_words: bool = True) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence, with its ids if asked for.

    window: the tier of the sequence, or its own length if it is a task's last and shorter than all tiers. step_id: the step
    group. sequence_id and step_id hold the partition in their upper bits. ``cached_words``: the words of a generation of a
    worker's cache, about 300 bytes each; ``keep_words``: whether a worker keeps them for its next task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        packer, held = Packer(tiers), {}  # document number -> [doc_id, ids, tokens not given out yet]
        count = {"document": 0, "sequence": 0, "step": 0}
        encode = encoder(tokenizer, cached_words)

        def rows(windows):
            groups = _balanced(windows, step_tokens)
            out: list[tuple] = []
            for (window, parts), group in zip(windows, groups, strict=True):
                offset = 0
                for document, start, stop in parts:
                    doc = held[document]
                    ids = doc[1][4 * start : 4 * stop]
                    out.append((doc[0], start, stop - start, zlib.crc32(ids), len(doc[1]) // 4, base + count["sequence"], offset, window, base + count["step"] + group, ids))
                    offset += stop - start
                    doc[2] -= stop - start
                    if not doc[2]:
                        del held[document]
                count["sequence"] += 1
            count["step"] += max(groups, default=-1) + 1
            for i in range(0, len(out), 20_000):
                columns = list(zip(*out[i : i + 20_000], strict=True))
                ids = columns.pop()
                arrays = [pa.array(c, pa.int64()) for c in columns]
                if with_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))))
                else:
                    arrays.append(pa.nulls(len(ids), schema.field("ids").type))
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        windows: list = []
        fresh_tokens = 0
        for batch in batches:
            for part in pieces(batch, "text", 4_000_000):
                encoded = iter(encode.encode(utf8(part, "text")))
                for few in pieces(part, "text", 1_000_000):
                    for doc_id, ids in zip(few.column("doc_id").to_pylist(), encoded):  # noqa: B905 - the ids go on in the next few
                        ids += end
                        held[count["document"]] = [doc_id, ids, len(ids) // 4]
                        windows.extend(packer.add(count["document"], len(ids) // 4))
                        count["document"] += 1
                        fresh_tokens += len(ids) // 4
                    if fresh_tokens >= pool_tokens:
                        windows.extend(packer.pack())
                        yield from rows(windows)
                        windows, fresh_tokens = [], 0
        windows.extend(packer.pack(last=True))
        yield from rows(windows)
        if not keep_words:
            encode.rest()

    return docs.select("doc_id", "text").mapInArrow(resting(without_collections(run)), SCHEMA)
