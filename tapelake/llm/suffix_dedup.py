"""Exact removal of repeated byte strings of a minimum length, over all documents.

Anchors. Of the 32-byte strings inside a 100-byte string the one with the smallest hash is its anchor, so equal 100-byte
strings have equal anchors. The starts that share an anchor occurrence are a run; the bytes their 100-byte strings cover are
its context. A map emits one short row per run: the hashes of anchor and context and its place, about one for 35 bytes.

Copies. Of the rows of one batch with the same anchor and context all but the first are repeated from end to end, and are
settled before the shuffle. The others are brought together by anchor and streamed in order. A context that has come before is
repeated from end to end. An anchor with one context only needs nothing more. Where an anchor has several, the first row of each context goes on.

Expansion. The contexts of such anchors meet in blocks of bounded size, whole anchors each; ``bwt.prefix_classes`` finds the
classes of equal 100-byte strings in a block, and all members of a class but the first by (document, start) are repeated. An
anchor with more contexts than ``GROUP`` is not brought together: its runs are cut into short ones, at places that the anchor
fixes, and go the same way once more, with what the strings of a short run have in common as their anchor. Where even that
leaves too many, the single strings are grouped by a 128-bit hash, with the first place as an aggregate that is combined
before the shuffle.

So a text is shuffled once, and once more if anything in it repeats; no group is held in memory, and the rows of a very
frequent anchor pass through their task in a stream.

Defined results: a null text is empty and has no bytes; texts shorter than the minimum lose nothing. Documents are ordered
by doc_id, null last, those with the same id by the hash of their text; repeated rows (same id and text) are one document and
each get its result. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.bwt import prefix_classes
from tapelake.llm.common import fresh, map_batches, resting, written
from tapelake.llm.hashing import Prefixes, buffer, mix

LENGTH = 100
ANCHOR = 32
GROUP = 2000
STEP = 9
BLOCK_BYTES = 1_000_000


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Row, first and last start (within the row), anchor hash and context hash of each run of the rows of a buffer."""
    n, window = len(data), length - anchor + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefixes = Prefixes(data)
    hashes = prefixes.windows(anchor)
    low = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: n - length + 1], low[window - size : window - size + n - length + 1])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    room = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(room)), np.maximum(room, 0))
    start = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(room, 0)) - np.maximum(room, 0), np.maximum(room, 0))
    place = offsets[row] + start
    at = at[place]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    if not len(first):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return row[first], start[first], start[last], hashes[at[first]], prefixes.of(place[first], place[last] + length)


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id, text and key: doc_id where it names each row, else a number in the same order."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    rows = docs.select("doc_id", "text")
    if ids.filter("n > 1 OR doc_id IS NULL").isEmpty():
        return rows.withColumn("key", F.col("doc_id")), True
    ordered = rows.distinct().orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    return written(ordered.withColumn("key", F.monotonically_increasing_id()), "ordered"), False


def _combined(anchor: np.ndarray, context: np.ndarray, key: np.ndarray, place: np.ndarray) -> dict:
    """The rows of a batch, where of those with one anchor and context only the first may be the first of all.

    The others are repeated whatever other batches hold. They are marked by a place below zero, and get a key of their own to
    be dealt out by in place of the anchor, so that an anchor that fills the batch sends one row for each of its contexts.
    """
    order = np.lexsort((place, key, context, anchor))
    again = np.zeros(len(order), bool)
    again[1:] = (anchor[order][1:] == anchor[order][:-1]) & (context[order][1:] == context[order][:-1])
    again = order[again]
    anchor, place = anchor.copy(), place.copy()
    anchor[again] = mix(key[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place[again].astype(np.uint64)).view(np.int64)
    place[again] = ~place[again]
    return {"anchor": anchor, "context": context, "key": key, "place": place}


def _stream_copies(batches):
    """Rows in the order of anchor, context and place -> repeated runs, and the first run of each of several contexts."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("anchor", pa.int64())])
    last_anchor = last_context = None
    waiting: tuple | None = None  # the first run of an anchor that has shown one context so far
    several = False
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, context, key, place = (batch.column(c).to_numpy() for c in ("anchor", "context", "key", "place"))
        done = place < 0
        if done.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[done]), pa.array(~place[done]), pa.nulls(int(done.sum()), pa.int64())], schema=schema)
            anchor, context, key, place = (x[~done] for x in (anchor, context, key, place))
            if not len(anchor):
                continue
        same_anchor, same_context = np.zeros(len(anchor), bool), np.zeros(len(anchor), bool)
        same_anchor[1:] = anchor[1:] == anchor[:-1]
        same_context[1:] = same_anchor[1:] & (context[1:] == context[:-1])
        same_anchor[0] = last_anchor is not None and anchor[0] == last_anchor
        same_context[0] = same_anchor[0] and context[0] == last_context
        group = np.cumsum(~same_anchor)  # 0: the anchor that the batch before ended with
        multiple = np.zeros(group[-1] + 1, bool)
        multiple[group[same_anchor & ~same_context]] = True
        multiple[0] |= several
        out = [(key[same_context], place[same_context], None)]
        if waiting is not None and multiple[0]:
            out.append(tuple(np.array([x]) for x in waiting))
        first = ~same_context & multiple[group]
        out.append((key[first], place[first], anchor[first]))
        # The last anchor's first run may learn only from the next batch that it is not alone.
        several = bool(multiple[-1])
        if several:
            waiting = None
        elif group[-1]:
            i = np.flatnonzero(~same_anchor)[-1]
            waiting = key[i], place[i], anchor[i]
        last_anchor, last_context = anchor[-1], context[-1]
        for k, at, a in out:
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(at), pa.nulls(len(k), pa.int64()) if a is None else pa.array(a)], schema=schema)


def _expand_blocks(batches):
    """Contexts in the order of anchors -> the repeated starts in them, as runs."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int64())])

    def expanded(rows):
        strings, starts, classes = prefix_classes([r[1] for r in rows], LENGTH)
        key = np.array([r[2] for r in rows], np.int64)[strings]
        place = np.array([r[3] for r in rows], np.int64)[strings] + starts
        order = np.lexsort((place, key, classes))
        repeated = np.zeros(len(order), bool)
        repeated[1:] = classes[order][1:] == classes[order][:-1]
        key, place = key[order][repeated], place[order][repeated]
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(key))[: len(first)] - 1
        return pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(place[first] << 32 | place[last])], schema=schema)

    block, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "key", "low")), strict=True):
            if size >= BLOCK_BYTES and row[0] != block[-1][0]:
                yield expanded(block)
                block, size = [], 0
            block.append(row)
            size += len(row[1])
    if block:
        yield expanded(block)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _streamed(rows: DataFrame) -> DataFrame:
    """key, place and anchor (null: repeated from end to end) of the rows that matter. A place is low << 32 | high."""
    dealt = rows.repartition(_partitions(rows), "anchor").sortWithinPartitions("anchor", "context", "key", "place")
    return written(dealt.mapInArrow(resting(_stream_copies), "key long, place long, anchor long"), "runs")


def _lists(found: DataFrame) -> DataFrame:
    """Per document: the repeated runs, those whose contexts are to be compared, and those of crowded anchors."""
    crowded = found.filter("anchor IS NOT NULL").groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("anchor", F.lit(True).alias("crowded"))
    # A repeated run has no anchor to be joined by; a join would bring all of them into one task.
    marked = found.filter("anchor IS NOT NULL").join(crowded, "anchor", "left").unionByName(found.filter("anchor IS NULL"), allowMissingColumns=True)
    run, known = F.struct("place", "anchor"), F.col("anchor").isNotNull()
    return marked.groupBy("key").agg(
        F.collect_list(F.when(~known, F.col("place"))).alias("done"),
        F.collect_list(F.when(known & F.col("crowded").isNull(), run)).alias("open"),
        F.collect_list(F.when(known & F.col("crowded"), run)).alias("crowded"),
    )


def _work(docs: DataFrame) -> tuple[DataFrame, bool]:
    """One row per document: key, doc_id, the lists of runs, n_bytes; the text only where something repeats."""
    keyed, unique = _keyed(docs)

    def emit(batch: pa.RecordBatch) -> dict:
        row, low, high, anchor, context = runs(*buffer(batch.column("text")))
        return _combined(anchor.view(np.int64), context.view(np.int64), batch.column("key").to_numpy()[row], low << 32 | high)

    found = _streamed(map_batches(keyed, emit, "anchor long, context long, key long, place long", most_bytes=1_000_000))
    text = F.coalesce(keyed["text"], F.lit(""))
    some = F.col("done").isNotNull()
    work = keyed.join(_lists(found).hint("shuffle_hash"), "key", "left").select(
        "key",
        "doc_id",
        F.when(some, text).alias("text"),
        "done",
        "open",
        "crowded",
        F.xxhash64(keyed["text"]).alias("text_hash"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.when(~some | some.isNull(), F.sha2(text, 256)).alias("whole_sha256"),
    )
    return written(work, "texts"), unique


def _runs_of(batch: pa.RecordBatch, name: str):
    """Row, first and last start, and anchor of the runs in a list column."""
    column = batch.column(name)
    offsets = column.offsets.to_numpy()
    place, anchor = (x.to_numpy() for x in column.flatten().flatten())
    return np.repeat(np.arange(len(column)), np.diff(offsets)), place >> 32, place & 0xFFFFFFFF, anchor


def _blocks(texts: DataFrame) -> DataFrame:
    """The repeated runs in the contexts of the ``open`` runs."""

    def contexts(batch: pa.RecordBatch) -> dict:
        row, low, high, anchor = _runs_of(batch, "open")
        text = batch.column("text").cast(pa.binary()).to_pylist()
        strings = [text[r][a:b] for r, a, b in zip(row.tolist(), low.tolist(), (high + LENGTH).tolist(), strict=True)]
        return {"anchor": anchor, "context": strings, "key": batch.column("key").take(pa.array(row)), "low": low}

    rows = map_batches(texts.filter(F.size("open") > 0).select("key", "text", "open"), contexts, "anchor long, context binary, key long, low long")
    return rows.repartition(_partitions(rows), "anchor").sortWithinPartitions("anchor").mapInArrow(resting(_expand_blocks), "key long, place long")


def _narrowed(texts: DataFrame) -> DataFrame:
    """The ``crowded`` runs cut where the distance to the anchor is a multiple of ``STEP``, as rows like those of ``runs``."""

    def cut(batch: pa.RecordBatch) -> dict:
        out = {"anchor": [], "context": [], "key": [], "place": []}
        text, keys = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("key").to_pylist()
        for r, low, high, anchor in zip(*(x.tolist() for x in _runs_of(batch, "crowded")), strict=True):
            prefixes = Prefixes(np.frombuffer(text[r][low : high + LENGTH], np.uint8))
            at = int(np.flatnonzero(prefixes.windows(ANCHOR).view(np.int64) == anchor)[0])  # the anchor, from the first start on
            last = at  # the distance of the first start is the largest
            for distance in range(max(at - (high - low), 0) // STEP * STEP, last + 1, STEP):
                first, end = max(at - distance - STEP + 1, 0), min(at - distance, high - low)
                if first > end:
                    continue
                core, whole = np.array([at - distance, first]), np.array([at - distance + LENGTH - STEP + 1, end + LENGTH])
                a, c = prefixes.of(core, whole).view(np.int64).tolist()
                for name, v in zip(out, (a ^ distance, c, keys[r], low + first << 32 | low + end), strict=True):
                    out[name].append(v)
        return _combined(*(np.array(x, np.int64) for x in out.values()))

    return map_batches(texts, cut, "anchor long, context long, key long, place long")


def _single(texts: DataFrame) -> DataFrame:
    """The repeated ones among the strings of the ``crowded`` runs, each by itself."""

    def strings(batch: pa.RecordBatch) -> dict:
        out = {"a": [], "b": [], "key": [], "place": []}
        text, keys = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("key").to_pylist()
        for r, low, high, _ in zip(*(x.tolist() for x in _runs_of(batch, "crowded")), strict=True):
            for start in range(low, high + 1):
                digest = hashlib.blake2b(text[r][start : start + LENGTH], digest_size=16).digest()
                for name, v in zip(out, (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), keys[r], start << 32 | start), strict=True):
                    out[name].append(v)
        return out

    rows = map_batches(texts.filter(F.size("crowded") > 0).select("key", "text", "crowded"), strings, "a long, b long, key long, place long")
    first = rows.groupBy("a", "b").agg(F.min(F.struct("key", "place")).alias("first"))
    return rows.join(first, ["a", "b"]).filter(F.struct("key", "place") != F.col("first")).select("key", "place")


def _expanded(work: DataFrame) -> DataFrame:
    """key and place of the repeated runs in contexts that differ."""
    crowded = work.filter(F.size("crowded") > 0).select("key", "text", "crowded")
    found = _streamed(_narrowed(crowded))
    again = crowded.select("key", "text").join(_lists(found).hint("shuffle_hash"), "key")
    return _blocks(work).union(found.filter("anchor IS NULL").select("key", "place")).union(_blocks(again)).union(_single(again))


def removed_spans(places: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal byte spans that strings starting in the given runs cover."""
    places = np.sort(places)
    low, end = places >> 32, np.maximum.accumulate((places & 0xFFFFFFFF) + length)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > end[:-1]
    first = np.flatnonzero(new)
    return low[first], end[np.append(first[1:], len(low))[: len(first)] - 1]


def _cut(docs: DataFrame) -> tuple[DataFrame, bool]:
    """key, doc_id, text_hash, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes; null where nothing was cut)."""
    work, unique = _work(docs)
    more = _expanded(work).groupBy("key").agg(F.collect_list("place").alias("more"))
    none = F.array().cast("array<bigint>")
    places = F.concat(F.coalesce("done", none), F.coalesce("more", none)).alias("places")
    joined = work.join(more.hint("shuffle_hash"), "key", "left").select("key", "doc_id", "text", places, "text_hash", "n_bytes", "whole_sha256")

    def cut(batch: pa.RecordBatch) -> dict:
        out = {"n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        lists, offsets = batch.column("places").flatten().to_numpy(), batch.column("places").offsets.to_numpy()
        offsets = offsets - offsets[0]
        for i, (text, digest) in enumerate(zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("whole_sha256").to_pylist(), strict=True)):
            starts, ends = removed_spans(lists[offsets[i] : offsets[i + 1]])
            kept = None
            if text is not None:
                kept = b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
            for name, v in zip(out, (int((ends - starts).sum()), len(starts), digest, kept if len(starts) else None), strict=True):
                out[name].append(v)
        return out | {n: batch.column(n) for n in ("key", "doc_id", "text_hash", "n_bytes")}

    return map_batches(joined, cut, "key long, doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"), unique


def _for_rows(docs: DataFrame, result: DataFrame, unique: bool) -> DataFrame:
    """The columns of ``docs`` and the result of each row, also where rows repeat or share an id."""
    d, h = fresh("d"), fresh("h")
    named = result.drop("key").withColumnsRenamed({"doc_id": d, "text_hash": h})
    match = F.col("doc_id") == F.col(d) if unique else F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h))
    return docs.join(named.hint("shuffle_hash"), match).drop(d, h)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left; null where nothing was removed)."""
    result, unique = _cut(docs)
    if not unique:
        result = _for_rows(docs.select("doc_id", "text"), result, unique)
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
