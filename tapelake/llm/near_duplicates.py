"""Near duplicates by BagMinHash: weighted-Jaccard signatures of the multisets of five-word shingles.

Signatures. A shingle that occurs c times covers the weights [0, c), cut into the intervals [0, 1), [1, 2), [2, 4), [4, 8)
and so on. Each (shingle, interval) has a Poisson process of points in time, seeded by its hash, whose rate is the
interval's length; a point also has a place in the interval and a component of the signature, and counts only if its
place lies below c. A component's value is the first point that reaches it. So two multisets share a component with
probability sum(min) / sum(max). Few points are drawn: those after a time by which all components are surely filled are
not, and a text whose components are not yet filled then is gone on with for twice as long.

Duplicates. Texts with equal multisets are one node from the start. Nodes that agree in all components of a band are
candidates. In each bucket the node that meets the most others over all its bands is the centre and is held against all the
others; links are verified by exact multiset overlap and joined to classes. Members of one class are never paired again,
so a large group of copies costs as many comparisons as it has members. In buckets that then still hold several classes
the pairs of different classes are compared inside a task: each pair in the first band that it shares, by weights, by
signature, and then by the exact overlap of all its shingles, so that a pair that comes out, at most one for two classes of a
group, is a link. The nodes of a bucket too large for one task are dealt anew by their rarest shingles, so that only those meet
that can be similar; rows are in proportion to shingles. Only where thousands of nodes share even one of these, texts just
below the threshold, are they compared block by block, and rows grow faster than nodes.

With 24 bands of 4 a pair at the threshold of 0.8 is missed with probability (1 - 0.8^4)^24 = 3e-6, and its signature, of 96
components, agrees in fewer than 62 with probability 5e-5.

Defined results: words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII. A text of fewer words
than five is one shingle. Texts without words (null, empty, symbols only) are each in a class of their own. A class is
named by its smallest doc_id; null ids come last. Repeated rows are in one class, and ``keep_first`` keeps one of them. An
empty table gives an empty result. Extra columns are kept by ``keep_first``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.classes import joined_classes
from tapelake.llm.common import fresh, map_batches, resting, written
from tapelake.llm.hashing import buffer, mix, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: Components of two signatures that agree at least if the texts are similar; nodes and shingles of a bucket that meet at once.
LEAST_EQUAL = 62
BLOCK, BLOCK_SHINGLES = 2000, 1_000_000
#: A shingle with more than one in so many of all occurrences in crowded buckets is frequent.
FREQUENT = 100_000

_UNIT = 2.0**-53


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def multisets(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of each row, in the order of rows and hashes."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((shingles, row))
    row, shingles = row[order], shingles[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(first)
    return row[at], shingles[at], np.diff(np.append(at, len(row)))


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int, size: int) -> np.ndarray:
    """BagMinHash of each row's multiset; a row without shingles has zeros."""
    lows, elements = [np.zeros(len(row), np.int64)], [np.arange(len(row))]
    low, more = 1, np.flatnonzero(count > 1)
    while len(more):
        lows.append(np.full(len(more), low))
        elements.append(more)
        low *= 2
        more = more[count[more] > low]
    low, element = np.concatenate(lows), np.concatenate(elements)
    width = np.maximum(low, 1)
    seed = mix(shingle[element] + mix(low.astype(np.uint64) + np.uint64(1)))
    of, limit = row[element], count[element]
    weight = np.bincount(row, weights=count, minlength=rows)
    horizon = (np.log(size) + 3) / np.maximum(weight, 1)
    best = np.full(rows * size, np.inf)
    value = np.zeros(rows * size, np.uint64)
    state, time = seed.copy(), np.zeros(len(seed))

    def draw(which: np.ndarray) -> None:
        """Each element's next point: its state and time."""
        state[which] = h = mix(state[which] + np.uint64(0x9E3779B97F4A7C15))
        time[which] -= np.log(_uniform(h)) / (width[which] * size)

    active, parked = np.arange(len(seed)), []
    draw(active)
    while len(active):
        near = time[active] <= horizon[of[active]]
        parked.append(active[~near])
        active = active[near]
        inner = mix(state[active] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        slot = of[active] * size + (inner % np.uint64(size)).astype(np.int64)
        counts = low[active] + (_uniform(mix(inner)) * width[active]).astype(np.int64) < limit[active]
        slot, t, v = slot[counts], time[active][counts], inner[counts]
        order = np.lexsort((v, t, slot))
        slot, t, v = slot[order], t[order], v[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        slot, t, v = slot[first], t[first], v[first]
        better = t < best[slot]
        best[slot[better]], value[slot[better]] = t[better], v[better]
        draw(active)
        if not len(active):
            unfilled = np.isinf(best.reshape(rows, size)).any(1) & (weight > 0)
            horizon[unfilled] *= 2
            waiting = np.concatenate(parked)
            active, parked = waiting[unfilled[of[waiting]]], []
    return value.reshape(rows, size)


def _row_signatures(batch: pa.RecordBatch) -> dict:
    data, offsets = buffer(batch.column("text"))
    words, n_words = word_hashes(data, offsets)
    shingles, counts = shingle_hashes(words, n_words, SHINGLE)
    row, shingle, count = multisets(shingles, counts)
    rows = len(counts)
    sums = [np.zeros(len(row) + 1, np.uint64) for _ in range(2)]
    np.cumsum(mix(shingle + np.uint64(1)) * count.astype(np.uint64), out=sums[0][1:])
    np.cumsum(mix(shingle ^ np.uint64(0x5555)) * count.astype(np.uint64), out=sums[1][1:])
    ends = np.searchsorted(row, np.arange(rows + 1))
    keys = np.stack([s[ends[1:]] - s[ends[:-1]] for s in sums], 1)
    signature = signatures(row, shingle, count, rows, BANDS * ROWS).reshape(rows, BANDS, ROWS)
    bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (rows, BANDS)).copy()
    for k in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, k])
    has = counts > 0
    return {
        "doc_id": batch.column("doc_id"),
        "text_hash": batch.column("text_hash"),
        "n_shingles": counts,
        "node": [keys[i].tobytes() if has[i] else None for i in range(rows)],
        "sketch": [signature[i].astype(np.uint8).tobytes() if has[i] else None for i in range(rows)],
        "bands": [bands[i].view(np.int64) if has[i] else None for i in range(rows)],
    }


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def overlap(a: bytes, b: bytes, cache: dict) -> float:
    """The exact weighted Jaccard similarity of two texts' shingle multisets."""
    for text in (a, b):
        if text not in cache:
            data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
            words, n = word_hashes(data, offsets)
            cache[text] = multisets(*shingle_hashes(words, n, SHINGLE))[1:]
    (x, m), (y, n) = cache[a], cache[b]
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / max(int(m.sum() + n.sum()) - both, 1)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are as similar as asked for."""
    a, b = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    both = pairs.join(a.hint("shuffle_hash"), "a").join(b.hint("shuffle_hash"), "b")

    def check(batch: pa.RecordBatch) -> dict:
        cache: dict = {}
        x, y = (batch.column(f"text_{n}").cast(pa.binary()).to_pylist() for n in "ab")
        keep = pa.array([overlap(s, t, cache) >= THRESHOLD for s, t in zip(x, y, strict=True)], pa.bool_())
        return {n: batch.column(n).filter(keep) for n in "ab"}

    return map_batches(both, check, "a binary, b binary", text="text_a", most_bytes=500_000)


def _unsettled(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members, with their class, of the buckets that hold more than one class."""
    now = members.join(classes, "node")
    open_ = now.groupBy("bucket").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).filter("x != y").select("bucket")
    return now.join(open_, "bucket")


_GROUP = ["bucket", "block_i", "block_j"]


def _elements(texts: DataFrame) -> DataFrame:
    """node and shingles: 64-bit hashes in order, where the second shingle of a kind counts as another one."""

    def run(batch: pa.RecordBatch) -> dict:
        data, offsets = buffer(batch.column("text"))
        words, n = word_hashes(data, offsets)
        row, shingle, count = multisets(*shingle_hashes(words, n, SHINGLE))
        again = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        element = mix(np.repeat(shingle, count) + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ends = np.searchsorted(np.repeat(row, count), np.arange(len(n) + 1))
        return {"node": batch.column("node"), "shingles": [np.sort(element[a:b]).tobytes() for a, b in zip(ends, ends[1:], strict=False)]}

    return map_batches(texts, run, "node binary, shingles binary")


def _groups(batches, keys: list[str]):
    """The rows of each group as a table; batches come in the order of the groups."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy() for k in keys], 1)
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()]
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            if waiting and (a or tuple(key[0]) != last):
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting = []
            waiting.append(batch.slice(a, b - a))
        last = tuple(key[-1])
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _similar(group: pa.Table) -> tuple[list, list]:
    """Pairs of nodes of different classes that are similar; two classes that one pair joins need no second."""
    _, cls = np.unique(group.column("cls").to_pylist(), return_inverse=True)
    if cls.max() == 0:
        return [], []
    nodes, shingles = group.column("node").to_pylist(), group.column("shingles").to_pylist()
    n = len(nodes)
    sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
    bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(n, -1)
    weight, block = group.column("weight").to_numpy(), group.column("block").to_numpy()
    band, across = group.column("band")[0].as_py(), group.column("block_i")[0] != group.column("block_j")[0]
    left, right = [], []
    for i in range(n - 1):
        rest = slice(i + 1, None)
        low, high = np.minimum(weight[i], weight[rest]), np.maximum(weight[i], weight[rest])
        fits = (cls[rest] != cls[i]) & (low >= THRESHOLD * high)
        if across:
            fits &= block[rest] != block[i]
        at = np.flatnonzero(fits) + i + 1
        at = at[(sketch[at] == sketch[i]).sum(1) >= LEAST_EQUAL]
        at = at[~(bands[at, :band] == bands[i, :band]).any(1)]
        own = np.frombuffer(shingles[i], np.uint64)
        for k in at.tolist():
            if cls[k] != cls[i]:
                both = int(np.isin(np.frombuffer(shingles[k], np.uint64), own, assume_unique=True).sum())
                if both >= THRESHOLD * (weight[k] + weight[i] - both):
                    cls[cls == cls[k]] = cls[i]
                    left.append(nodes[i])
                    right.append(nodes[k])
    return left, right


def _blocks() -> Column:
    return F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("mass") / BLOCK_SHINGLES)).cast("int")


def _refined(members: DataFrame, elements: DataFrame) -> DataFrame:
    """The members of crowded buckets in buckets of another kind: one for each of their rarest shingles.

    Of two texts that are similar each has a shingle of the other among the first fifth of its own, in any order that is the
    same for all texts. In an order that puts frequent shingles last, texts that share no more than a frequent passage do
    not meet. Frequent are those with more than one in ``FREQUENT`` of all occurrences, so there are no more than that.
    """
    nodes = written(members.select("node", "cls", "weight").distinct().join(elements, "node"), "crowded")

    def all_of(batch: pa.RecordBatch) -> dict:
        return {"element": np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.int64)}

    counts = map_batches(nodes.select("shingles"), all_of, "element long", text="shingles").groupBy("element").agg(F.count("*").alias("n"))
    counts = written(counts.filter("n > 1"), "shingle-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.filter(F.col("n") * FREQUENT > total).orderBy("n", "element").select("element").toPandas()["element"].to_numpy(np.int64)
    by_value = np.argsort(often)
    shared = members.sparkSession.sparkContext.broadcast((often[by_value], by_value))

    def first_of(batch: pa.RecordBatch) -> dict:
        frequent, rank = shared.value
        at, bucket = [], []
        for i, shingles in enumerate(batch.column("shingles").to_pylist()):
            own = np.frombuffer(shingles, np.int64)
            place = np.minimum(np.searchsorted(frequent, own), max(len(frequent) - 1, 0))
            late = frequent[place] == own if len(frequent) else np.zeros(len(own), bool)
            order = np.lexsort((own, np.where(late, rank[place], -1) if len(frequent) else own))
            first = own[order[: len(own) - math.ceil(THRESHOLD * len(own)) + 1]]
            at += [i] * len(first)
            bucket.append(first)
        at = pa.array(at, pa.int64())
        return {n: batch.column(n).take(at) for n in ("node", "cls", "weight")} | {"bucket": np.concatenate(bucket) if bucket else []}

    dealt = written(map_batches(nodes, first_of, "bucket long, node binary, cls binary, weight long", text="shingles"), "refined")
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("weight").alias("mass"), F.min("cls").alias("x"), F.max("cls").alias("y"))
    return dealt.join(sizes.filter("x != y").drop("x", "y"), "bucket").withColumn("band", F.lit(0))


def _linked(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of similar nodes of different classes that share a bucket: enough to join the classes.

    A bucket that is still large, by nodes or by shingles, is dealt into blocks; each two of them meet in a group of their own.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks()
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"block_i": F.least("block", "other"), "block_j": F.greatest("block", "other")})
    rows = rows.select(*_GROUP, "block", "band", "node", "cls", "weight").join(nodes, "node")
    dealt = rows.select(*_GROUP, "block", "band", "node", "cls", "weight", "bands", "sketch", "shingles").repartition(n, *_GROUP).sortWithinPartitions(*_GROUP)

    def compare(batches):
        for group in _groups(batches, _GROUP):
            left, right = _similar(group)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(resting(compare), "a binary, b binary")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_id, n_shingles, first (whether the row has its class's smallest doc_id)."""
    rows = written(map_batches(_keyed(docs), _row_signatures, "doc_id long, text_hash long, n_shingles long, node binary, bands array<long>, sketch binary"), "signatures")
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("row")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(smallest, F.min("bands").alias("bands"), F.min("sketch").alias("sketch"), F.min("n_shingles").alias("weight"))
    buckets = nodes.select("node", "weight", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("weight").alias("mass")).filter("size > 1")
    members = written(buckets.join(shared, "bucket"), "members")
    found = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("row.doc_id").alias("d"), F.col("row.text_hash").alias("h"))
    keyed = _keyed(docs)
    texts = written(keyed.join(found.hint("shuffle_hash"), keyed["doc_id"].eqNullSafe(F.col("d")) & (keyed["text_hash"] == F.col("h"))).select("node", "text").dropDuplicates(["node"]), "texts")

    classes = texts.select("node", F.col("node").alias("cls"))
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    left = members.join(met, "node")
    centres = left.groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("b"))
    stars = left.join(centres, "bucket").select(F.col("node").alias("a"), "b").filter("a != b").distinct()
    classes = joined_classes(classes, written(_verified(stars, texts), "verified"))
    left = written(_unsettled(members, classes), "unsettled")
    elements = written(_elements(texts.join(left.select("node").distinct(), "node", "left_semi")), "elements")
    usual, crowded = left.filter(_blocks() <= 1), left.filter(_blocks() > 1)
    if not crowded.isEmpty():
        names = ["bucket", "band", "node", "cls", "weight", "size", "mass"]
        usual = usual.select(names).unionByName(_refined(crowded, elements).select(names))
    pairs = _linked(usual, nodes.select("node", "bands", "sketch").join(elements, "node"))
    classes = joined_classes(classes, written(pairs, "linked"))

    named = rows.join(classes, "node", "left").withColumn("cls", F.coalesce("cls", "node"))
    ids = named.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("class_id"))
    out = named.join(ids, "cls", "left")
    class_id = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", "text_hash", class_id.alias("class_id"), "n_shingles", class_id.eqNullSafe(F.col("doc_id")).alias("first"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents without those that come after another of their class; equal rows count once."""
    hashed, d, h = fresh("hash"), fresh("d"), fresh("h")
    first = find(docs).filter("first").select(F.col("doc_id").alias(d), F.col("text_hash").alias(h)).distinct()
    keyed = docs.withColumn(hashed, F.xxhash64("text"))
    kept = keyed.join(first.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(hashed) == F.col(h)))
    return kept.dropDuplicates(["doc_id", hashed]).select(docs.columns)
