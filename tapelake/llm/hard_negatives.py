"""Hard negatives: rows of another label that score almost as high with an anchor as its positives do.

Anchors are clustered by direction. For each cluster and each block of candidates the candidates are sorted once by an upper
bound of their inner product with any member: a candidate of length r at the angle t from the cluster's centre scores at
most r * cos(max(0, t - w)) with a member of length 1, where w is the widest angle of a member. Every member walks that
list from the top and leaves it as soon as the bound of all that follows, times its own length, is below its worst kept
score: its best rows are then certain. A task keeps what its members have found from block to block, so later lists are left
earlier. The walk runs twice: for the positives (same label, best scores), and for the negatives of each positive (another
label, scores inside the positive's window), where a member also leaves a list whose bound is below all its windows.

Scale: anchors are a query set that meets all rows, in blocks. They are dealt into rounds of at most MAX_ROUND rows, whole
clusters together where they fit; a round's anchors are sent to all tasks (MAX_ROUND bounds them), and every round scans the
candidates once, without a shuffle. Each task returns at most the best few rows of each anchor; these are merged by anchor.
Centres are fitted on at most SAMPLE anchors, chosen by hash; they steer how early walks end and never what they find.

Exactness: components become floor(256 * x). Scores are integers and exact: in double precision where no partial sum can
reach 2^53, else in Python's integers. Bounds are rounded upwards.

Defined results: rows with a null id, label or vector, with a null or non-finite component, or whose integer vector has a
squared length of 2^62 or more (its scores might not fit a long) take no part. Vectors of different lengths are filled up
with zeros. Rows that repeat an id are rows of their own, but never positives or negatives of an anchor of that id; a repeated
anchor (equal in all columns read) gives its rows once. An anchor without positives or a positive without negatives gives no
row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import resting, written

TOP = 5
SCALE = 256
#: A negative's score in percent of its positive's, at least.
LEAST_PERCENT = 80
#: Anchors sent to all tasks at once; anchors the centres are fitted on; anchors a centre is meant for; candidates in a list.
MAX_ROUND = 16_384
SAMPLE = 8_192
PER_CLUSTER = 32
MAX_CLUSTERS = 256
LIST = 8_192

#: Scores that are held at once, unless a cluster's members alone are more.
_AT_ONCE = 1 << 21
_EXACT = 2.0**53
_LOWEST, _HIGHEST = -(2**63) + 1, 2**63 - 1
#: Angles are taken to be this much smaller than computed, and bounds this much larger.
_ANGLE, _SHARE = 1e-6, 1e-9


def rows(embeddings: DataFrame, relabelled: Column | None = None) -> DataFrame:
    """id, label and vector (longs) of the rows that take part."""
    label = F.col("label").cast("long") if relabelled is None else relabelled.cast("long")
    values = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**31)))
    whole = F.transform(values, lambda x: F.floor(x * SCALE))
    out = embeddings.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(F.coalesce(finite, F.lit(False)))
    out = out.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), whole.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return out.filter(square < 2.0**62)


def _matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """The vectors as rows of a matrix, filled up with zeros."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), max(int(lengths.max(initial=0)), width or 0)), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has no direction and is left as it is."""
    m = matrix.astype(np.float64)
    length = np.sqrt((m * m).sum(1))
    return m / np.where(length > 0, length, 1)[:, None], length


def _angles(directions: np.ndarray, centres: np.ndarray) -> np.ndarray:
    k = min(directions.shape[1], centres.shape[1])  # what one of them lacks counts as zeros
    return np.arccos(np.clip(directions[:, :k] @ centres[:, :k].T, -1, 1))


def centres(sample: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of clusters of the sample, by spherical k-means from evenly spaced rows; the same for the same sample."""
    directions, _ = _unit(sample)
    now = directions[np.linspace(0, len(directions) - 1, clusters).astype(int)]
    for _ in range(rounds):
        nearest = (directions @ now.T).argmax(1)
        sums = np.zeros_like(now)
        np.add.at(sums, nearest, directions)
        moved, length = _unit(sums)
        now = np.where((length > 0)[:, None], moved, now)
    return now


class Walk:
    """Members that look for their TOP best rows in lists of candidates, block after block.

    A query is a member, a range of scores, and whether it wants the member's label or any other.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, members: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, middle: np.ndarray, top: int = TOP):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.member, self.low, self.high, self.same, self.top = members, low, high, same, top
        directions, self.length = _unit(vectors)
        self.largest = int(np.abs(vectors).max(initial=0))
        angle = _angles(directions, middle)
        self.cluster = angle.argmin(1)
        self.centres = middle
        self.widest = np.zeros(len(middle))
        # A zero vector scores 0 with everything, whatever its angle.
        np.maximum.at(self.widest, self.cluster, np.where(self.length > 0, angle[np.arange(len(ids)), self.cluster], 0))
        self.queries_of = [np.flatnonzero(self.cluster[members] == c) for c in range(len(middle))]
        n = len(members)
        self.score, self.row_id, self.kept = np.zeros((n, top), np.int64), np.zeros((n, top), np.int64), np.zeros(n, np.int64)
        self.worst = low.copy()  # scores below this cannot get in
        self.walked = 0

    def block(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        directions, length = _unit(vectors)
        angle = _angles(directions, self.centres)
        for c, queries in enumerate(self.queries_of):
            if len(queries):
                bound = length * np.cos(np.maximum(0, angle[:, c] - self.widest[c] - _ANGLE))
                bound += np.abs(bound) * _SHARE + length * _SHARE
                eligible = np.flatnonzero(np.isin(labels, np.unique(self.labels[self.member[queries]]))) if self.same else np.arange(len(ids))
                order = eligible[np.argsort(-bound[eligible], kind="stable")]
                self._list(queries, ids[order], labels[order], vectors[order], bound[order])

    def _list(self, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bound: np.ndarray) -> None:
        """All queries of a cluster walk one list; those that are certain of their rows leave it."""
        at, step = 0, 64
        while at < len(ids):
            member = self.member[queries]
            # The bound of a zero member is 0, and so are its scores.
            queries = queries[self.length[member] * bound[at] >= self.worst[queries] - 0.5]
            queries = queries[self.low[queries] <= self.high[queries]]
            if not len(queries):
                return
            member, which = np.unique(self.member[queries], return_inverse=True)
            part = slice(at, at + step)
            scores = self._scores(member, vectors[part])
            fits = (labels[part] == self.labels[member][:, None]) == self.same
            fits &= ids[part] != self.ids[member][:, None]
            self.walked += scores.size
            mine = scores[which]
            query, column = np.nonzero(fits[which] & (mine >= self.worst[queries][:, None]) & (mine <= self.high[queries][:, None]))
            if len(query):
                self._keep(queries[query], mine[query, column], ids[part][column])
            at += step
            step = min(2 * step, 1024, max(64, _AT_ONCE // len(queries)))

    def _scores(self, member: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        width = min(self.vectors.shape[1], vectors.shape[1])
        a, b = self.vectors[member, :width], vectors[:, :width]
        if float(self.largest) * float(np.abs(b).max(initial=0)) * max(width, 1) < _EXACT:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
        return (a.astype(object) @ b.T.astype(object)).astype(np.int64)

    def _keep(self, query: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        touched = np.unique(query)
        old = np.repeat(touched, self.kept[touched])
        place = np.arange(len(old)) - np.repeat(np.cumsum(self.kept[touched]) - self.kept[touched], self.kept[touched])
        query, score, row_id = np.concatenate((old, query)), np.concatenate((self.score[old, place], score)), np.concatenate((self.row_id[old, place], row_id))
        order = np.lexsort((row_id, -score, query))
        query, score, row_id = query[order], score[order], row_id[order]
        starts = np.searchsorted(query, touched)
        rank = np.arange(len(query)) - starts[np.searchsorted(touched, query)]
        best = rank < self.top
        self.score[query[best], rank[best]], self.row_id[query[best], rank[best]] = score[best], row_id[best]
        self.kept[touched] = np.minimum(np.diff(np.append(starts, len(query))), self.top)
        full = touched[self.kept[touched] == self.top]
        self.worst[full] = self.score[full, self.top - 1]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of all that is kept."""
        query = np.repeat(np.arange(len(self.kept)), self.kept)
        place = np.arange(len(query)) - np.repeat(np.cumsum(self.kept) - self.kept, self.kept)
        return query, self.row_id[query, place], self.score[query, place]


_FOUND = "query long, id long, score long"


def _walked(candidates: DataFrame, sent, same: bool) -> DataFrame:
    """query, id, score: the best rows of every query among the candidates of each task."""

    def run(batches):
        walk = Walk(**sent.value, same=same)
        waiting: list[pa.RecordBatch] = []

        def block() -> None:
            rows_ = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            ids, labels = (rows_.column(n).to_numpy() for n in ("id", "label"))
            walk.block(ids, labels, _matrix(rows_.column("vector").combine_chunks()))

        for batch in batches:
            for start in range(0, batch.num_rows, LIST):
                waiting.append(batch.slice(start, LIST))
                if sum(b.num_rows for b in waiting) >= LIST:
                    block()
        if waiting:
            block()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in walk.found()], names=["query", "id", "score"])

    return candidates.mapInArrow(resting(run), _FOUND)


def _best(found: DataFrame) -> DataFrame:
    """The TOP best rows of every query, with their rank."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def _rounds(anchors: DataFrame, middle: np.ndarray) -> list[DataFrame]:
    """The anchors in groups of at most MAX_ROUND, a cluster together where it fits."""

    def assign(batches):
        for batch in batches:
            directions, _ = _unit(_matrix(batch.column("vector")))
            nearest = _angles(directions, middle).argmin(1) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int64())], names=[*batch.schema.names, "cluster"])

    assigned = anchors.mapInArrow(resting(assign), "id long, label long, vector array<long>, cluster long")
    fine = written(assigned.withColumn("part", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(1 << 20))), "anchors")
    out: list[DataFrame] = []

    def cut(rows_: DataFrame, n: int, low: int, high: int) -> None:
        """Parts of one cluster's hash range, halved until each fits."""
        if n <= MAX_ROUND or high - low <= 1:
            groups.append((rows_.filter(F.col("part").between(low, high - 1)), n))
            return
        half = (low + high) // 2
        left = rows_.filter(F.col("part").between(low, half - 1)).count()
        cut(rows_, left, low, half)
        cut(rows_, n - left, half, high)

    groups: list[tuple[DataFrame, int]] = []
    small: list[int] = []
    total = 0
    for r in sorted(fine.groupBy("cluster").count().collect(), key=lambda r: r["cluster"]):  # at most MAX_CLUSTERS rows
        if r["count"] > MAX_ROUND:
            cut(fine.filter(F.col("cluster") == r["cluster"]), r["count"], 0, 1 << 20)
            continue
        if total + r["count"] > MAX_ROUND:
            out.append(fine.filter(F.col("cluster").isin(small)))
            small, total = [], 0
        small.append(r["cluster"])
        total += r["count"]
    if small:
        out.append(fine.filter(F.col("cluster").isin(small)))
    return out + [g for g, n in groups if n]


def _round(candidates: DataFrame, anchors: DataFrame, middle: np.ndarray) -> DataFrame | None:
    """The negatives of one round's anchors."""
    spark = candidates.sparkSession
    own = anchors.select("id", "label", "vector").toArrow()  # MAX_ROUND rows at most
    order = np.lexsort((own.column("label").to_numpy(), own.column("id").to_numpy()))
    own = own.take(pa.array(order)).combine_chunks()
    ids, labels = (own.column(n).to_numpy() for n in ("id", "label"))
    vectors = _matrix(own.column("vector").combine_chunks())
    members = {"ids": ids, "labels": labels, "vectors": vectors, "middle": middle}
    n = len(ids)

    everything = {"members": np.arange(n), "low": np.full(n, _LOWEST), "high": np.full(n, _HIGHEST)}
    sent = spark.sparkContext.broadcast(members | everything)
    positives = written(_best(_walked(candidates, sent, True)), "positives").toArrow()  # TOP rows for each anchor
    sent.unpersist()
    if not positives.num_rows:
        return None
    anchor, positive, score = (positives.column(c).to_numpy().astype(np.int64) for c in ("query", "id", "score"))
    order = np.lexsort((positive, anchor))
    anchor, positive, score = anchor[order], positive[order], score[order]
    # A negative score has no window: four fifths of it are more than itself.
    low = -((-score // 100) * LEAST_PERCENT + (-score % 100) * LEAST_PERCENT // 100)
    sent = spark.sparkContext.broadcast(members | {"members": anchor, "low": low, "high": score})
    negatives = _best(_walked(candidates, sent, False))
    # What each query number stands for; TOP rows for each anchor of a round.
    named = pa.table({"query": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": positive, "positive_score": score})
    out = negatives.join(F.broadcast(spark.createDataFrame(named)), "query")
    out = out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    out = written(out, "negatives")
    sent.unpersist()
    return out


def mine(embeddings: DataFrame, is_anchor: Column, relabelled: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings``: vec_id, embedding, label. ``is_anchor``: of the column ``id``, which rows are anchors.
    ``relabelled``: a label to use instead of the column's.
    """
    spark = embeddings.sparkSession
    candidates = rows(embeddings, relabelled)
    anchors = written(candidates.filter(is_anchor).distinct(), "anchors")
    total = anchors.count()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not total:
        return empty
    sample = anchors.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE).select("vector").toArrow()
    middle = centres(_matrix(sample.column("vector").combine_chunks()), max(1, min(MAX_CLUSTERS, sample.num_rows, total // PER_CLUSTER)))
    out = empty
    for group in _rounds(anchors, middle):
        found = _round(candidates, group, middle)
        out = out if found is None else found if out is empty else out.unionByName(found)
    return out
