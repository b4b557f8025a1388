"""Quality score by a generalised additive model with pairwise interactions.

A text's score is the logistic of a constant, one table entry per feature and one per chosen pair of features. The tables are
learnt by cyclic boosting: round after round each feature in turn gets a shallow tree on that feature alone, fitted to
what the model still misses and added, slightly, to the feature's table; then the pairs whose best two-way cut explains most
of what is left get tables of their own in the same way. Scoring is a bin lookup per feature and additions, for a whole
batch at once.

The features are statistics of the text alone: lengths, character shares, repetition. They are worked out once, in a map, and
written; the fit reads a sample of the labelled rows, of about ``SAMPLE`` rows whatever the size of the corpus, chosen by a
hash of the id; the score reads all.

Defined results: a null text counts as empty; every row gets a score, an empty text one from its (zero) features. Rows whose
crc32(doc_id) mod 4 is 2 are held out of the fit; a null doc_id is not held out and has no label. Repeated rows get equal
scores. Without labels the score is 0.5. Labels other than 0 and 1 are ignored. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.boosting import bin_edges, binned, fit_tree, sigmoid
from tapelake.llm.common import map_batches, resting, utf8, written

SAMPLE = 20_000
BINS = 32
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 80, 8
RATE = 0.1
HELD_OUT_REMAINDER = 2
THRESHOLD = 0.7

FEATURES = [
    "log_words", "log_bytes", "word_bytes", "symbols", "upper", "digits", "shouts", "pipes", "stops", "commas", "beyond_ascii",
    "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "log_line_words", "ended_lines", "ends",
]

_SYMBOLS, _UPPER, _DIGITS, _ASCII = b"#*$%&<>", bytes(range(65, 91)), b"0123456789", bytes(range(128))


def features(text: bytes | None) -> list[float]:
    text = text or b""
    size = max(len(text), 1)
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    counts = Counter(words)
    ended = sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines)
    return [
        np.log1p(len(words)), np.log1p(len(text)), sum(map(len, words)) / n, share(_SYMBOLS), share(_UPPER), share(_DIGITS),
        share(b"!"), share(b"|"), share(b".?"), share(b","), 1 - share(_ASCII),
        len(counts) / n, max(counts.values(), default=0) / n, len(set(zip(words, words[1:], strict=False))) / n,
        len(set(lines)) / n_lines, np.log1p(len(words) / n_lines), ended / n_lines, float(text.rstrip().endswith((b".", b"!", b"?"))),
    ]


@dataclass
class Additive:
    edges: list[np.ndarray]
    start: float
    single: np.ndarray  # feature, bin
    pairs: list[tuple[int, int]]
    double: np.ndarray  # pair, bin, bin

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        out = np.full(len(b), self.start)
        for f, scores in enumerate(self.single):
            out += scores[b[:, f]]
        for (f, g), scores in zip(self.pairs, self.double, strict=True):
            out += scores[b[:, f], b[:, g]]
        return out


def _pair_gain(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, f: int, g: int, bins: int) -> float:
    """The gain of the best cut of the plane of two features into four parts."""
    slot = b[:, f] * bins + b[:, g]
    total = [np.bincount(slot, v, bins * bins).reshape(bins, bins).cumsum(0).cumsum(1) for v in (gradient, hessian)]
    out = 0
    for corner in range(4):
        a, c = (_corner(t, corner) for t in total)
        out = out + a**2 / (c + 1)
    return float(out.max())


def _corner(sums: np.ndarray, corner: int) -> np.ndarray:
    low = sums[:-1, :-1]
    if corner == 0:
        return low
    if corner == 1:
        return sums[:-1, -1:] - low
    if corner == 2:
        return sums[-1:, :-1] - low
    return sums[-1, -1] - sums[:-1, -1:] - sums[-1:, :-1] + low


def fit(x: np.ndarray, y: np.ndarray, bins: int = BINS) -> Additive:
    """Cyclic boosting of the features' tables, then of the chosen pairs' tables."""
    n_features, width = x.shape[1], bins + 1
    edges = bin_edges(x, bins) if len(x) else [np.zeros(0)] * n_features
    p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    model = Additive(edges, float(np.log(p / (1 - p))), np.zeros((n_features, width)), [], np.zeros((0, width, width)))
    if not len(y):
        return model
    b = binned(x, edges)
    at = np.full(len(y), model.start)
    line = np.arange(width)
    one = np.zeros((width, n_features), np.int16)
    for _ in range(ROUNDS):
        for f in range(n_features):
            q = sigmoid(at)
            one[:, f] = line
            step = RATE * fit_tree(b, q - y, q * (1 - q), [f], 2, width).predict(one)
            model.single[f] += step
            at += step[b[:, f]]
    q = sigmoid(at)
    every = [(f, g) for f in range(n_features) for g in range(f)]
    every.sort(key=lambda p: -_pair_gain(b, q - y, q * (1 - q), *p, width))
    model.pairs = every[:PAIRS]
    model.double = np.zeros((len(model.pairs), width, width))
    grid = np.zeros((width * width, n_features), np.int16)
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            q = sigmoid(at)
            grid[:, f], grid[:, g] = np.repeat(line, width), np.tile(line, width)
            step = RATE * fit_tree(b, q - y, q * (1 - q), [f, g], 3, width).predict(grid).reshape(width, width)
            model.double[k] += step
            at += step[b[:, f], b[:, g]]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def sampled(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` of the labelled ids that are not held out: those with the smallest hashes."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def measure(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "x": [features(t) for t in utf8(batch, "text")]}

    measured = written(map_batches(docs.select("doc_id", "text"), measure, "doc_id long, x array<double>"), "features")
    rows = measured.join(sampled(labels, sample), "doc_id").select("doc_id", "x", "quality")
    # A document of several rows may bring more than one; of those the same are left out every time.
    rows = sorted(rows.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).collect(), key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    shared = docs.sparkSession.sparkContext.broadcast(fit(x, np.array([r["quality"] for r in rows], float)))

    def add(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(shared.value.logit(x)))], schema=schema)

    scored = measured.mapInArrow(resting(add), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
