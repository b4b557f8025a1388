"""Hard negatives against a plain search over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.llm import hard_negatives

KIND = "vec_id long, embedding array<float>, label int, id string, score int, vector int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND).repartition(partitions)


def plain(rows, every):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum(x * x for x in whole) < 2**62:
            kept.append((i, whole, label))
    out = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in kept if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in kept if j != i)
        for ps, j, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps]
            out += [(i, j, rank, k, -ps, -ns) for rank, (ns, k, _) in enumerate(fits[:5], 1)]
    return sorted(out)


def mined(df, every):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % every == 0).collect())


def vectors(n, seed, dims=6, labels=3):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [(i, [c + r.gauss(0, 0.4) for c in r.choice(centre)], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed, monkeypatch):
    rows = vectors(400, seed)
    assert mined(frame(spark, rows), 10) == plain(rows, 10) != []


def test_rounds_and_lists_change_nothing(spark, monkeypatch):
    rows = vectors(300, 3)
    for name, value in (("MAX_ROUND", 7), ("PER_CLUSTER", 9), ("SAMPLE", 12)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(frame(spark, rows), 10) == plain(rows, 10)


def test_walks_end_early():
    """Where directions are apart, members leave their lists long before the end, and still find what is there."""
    r = np.random.default_rng(5)
    centre = r.normal(size=(8, 16))
    group = r.integers(0, 8, 6000)
    vectors_ = np.floor(256 * (centre[group] * 3 + r.normal(size=(6000, 16)) * 0.1)).astype(np.int64)
    ids, labels = np.arange(6000), np.zeros(6000, np.int64)
    n = 60
    walk = hard_negatives.Walk(ids[:n], labels[:n], vectors_[:n], np.arange(n), np.full(n, -(2**62)), np.full(n, 2**62), True, hard_negatives.centres(vectors_[:n], 8))
    walk.block(ids, labels, vectors_)
    assert walk.walked < n * 6000 / 2
    query, row_id, score = walk.found()
    exact = vectors_[:n] @ vectors_.T
    for q in range(n):
        want = sorted((-exact[q, j], j) for j in range(6000) if j != q)[:5]
        assert [(-s, i) for s, i in zip(score[query == q], row_id[query == q])] == want


def test_odd_rows(spark):
    same = [0.5, 0.25]
    rows = [
        (None, same, 1), (0, same, None), (10, None, 1), (20, [0.1, None], 1), (30, [float("nan"), 1.0], 1), (40, [float("inf"), 1.0], 1),
        (50, [], 1), (60, [0.0, 0.0], 2), (70, same, 1), (70, same, 1), (80, [-0.5, -0.25], 1), (90, [3e30, 0.0], 1), (100, [1e6, -1e6], 1),
        *[(i, same, 1 + i % 2) for i in range(101, 140)], (141, [0.5], 2), (142, [0.5, 0.25, 9.0], 2), (143, same, 2), (143, same, 2), (145, [0.0, 0.0], 1), (146, [1e6, 1e6], 2),
    ]

    def padded(rows):
        return [(i, None if v is None else [*v, *[0.0] * (3 - len(v))], label) for i, v, label in rows]

    assert mined(frame(spark, rows), 10) == plain(padded(rows), 10)


def test_exact_where_doubles_are_not(spark):
    r = random.Random(4)
    rows = [(i, [r.choice([-1, 1]) * r.uniform(1e5, 9e5) for _ in range(5)], i % 2) for i in range(60)]
    assert mined(frame(spark, rows), 10) == plain(rows, 10)


def test_nothing_to_mine(spark):
    assert mined(frame(spark, []), 10) == []
    assert mined(frame(spark, [(1, [1.0], 1)]), 10) == []
    assert mined(frame(spark, [(10, [1.0], 1)]), 10) == []
    assert mined(frame(spark, [(10, [1.0], 1), (11, [1.0], 1)]), 10) == []
