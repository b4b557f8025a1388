"""Near duplicates where one bucket holds very many texts."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tapelake.llm import near_duplicates


def words(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 10**9, n)]


@pytest.fixture
def alike():
    """Texts that share a passage of half their words, and among them pairs that are similar."""
    passage = words(0, 60)
    texts = {i: " ".join(passage + words(1000 + i, 60)) for i in range(300)}
    for i in range(0, 40, 2):
        changed = texts[i].split()
        changed[100] = "changed"
        texts[i + 1] = " ".join(changed)
    return texts


def classes(df):
    out = defaultdict(set)
    for r in near_duplicates.find(df).collect():
        out[r["class_id"]].add(r["doc_id"])
    return sorted(map(sorted, out.values()))


def test_crowded_buckets_lose_no_link(documents, alike, monkeypatch):
    want = sorted([i, i + 1] if i % 2 == 0 and i < 40 else [i] for i in alike if i >= 40 or i % 2 == 0)
    # All texts in one bucket of one band more than they would be.
    original = near_duplicates._row_signatures

    def one_bucket(batch):
        out = original(batch)
        out["bands"] = [None if b is None else np.concatenate(([7], b[1:])) for b in out["bands"]]
        return out

    monkeypatch.setattr(near_duplicates, "_row_signatures", one_bucket)
    monkeypatch.setattr(near_duplicates, "BLOCK", 50)
    refined, rows = near_duplicates._refined, []

    def seen(members, elements):
        out = near_duplicates.written(refined(members, elements), "seen")
        rows.append((members.count(), out.count(), out.filter("size > 50").count()))
        return out

    monkeypatch.setattr(near_duplicates, "_refined", seen)
    assert classes(documents(list(alike.items()))) == want
    # 300 nodes with 116 shingles each: a fifth of them at most, and what all share puts no one into a crowded bucket again.
    ((members, dealt, crowded),) = rows
    assert members >= 300 and dealt <= 300 * 25 and crowded == 0


def test_a_rejected_pair_hides_no_other(monkeypatch):
    """Classes are joined by exact overlap alone: a pair below the threshold leaves both classes free for others."""
    base = np.sort(np.random.default_rng(1).integers(0, 2**62, 100).astype(np.uint64))
    other = base.copy()
    other[:15] = np.arange(15, dtype=np.uint64)  # 85 of 115: 0.74
    near = base.copy()
    near[:5] = np.arange(100, 105, dtype=np.uint64)  # 95 of 105 with the first
    sets = [np.sort(x) for x in (base, other, near)]
    n = len(sets)
    group = pa.table(
        {
            "bucket": [1] * n, "band": [0] * n, "block_i": [0] * n, "block_j": [0] * n, "block": [0] * n, "node": [b"a", b"b", b"c"], "cls": [b"a", b"b", b"c"],
            "weight": [100] * n, "sketch": [bytes(96)] * n, "bands": pa.array([[0] * 24] * n, pa.list_(pa.int64())), "shingles": [x.tobytes() for x in sets],
        }
    )
    assert near_duplicates._similar(group) == ([b"a"], [b"c"])


def test_groups_across_batches():
    keys, values = [1, 1, 2, 2, 2, 3], [10, 11, 12, 13, 14, 15]
    for cuts in ([6], [1, 5], [2, 4], [1, 1, 1, 1, 1, 1], [3, 0, 3], [0, 6]):
        batches, at = [], 0
        for c in cuts:
            batches.append(pa.RecordBatch.from_pydict({"k": pa.array(keys[at : at + c], pa.int64()), "v": pa.array(values[at : at + c], pa.int64())}))
            at += c
        got = [t.column("v").to_pylist() for t in near_duplicates._groups(iter(batches), ["k"])]
        assert got == [[10, 11], [12, 13, 14], [15]], cuts
