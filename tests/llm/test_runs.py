"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tapelake.llm import queries, runs

SF = "/root/testdata/sf0.001"
SPACES = "\x20\t\n\x0b\x0c\r"


def plain_runs(words, least=runs.MIN_WORDS):
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def texts():
    r = random.Random(7)
    out = [[], [0], [0] * 11, [0] * 12, [0] * 200, [0, 1] * 6, [0, 1] * 5 + [0], list(range(40)) * 2, list(range(40)) * 2 + [0], [1, 2, 3] * 40 + [9] + [1, 2, 3] * 40]
    fib, other = [0], [0, 1]
    while len(other) < 200:
        fib, other = other, other + fib
    out += [other, [*other, *other, *other]]
    for _ in range(150):
        n, letters = r.randint(0, 120), r.choice([1, 2, 3, 8, 50])
        t = [r.randrange(letters) for _ in range(n)]
        if n and r.random() < 0.7:
            a = r.randrange(n)
            p = r.randint(1, max(1, (n - a) // 2))
            t[a:] = [t[a + (i - a) % p] for i in range(a, n)]
            if r.random() < 0.4:
                t[r.randrange(n)] = 77
        out.append(t)
    return out


@pytest.mark.parametrize("least", [2, 5, 12, 33])
def test_all_texts_at_once(least):
    cases = texts()
    flat, sizes = np.array([w for t in cases for w in t], np.int64), [len(t) for t in cases]
    starts = np.cumsum([0] + [n + 1 for n in sizes])
    got = [[] for _ in cases]
    for s, e, p in runs.runs(flat, sizes, least):
        i = np.searchsorted(starts, s, "right") - 1
        got[i].append((s - starts[i], e - starts[i], p))
    for t, g in zip(cases, got, strict=True):
        assert g == plain_runs(t, least), t


def test_equal_hashes_change_nothing(monkeypatch):
    """Blocks that a poor hash takes for copies are compared word by word."""
    monkeypatch.setattr(runs, "mix", lambda x: x % np.uint64(2))
    for t in texts()[:60]:
        assert runs.runs(np.array(t, np.int64), [len(t)]) == plain_runs(t)


def test_a_long_text_of_one_word():
    assert runs.runs(np.zeros(100_000, np.int64), [100_000]) == [(0, 100_000, 1)]


def test_the_query(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    some = 0
    for row in rows:
        words = "".join(" " if c in SPACES else c for c in row["text"] or "").split(" ")
        words = [w for w in words if w]
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain_runs(words)
        lost = {i for s, e, q in found for i in range(s + q, e)}
        r = got[row["doc_id"]]
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in lost).encode()).hexdigest()
        best = min(((s - e, s, q) for s, e, q in found), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        some += bool(found)
    assert some > 10


def test_odd_documents(spark, documents, odd):
    got = runs.find(documents(odd)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in odd)
    nines = next(r for r in got if r["doc_id"] == 9)
    assert [tuple(x) for x in nines["runs"]] == [(0, 3000, 1)] and nines["collapsed"] == "9"
    assert all(r["runs"] == [] and r["collapsed"] == "" for r in got if r["doc_id"] in (1, 2, 3))
    assert runs.find(documents([])).collect() == [] and runs.digest(documents([])).collect() == []
    clashing = documents(odd).selectExpr("*", "1 AS runs", "2 AS period", "3 AS collapsed")
    assert sorted(map(str, runs.find(clashing).collect())) == sorted(map(str, got))
