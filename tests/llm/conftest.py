import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with an extra column whose name operators could use themselves."""

    def make(pairs, partitions=2):
        rows = [(i, t, "en", "src0", len(t) if t is not None else None, "kept") for i, t in pairs]
        return spark.createDataFrame(rows, f"{DOCS}, node string").coalesce(partitions)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of made-up words: ``prose(seed, n)``."""

    def make(seed, n):
        r = random.Random(seed)
        words = ["".join(r.choice(["an", "to", "re", "in", "é", "st", "ou", "X"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
        return " ".join(w + ("." if k % 9 == 8 else "") + ("\n" if k % 27 == 26 else "") for k, w in enumerate(words)) + "."

    return make


@pytest.fixture(scope="session")
def odd(prose):
    """Pairs that no operator may stumble over: nulls, empty and blank texts, repeated rows, ties, a very long text."""
    long_ = prose(99, 30_000)
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (5, prose(5, 80)), (6, prose(5, 80)), (None, "no id, but a text of some words."), (None, None), (7, long_), (8, "a" * 50_000), (9, "9 " * 3000), (4, "another text with the same id")]
