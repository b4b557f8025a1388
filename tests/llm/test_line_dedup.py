"""Line dedup against a plain version, on odd texts, and on one line that all documents share."""

from collections import Counter, defaultdict

from tapelake.llm import line_dedup

COMMON = "A line that every one of them holds"


def plain(pairs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\x20\t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders[key(x)]) < 3 or i == max(h for h in holders[key(x)] if h is not None)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def found(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"] or "") for r in line_dedup.find(df).collect())


def test_against_plain(documents, odd):
    nineteen, twenty = "x" * 19, "é" * 20
    pairs = odd + [
        (20, f"{COMMON}\n\nown\n{COMMON}\n"), (21, f"\t{COMMON.upper()} \nsecond own"), (22, f"{COMMON}"), (None, f"a\n{COMMON}\nb"),
        (23, f"{nineteen}\n{twenty}"), (24, f"{nineteen}\n{twenty}"), (25, f"{nineteen}\n{twenty}\r\n"), (25, f"{nineteen}\n{twenty}\r\n"),
        (26, "ÀÀÀ à line that is not ascii ÀÀ"), (27, "ààà à line that is not ascii àà"), (28, "ÀÀÀ à LINE that is not ascii ÀÀ"),
        (30, "twice in one document only\n" * 5), (31, "twice in one document only"),
    ]
    assert found(documents(pairs)) == Counter(plain(pairs))
    assert found(documents(pairs, partitions=1)) == Counter(plain(pairs))


def test_rows_of_one_document_count_once(documents):
    pairs = [(1, f"{COMMON}\na")] * 4 + [(2, COMMON)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.find(documents(pairs)).collect())


def test_a_line_in_every_document(documents):
    pairs = [(i, f"{COMMON}\nline of its own, number {i}\nshared by a few {i % 400:05d}") for i in range(3000)]
    assert found(documents(pairs, partitions=4)) == Counter(plain(pairs))


def test_a_text_of_many_lines_is_put_together_in_linear_time(documents):
    lines = [f"a line that stands in three texts {k}" for k in range(60_000)]
    text = "\n".join(x for k in lines for x in (k, "own"))
    got = {r["doc_id"]: r for r in line_dedup.find(documents([(i, text) for i in range(3)])).collect()}
    assert got[2]["kept"] == text
    assert got[0]["kept"] == got[1]["kept"] == "\n".join(["own"] * 60_000) and got[0]["n_dropped"] == 60_000


def test_clean_keeps_the_columns(documents, odd):
    docs = documents(odd + [(i, f"{COMMON}\n{i}") for i in range(50, 53)]).selectExpr("*", "1 AS place", "2 AS places", "'z' AS h1", "'k' AS keeper", "0 AS line")
    out = line_dedup.clean(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(odd) + 3
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows if (r["doc_id"] or 0) >= 50} == {50: ("50", 2), 51: ("51", 2), 52: (f"{COMMON}\n52", len(COMMON) + 3)}
    assert all(r["text"] is None and r["n_chars"] is None for r in rows if r["doc_id"] == 1)
    assert line_dedup.clean(documents([])).collect() == [] and line_dedup.find(documents([])).collect() == []
