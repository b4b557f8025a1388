"""Every operator on nulls, empty, blank, repeated and very long texts, on clashing extra columns and on empty tables."""

from collections import Counter

import pytest

from tapelake.llm import (
    chat_format,
    decontaminate,
    html_extract,
    near_duplicates,
    packing,
    personal_data,
    quality_gam,
    quality_rules,
    suffix_dedup,
    token_counts,
)

P = pytest.importorskip("public_tokenizers")
BPE, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (4, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")


@pytest.fixture(scope="module")
def label_rows(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, 0), (8, 0, 0), (9, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


def per_row(benchmark_items, label_rows):
    return {
        "score": lambda d: quality_gam.score(d, label_rows),
        "rules": quality_rules.judge,
        "personal": personal_data.digest,
        "decontaminate": lambda d: decontaminate.digest(d, benchmark_items),
        "suffix": suffix_dedup.find,
        "tokens": lambda d: token_counts.count(d, PIECES),
        "near": near_duplicates.find,
    }


@pytest.mark.parametrize("name", ["score", "rules", "personal", "decontaminate", "suffix", "tokens", "near"])
def test_one_row_per_document(documents, odd, benchmark_items, label_rows, name):
    operator = per_row(benchmark_items, label_rows)[name]
    assert Counter(r["doc_id"] for r in operator(documents(odd)).collect()) == Counter(i for i, _ in odd)
    assert operator(documents([])).collect() == []


def test_stages_keep_the_columns(documents, odd, benchmark_items):
    docs = documents(odd)
    for stage in (quality_rules.clean, near_duplicates.keep_first, lambda d: decontaminate.clean(d, benchmark_items), personal_data.redact):
        assert stage(docs).columns == docs.columns
        assert {r["node"] for r in stage(docs).collect()} <= {"kept"}
        assert stage(documents([])).collect() == []


def test_packing_gives_out_every_token_once(documents, odd):
    docs = documents(odd)
    assert packing.pack(documents([]), BPE).collect() == []
    rows = packing.pack(docs, BPE).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in odd}
    blank = [r for r in rows if r["doc_id"] in (1, 2, 3)]
    assert [(r["length"], r["ids"]) for r in blank] == [(1, [1])] * 3


def test_chats(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (2, 1, "user", "")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat_format.digest(chats).collect()}
    assert got == {None: (1, 0), 1: (3, 8), 2: (1, 0)}
    assert chat_format.digest(chats.limit(0)).collect() == []


def test_pages(spark):
    kind = "page_id long, url string, html string, text string"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>", "x"), (None, "u", "just text &am &amp; more", "x"), (4, "u", "<div " * 5000, "x"), (4, "u", "<div " * 5000, "x"), (5, "u", "<div>" * 3000 + "deep", "x")]
    got = html_extract.extract(spark.createDataFrame(rows, kind)).collect()
    assert len(got) == len(rows)
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] in (1, 2, 3)} == {1: "", 2: "", 3: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(spark.createDataFrame([], kind)).collect() == []


def test_digits_may_come_late_in_an_identifier(spark, documents):
    plain, parted = "q" * 80 + "1234", "x" * 70 + "-" + "y" * 20 + "5678"
    got = personal_data.occurrences(documents([(1, f"the key {plain} and {parted} end")])).first()
    assert [c["value"] for c in got["candidates"]] == [plain, parted]


def test_secrets_are_found_by_what_they_are_set_to(documents):
    key = [f"{i:02d}af03bc9d1e77aa{i * 7:04d}cd" for i in range(8)]
    said = [(i, f'some words then token = "{k}" and more') for i, k in enumerate(key)]
    alone = [(20, f"the same value {key[3]} alone")]
    by_context = [(30, "here token = 'Zx-1234-9' too"), (31, 'there token="Qy-5678-1"')]
    clean = [(40, "order a1b2c3d4e5f6a7b8c9d0e1 of the list"), (41, "the token was lost in 1987 and found in 2011"), (42, "version = 12.04.2020-beta1 is out")]
    got = {r["doc_id"]: r["spans"] for r in personal_data.digest(documents(said + alone + by_context + clean)).collect()}
    for i, text in said + alone:
        k = next(k for k in key if k in text)
        assert got[i] == f"id:{text.index(k)}:{text.index(k) + len(k)}"
    assert got[30] == "id:14:23" and got[31] == "id:13:22"
    assert got[40] == got[41] == got[42] == ""
    redacted = {r["doc_id"]: r["text"] for r in personal_data.redact(documents(said + alone + clean)).collect()}
    assert redacted[0] == 'some words then token = "[ID]" and more' and redacted[41] == dict(clean)[41]


def test_neighbouring_words_of_any_length(documents):
    word = "w" * 5000
    got = personal_data.occurrences(documents([(1, f'{word} = "ab12cd34ef" {word}')])).first()["candidates"][0]
    assert got["left"] == word + "=" and got["right"] == word


def test_text_of_elements_that_show_some(spark):
    html = "<body><article><p>Energy <math><mi>E</mi>=<mn>1</mn></math> holds, as was said.</p><p><noscript>Shown too.</noscript> <object>And this.</object></p></article></body>"
    got = html_extract.extract(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).first()["text"]
    assert got == "Energy E=1 holds, as was said.\nShown too. And this."
