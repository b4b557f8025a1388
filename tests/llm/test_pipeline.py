"""The whole pipeline on a table with planted cases."""

import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")


def test_planted_cases(spark, documents, prose, tmp_path):
    import corpus_pipeline
    from tapelake.llm.packing import WordIds

    passage = " ".join(f"test{i}" for i in range(14))
    base = prose(1, 120)
    texts = {
        1: base,
        2: base,  # an exact copy
        3: base.replace(base.split()[60], "changed", 1),  # a near copy
        4: prose(4, 50) + "\n" + passage + "\n" + prose(5, 50),
        5: prose(6, 40) + " someone@mail.example.com " + prose(7, 40),
        6: "spam### " * 40,
        7: prose(8, 90),
        8: None,
    }
    documents(list(texts.items())).drop("node").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "personal data", "packing"]
    got = {(r["doc_id"], r["start"]): r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = {1: base, 4: prose(4, 50) + "\n" + prose(5, 50), 5: prose(6, 40) + " [EMAIL] " + prose(7, 40), 7: prose(8, 90)}
    assert {d for d, _ in got} == set(want)
    ids = WordIds(P.path("word_bpe_49k.json")).encode([t.encode() for t in want.values()])
    for d, x in zip(want, ids, strict=True):
        whole = x + np.array([1], "<u4").tobytes()
        pieces = sorted(k[1] for k in got if k[0] == d)
        assert sum(got[d, s]["length"] for s in pieces) * 4 == len(whole)
        assert all(got[d, s]["ids_crc32"] == zlib.crc32(whole[4 * s : 4 * (s + got[d, s]["length"])]) for s in pieces)


def test_the_last_stage_gives_token_ids(spark, documents, prose):
    import corpus_pipeline
    from tapelake.llm.packing import WordIds

    texts = {1: prose(1, 900), 2: prose(2, 40), 3: ""}
    rows = corpus_pipeline.packed(spark, documents(list(texts.items())), "").orderBy("doc_id", "start").collect()
    ids = WordIds(P.path("word_bpe_49k.json")).encode([t.encode() for t in texts.values()])
    for d, x in zip(texts, ids, strict=True):
        assert [i for r in rows if r["doc_id"] == d for i in r["ids"]] == [*np.frombuffer(x, "<u4"), 1]


def clashing(df):
    """Columns whose names the stages use themselves."""
    return df.selectExpr("*", "1 AS key", "2 AS place", "'x' AS bands", "3 AS spans", "4 AS hits", "5 AS window", "6 AS cls", "7 AS kept", "8 AS ids", "9 AS length")


def test_odd_documents_pass_every_stage(spark, documents, odd, prose, tmp_path):
    """Nulls, empty and very long texts, repeated rows, null ids and columns of any name: every stage has a defined result."""
    import corpus_pipeline

    good = [(100 + i, prose(100 + i, 90)) for i in range(3)]
    clashing(documents(odd + good + good[:1])).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.columns == names
        assert {(r["key"], r["cls"]) for r in docs.collect()} == {(1, 6)}
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {i: left[i] for i, _ in good} == dict(good)
    assert sum(r["doc_id"] == 100 for r in docs.collect()) == 1 and len({5, 6} & set(left)) == 1 and 7 in left
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_an_empty_table(spark, documents, tmp_path):
    import corpus_pipeline

    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
