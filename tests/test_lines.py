"""Lines of an archive's member, and the silver layer made of them."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tapelake.plans import lakehouse
from tapelake.sources import archives, tapes


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_lines_across_chunks(monkeypatch, chunk):
    monkeypatch.setattr(archives, "_CHUNK", chunk)
    text = "a|1\n\n\nbé|2\r\n\r\nc|\n|".encode()
    assert [x for lines in archives._line_batches(io.BytesIO(text)) for x in lines.to_pylist()] == ["a|1", "bé|2", "c|", "|"]
    assert archives._lines(b"\n\na\n\nb").to_pylist() == [b"a", b"b"]


def test_single_file_tapes_are_written_without_a_shuffle(spark, monkeypatch, tmp_path):
    asked = {}
    monkeypatch.setattr(lakehouse, "write_layer", lambda df, *a, **k: asked.update(k))
    monkeypatch.setattr(lakehouse.tapes, "read_parts", lambda *a: None)
    lakehouse.write_fnm_silver(spark, spark.range(3).selectExpr("cast(id as string) column001"), f"{tmp_path}/silver")
    assert not asked.get("rebalance")


def test_lines_split_in_batches_as_one_by_one(spark):
    odd = ["", "a", "a|b|c", "|", "a||c|d||", "é|\"x|\\|", " | ", "a|b\rc|\x00", None, "||||||", "1|2|3|"]
    lines = spark.createDataFrame([(str(i), v, i) for i, v in enumerate(odd)], "k string, value string, n long").repartition(3)
    got, want = (split(lines, 3, "|", before=("k",), after=("n",)) for split in (tapes.split_lines, tapes.split_fields))
    assert got.columns == want.columns
    assert sorted(got.collect(), key=lambda r: r.n) == sorted(want.collect(), key=lambda r: r.n)
    assert tapes.split_lines(lines.limit(0), 3).count() == 0


def test_a_member_of_120_000_lines_is_parsed_by_several_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("t.csv", "".join(f"{i}|x\n" for i in range(120_000)))
    bronze = archives.write_bronze(archives.archive_entries(spark, f"{tmp_path}/t.zip"), f"{tmp_path}/bronze", 2, "csv$")
    files = bronze.where("rows is null").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 120_000 and len(files) >= 3


def test_width_is_told_without_splitting_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a|b\n\n|||é\nx\n")
    assert tapes.tape_width(spark, str(tmp_path / "t.csv")) == 4
    asked = []
    split = tapes.F.split
    tapes.F.split = lambda *a: asked.append(a) or split(*a)
    try:
        assert tapes.tape_width(spark, str(tmp_path / "t.csv")) == 4 and not asked
        (tmp_path / "u.csv").write_text("a::b::c:d\n")
        assert tapes.tape_width(spark, str(tmp_path / "u.csv"), "::") == 3
    finally:
        tapes.F.split = split
