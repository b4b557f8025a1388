import zipfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from tapelake.plans import lakehouse
from tapelake.session import configure
from tapelake.streaming.arrivals import append_marked, archive_arrivals, fnm_arrivals, load_archives


def line(loan, upb):
    values = {1: loan, 2: "022021", 9: "80", 11: upb, 14: "012021", 19: "80", 30: "TX"}
    return "|".join(values.get(i, "") for i in range(110)) + "\n"


def test_each_file_is_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    index = spark.createDataFrame(
        [("State", "TX", None, date(2021, 1, 1), 100.0, 1.0), ("State", "TX", None, date(2021, 2, 1), 110.0, 1.0)],
        "GEO_Type string, GEO_Name string, msa_code string, hpi_date date, index_nsa double, index_sa double",
    )

    def run():
        query = append_marked(fnm_arrivals(spark, str(landing)), index, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination(60)
        return sorted((r.loan_id, r.mtm_cltv) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    (landing / "a.csv").write_text(line("A", "55"))
    assert run() == [("A", 50.0)]
    (landing / "b.csv").write_text(line("B", "110"))
    assert run() == [("A", 50.0), ("B", 100.0)]
    assert run() == [("A", 50.0), ("B", 100.0)]


def test_fields_past_the_layout_are_kept(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    index = spark.createDataFrame([], "GEO_Type string, GEO_Name string, msa_code string, hpi_date date, index_nsa double, index_sa double")
    (landing / "a.csv").write_text(line("A", "55") + line("B", "55").strip() + "|new||field\n")
    append_marked(fnm_arrivals(spark, str(landing)), index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    got = {r.loan_id: r.beyond for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"A": None, "B": ["new", None, "field"]}


@pytest.fixture
def lake(spark, tmp_path):
    index = spark.createDataFrame([("State", "TX", 0, 2021, m, 100.0 + 10 * m, 1.0) for m in (1, 2)], "GEO_Type string, GEO_Name string, GEO_Code long, Year long, Month long, Index_NSA double, Index_SA double")
    root = str(tmp_path / "lake")
    lakehouse.write_index(configure(spark), index, f"{root}/silver/index")
    (tmp_path / "in").mkdir()

    def zipped(name, text):
        with zipfile.ZipFile(tmp_path / "in" / name, "w") as z:
            z.writestr("tape.csv", text)

    def run(archives_per_batch=1):
        arrivals = archive_arrivals(spark, str(tmp_path / "in"), archives_per_batch)
        query = load_archives(arrivals, "fnm", root, str(tmp_path / "state"))
        query.awaitTermination(120)

    def loans():
        return sorted((r.loan_id, r.mtm_cltv) for r in lakehouse.Lake(spark, root).layer("gold/final").collect())

    return root, zipped, run, loans


def test_archives_come_batch_by_batch(spark, lake):
    root, zipped, run, loans = lake
    zipped("a.zip", line("A", "55"))
    zipped("b.zip", line("B", "110"))
    run()
    assert [x for x, _ in loans()] == ["A", "B"]
    kept = {*Path(root, "gold/final").rglob("part=a.zip/*.parquet")}
    zipped("c.zip", line("C", "55") + line("D", "55"))
    run()
    assert [x for x, _ in loans()] == ["A", "B", "C", "D"]
    assert kept == {*Path(root, "gold/final").rglob("part=a.zip/*.parquet")} != set()
    status = spark.read.parquet(f"{root}/status/fnm").collect()
    assert sorted((r.source, r.status, r.row_count) for r in status) == [("a.zip", "loaded", 1), ("b.zip", "loaded", 1), ("c.zip", "loaded", 2)]
    assert len({r.batch for r in status}) == 3
    run()
    assert len(loans()) == 4


@pytest.mark.parametrize("broken", ["write_fnm_silver", "fnm_status"])
def test_a_failed_batch_is_made_good(lake, monkeypatch, broken):
    """Wherever a batch stops, before silver or after it, running again neither loses nor doubles a row."""
    root, zipped, run, loans = lake
    zipped("a.zip", line("A", "55"))
    zipped("b.zip", line("B", "55"))
    run(archives_per_batch=2)
    original = getattr(lakehouse, broken)

    def fails(*_, **__):
        raise RuntimeError("executor lost")

    zipped("c.zip", line("C", "55"))
    monkeypatch.setattr(lakehouse, broken, fails)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(lakehouse, broken, original)
    zipped("d.zip", line("D", "55"))
    run()
    assert [x for x, _ in loans()] == ["A", "B", "C", "D"]
