"""Archives as a data source: what filters open, and that nothing is lost on the way."""

import io
import zipfile

import pytest

from tapelake.session import configure
from tapelake.sources import archives, tapes, tapezip


def line(loan, width=32):
    return "|".join(loan if i in (0, 19) else "" for i in range(width))


def nested(path, members, outer=zipfile.ZIP_STORED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    with zipfile.ZipFile(path, "w", outer) as z:
        z.writestr("inner.zip", buffer.getvalue())


@pytest.fixture
def folder(tmp_path):
    for year in (2021, 2022):
        members = {f"historical_data_{k}{year}Q{q}.txt": f"{line(f'{k}{year}{q}')}|more\n\n{line('second')}\r\n" for k in ("", "time_") for q in (1, 2)}
        nested(tmp_path / f"tapes_{year}.zip", members, zipfile.ZIP_DEFLATED if year == 2022 else zipfile.ZIP_STORED)
    with zipfile.ZipFile(tmp_path / "single.zip", "w") as z:
        z.writestr("tape.csv", line("F") + "\n")
        z.writestr("latin.csv", b"ok|\ncaf\xe9|\n")
    (tmp_path / "damaged.zip").write_bytes(b"this is no archive\n" * 100)
    return tmp_path


@pytest.fixture
def opened(monkeypatch):
    names = []
    original = archives._open
    monkeypatch.setattr(archives, "_open", lambda stack, archive: (names.append(archive.rsplit("/", 1)[-1]), original(stack, archive))[1])
    return names


def table(spark, folder, **options):
    configure(spark)
    tapezip.register(spark)
    return spark.read.format("tapezip").options(**options).load(str(folder))


def test_all_lines_and_outcomes(spark, folder):
    rows = table(spark, folder).collect()
    fields = [(r.source, r.agency, r.kind, r.quarter) for r in rows if r.value and r.value.endswith("|more")]
    assert sorted(fields) == [(f"tapes_{y}.zip", "freddie", k, f"{y}Q{q}") for y in (2021, 2022) for k in ("origination", "performance") for q in (1, 2)]
    outcomes = {(r.source, r.member): (r.rows, r.error and r.error.split(":")[0]) for r in rows if r.rows is not None}
    assert outcomes["single.zip", "tape.csv"] == (1, None) and outcomes["damaged.zip", None] == (0, "BadZipFile")
    assert outcomes["single.zip", "latin.csv"][1] == "ArrowInvalid" and outcomes["tapes_2022.zip", "historical_data_2022Q1.txt"] == (2, None)
    assert len(outcomes) == 11


def test_it_equals_bronze(spark, folder):
    bronze = archives.write_bronze(archives.archive_entries(spark, str(folder)), str(folder / "bronze"), 32, tapes.QUARTER_PATTERN)
    want = sorted(map(str, archives.rows_of(bronze, archives.outcomes(bronze)).select("member", *tapes.FRE_FIELDS, "beyond").collect()))
    got = tapezip.read_zipped(spark, str(folder), 32).where("agency = 'freddie'")
    assert sorted(map(str, got.select("member", *tapes.FRE_FIELDS, "beyond").collect())) == want and len(want) == 16


def test_filters_are_pushed(spark, folder):
    df = tapezip.read_zipped(spark, str(folder), 32).where("quarter IN ('2021Q1', '2022Q2') AND kind = 'performance' AND column00 <> ''")
    assert sorted((r.quarter, r.column00) for r in df.collect()) == [("2021Q1", "second"), ("2021Q1", "time_20211"), ("2022Q2", "second"), ("2022Q2", "time_20222")]
    assert df.rdd.getNumPartitions() == 3  # a member, a nested zip that has to be inflated, and the archive that cannot be opened


def test_only_matching_archives_are_opened(folder, opened):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    def members(vintages, *filters):
        opened.clear()
        reader = tapezip.TapeZipReader(str(folder), vintages)
        left = list(reader.pushFilters([*filters]))
        found = [(e.archive.rsplit("/", 1)[-1], e.member) for e in reader.partitions() if e.error is None]
        return left, found, set(opened)

    assert members(False, EqualTo(("source",), "single.zip"))[1:] == ([("single.zip", "tape.csv"), ("single.zip", "latin.csv")], {"single.zip"})
    left, found, names = members(True, EqualTo(("quarter",), "2021Q2"), In(("kind",), ("performance",)), GreaterThan(("value",), "a"))
    assert [type(f).__name__ for f in left] == ["GreaterThan"]
    assert found == [("tapes_2021.zip", "historical_data_time_2021Q2.txt")] and "tapes_2022.zip" not in names
    assert "tapes_2022.zip" in members(False, EqualTo(("quarter",), "2021Q2"))[2]
    assert members(True, EqualTo(("agency",), "fannie"), EqualTo(("agency",), "freddie"))[1] == [("tapes_2022.zip", None)]


def test_nothing_there(spark, tmp_path):
    assert table(spark, tmp_path).collect() == []
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    assert table(spark, tmp_path).collect() == []
