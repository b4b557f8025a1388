import io
import time
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import files
from tapelake.plans import lakehouse
from tapelake.session import shared_folder
from tapelake.sources import archives, sinks, tapes


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def nested_zip(path, members, inner="inner.zip"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    with zipfile.ZipFile(path, "w") as outer:
        outer.writestr(inner, buffer.getvalue())


def orig_line(loan):
    return "|".join("" if i != 19 else loan for i in range(32))


def perf_line(loan, month):
    return "|".join({0: loan, 1: month}.get(i, "") for i in range(32))


def test_text_rules(spark, folder):
    (folder / "t.csv").write_text('a||" x"|\n\nb| |2|"\n')
    tape = tapes.read_tape(spark, str(folder / "t.csv"))
    assert tape.columns == ["column0", "column1", "column2", "column3"]
    rows = [("a", None, '" x"', None), ("b", " ", "2", '"')]
    assert [tuple(r) for r in tape.collect()] == rows
    with zipfile.ZipFile(folder / "t.zip", "w") as z:
        z.write(folder / "t.csv", "t.csv")
    bronze = archives.write_bronze(archives.archive_entries(spark, str(folder / "t.zip")), str(folder / "bronze"), 4, "csv$")
    assert [tuple(r) for r in archives.rows_of(bronze, archives.outcomes(bronze)).select(tape.columns).collect()] == rows


def test_wider_lines_lose_nothing(spark, folder):
    (folder / "t.csv").write_text("a|1\nb|2|3|more\nc\n")
    assert [tuple(r) for r in tapes.read_tape(spark, str(folder / "t.csv")).collect()] == [("a", "1", None, None), ("b", "2", "3", "more"), ("c", None, None, None)]
    assert [(r.line, r.fields) for r in tapes.too_wide(spark, str(folder / "t.csv"), 2).collect()] == [("b|2|3|more", 4)]
    with zipfile.ZipFile(folder / "t.zip", "w") as z:
        z.write(folder / "t.csv", "t.csv")
    bronze = archives.write_bronze(archives.archive_entries(spark, str(folder / "t.zip")), str(folder / "bronze"), 2, "csv$")
    got = archives.rows_of(bronze, archives.outcomes(bronze)).select("column0", "column1", "beyond").collect()
    assert [tuple(r) for r in got] == [("a", "1", None), ("b", "2", ["3", "more"]), ("c", None, None)]


def test_fields_past_the_layout_reach_fre_silver(spark, folder):
    names = ("historical_data_2021Q1.txt", "historical_data_time_2021Q1.txt")
    members = dict(zip(names, (orig_line("A") + "|x||y\n" + orig_line("B"), perf_line("A", "202101") + "\n\n" + perf_line("A", "202102") + "|z\r\n"), strict=True))
    (folder / "zip").mkdir()
    nested_zip(folder / "zip/year.zip", members)
    for name, text in members.items():
        (folder / name).write_bytes(text.encode())
    want = {("A", "202101", ("x", None, "y"), None), ("A", "202102", ("x", None, "y"), ("z",)), ("B", None, None, None)}
    for way, (orig, perf, *_) in {
        "archives": lakehouse.read_fre_archives(archives.archive_entries(spark, str(folder / "zip")), str(folder / "bronze")),
        "files": lakehouse.read_fre_files(spark, str(folder)),
    }.items():
        path = str(folder / way)
        earlier = orig.select(F.lit("freddie").alias("agency"), F.lit("1999Q1").alias("quarter"), *tapes.FRE_FIELDS)
        sinks.write_layer(earlier, path, sinks.SNAPPY, ("agency", "quarter"))  # a load of before there were such columns
        silver = lakehouse.write_fre_silver(spark, orig, perf, path).where("quarter = '2021Q1'")
        got = [(r.column19, r.column01_1, r.beyond and tuple(r.beyond), r.beyond_1 and tuple(r.beyond_1)) for r in silver.collect()]
        assert len(got) == 3 and set(got) == want


def test_field_names():
    assert tapes.FRE_FIELDS[0] == "column00" and tapes.FRE_FIELDS[-1] == "column31"
    assert tapes.FNM_FIELDS[0] == "column000" and tapes.FNM_FIELDS[-1] == "column109"


def test_quarter_from_file_name(spark, folder):
    (folder / "historical_data_2021Q1.txt").write_text(orig_line("A") + "\n")
    (folder / "historical_data_time_2021Q1.txt").write_text(perf_line("A", "202101") + "\n" + perf_line("A", "202102") + "\n")
    (folder / "historical_data_2021Q2.txt").write_text(orig_line("B") + "\n")
    orig, perf = lakehouse.read_fre_files(spark, str(folder))
    assert sorted(r.quarter for r in orig.collect()) == ["2021Q1", "2021Q2"]
    quarters = lakehouse.file_quarters(spark, str(folder))
    silver = lakehouse.write_fre_silver(spark, orig, perf, str(folder / "silver"), quarters)
    got = {r.source: (r.status, r.row_count) for r in lakehouse.ingest_status(orig, silver).collect()}
    assert got == {"2021Q1": ("loaded", 2), "2021Q2": ("no performance file", 0)}
    assert {(r.agency, r.column19, r.column01_1) for r in silver.collect()} == {("freddie", "A", "202101"), ("freddie", "A", "202102")}


def test_archives(spark, folder):
    nested_zip(
        folder / "year.zip",
        {
            "historical_data_2021Q1.txt": orig_line("A") + "\r\n" + orig_line("B"),
            "historical_data_time_2021Q1.txt": perf_line("A", "202101") + "\n",
        },
    )
    with zipfile.ZipFile(folder / "flat.zip", "w") as z:
        z.writestr("one.csv", "x|1\ny|2\n")
        z.writestr("two.csv", "z|3\n")
    (folder / "broken.zip").write_bytes(b"nothing here")
    good = (folder / "year.zip").read_bytes()
    (folder / "cut.zip").write_bytes(good[: len(good) // 2])
    with zipfile.ZipFile(folder / "damaged.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("bad.csv", "payload payload payload\n")
    raw = (folder / "damaged.zip").read_bytes()
    (folder / "damaged.zip").write_bytes(raw.replace(b"payload payload", b"payload-payload", 1))

    (folder / "fnm").mkdir()
    for name in ("flat.zip", "damaged.zip"):
        (folder / name).rename(folder / "fnm" / name)
    with zipfile.ZipFile(folder / "fnm/latin.zip", "w") as z:
        z.writestr("good.csv", "g|1\n")
        z.writestr("bad.csv", b"caf\xe9|1\n")
    orig, perf, found = lakehouse.read_fre_archives(archives.archive_entries(spark, f"{folder}/*.zip"), str(folder / "bronze"))
    assert {(r.archive.rsplit("/", 1)[1], r.status) for r in found.collect()} == {("year.zip", "read"), ("broken.zip", "failed"), ("cut.zip", "failed")}
    assert sorted((r.quarter, r.column19) for r in orig.collect()) == [("2021Q1", "A"), ("2021Q1", "B")]
    assert [(r.quarter, r.column00, r.column01) for r in perf.collect()] == [("2021Q1", "A", "202101")]
    silver = lakehouse.write_fre_silver(spark, orig, perf, str(folder / "silver"), lakehouse.member_quarters(found))
    rows = {r.source: (r.status, r.row_count) for r in lakehouse.ingest_status(orig, silver, found).collect()}
    assert rows == {"2021Q1": ("loaded", 2), "broken.zip": ("failed", 0), "cut.zip": ("failed", 0)}

    fnm, single = lakehouse.read_fnm_archives(archives.archive_entries(spark, f"{folder}/fnm"), str(folder / "bronze-fnm"))
    assert sorted((r.archive, r.column000, r.column001) for r in fnm.collect()) == [("flat.zip", "x", "1"), ("flat.zip", "y", "2"), ("flat.zip", "z", "3")]
    status = {r.source: (r.status, r.row_count, r.error) for r in lakehouse.fnm_status(single).collect()}
    assert status["flat.zip"] == ("loaded", 3, None)
    assert status["damaged.zip"][:2] == status["latin.zip"][:2] == ("failed", 0)
    assert "CRC" in status["damaged.zip"][2] and "UTF8" in status["latin.zip"][2]


def test_loads_keep_other_archives_and_replace_their_own(spark, folder):
    def load(**members):
        (folder / "in").mkdir(exist_ok=True)
        for old in (folder / "in").iterdir():
            old.unlink()
        for name, text in members.items():
            with zipfile.ZipFile(folder / "in" / f"{name}.zip", "w") as z:
                z.writestr("tape.csv", text)
        rows, _ = lakehouse.read_fnm_archives(archives.archive_entries(spark, f"{folder}/in"), str(folder / "bronze"))
        silver = lakehouse.write_fnm_silver(spark, rows, str(folder / "silver"))
        return sorted((r.archive, r.column000) for r in silver.collect())

    assert load(a="1|\n") == [("a.zip", "1")]
    assert load(b="2|\n") == [("a.zip", "1"), ("b.zip", "2")]
    assert load(a="3|\n4|\n") == [("a.zip", "3"), ("a.zip", "4"), ("b.zip", "2")]
    assert load(a=b"caf\xe9|\n") == [("a.zip", "3"), ("a.zip", "4"), ("b.zip", "2")]


def test_a_quarter_in_two_archives_is_read_once(spark, folder):
    for name in ("old", "new"):
        nested_zip(folder / f"{name}.zip", {"historical_data_2021Q1.txt": orig_line("A"), "historical_data_time_2021Q1.txt": perf_line("A", f"20210{len(name)}")})
    orig, perf, found = lakehouse.read_fre_archives(archives.archive_entries(spark, str(folder)), str(folder / "bronze"))
    silver = lakehouse.write_fre_silver(spark, orig, perf, str(folder / "silver"), lakehouse.member_quarters(found))
    assert [(r.column19, r.column01_1) for r in silver.collect()] == [("A", "202103")]
    assert sorted((r.archive.rsplit("/", 1)[1], r.status) for r in found.collect()) == [("new.zip", "superseded")] * 2 + [("old.zip", "read")] * 2


def big_nested(folder, lines=3000, files=8):
    """An archive whose nested zip is deflated too."""
    import random

    line = "|".join(str(random.Random(1).random()) for _ in range(40)) + "\n"
    nested_zip(folder / "n.zip", {f"historical_data_2021Q{i}.txt": line * lines for i in range(files)})
    with zipfile.ZipFile(folder / "n.zip") as outer:
        inner = outer.read("inner.zip")
    with zipfile.ZipFile(folder / "n.zip", "w", zipfile.ZIP_DEFLATED) as outer:
        outer.writestr("inner.zip", inner)
    return inner


def test_a_nested_zip_is_inflated_once(folder, monkeypatch):
    inner = big_nested(folder)
    passed = []
    read = zipfile.ZipExtFile._read1

    def counted(self, n):
        data = read(self, n)
        passed.append(len(data) if self.name == "inner.zip" else 0)
        return data

    # ``_read1`` is where a member's bytes are inflated.
    monkeypatch.setattr(zipfile.ZipExtFile, "_read1", counted)
    entry = pa.RecordBatch.from_pylist([{"archive": f"file://{folder}/n.zip", "entry": "inner.zip", "bytes": 1, "deflated": True, "error": None}])
    members = [*archives._rows_of_tasks(archives._list_members(f"{folder}/nested"), archives.MEMBER_SCHEMA)(iter([entry]))]
    assert sum(b.num_rows for b in members) == 8 and sum(passed) == len(inner)
    batches = [*archives._inflate(iter(members))]
    assert sum(b.num_rows for b in batches) == 8 * 3001 and not any(b.column("error").drop_null() for b in batches)
    assert sum(passed) == len(inner)


def test_one_large_member_is_parsed_by_many_tasks(spark, folder):
    big_nested(folder, lines=2000, files=1)
    entries = archives.archive_entries(spark, str(folder / "n.zip"))
    members = archives.entry_members(entries)
    lines = archives.member_lines(members, chunk_lines=250)
    assert members.count() == 1 and len(lines.inputFiles()) == 9
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)  # a task per file, as with large ones
    try:
        bronze = archives.write_parsed(lines, str(folder / "bronze"), 40)
        tasks = tapes.split_fields(lines, 40).select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert tasks == 9 and len(bronze.inputFiles()) >= 8
    assert archives.rows_of(bronze, archives.outcomes(bronze)).count() == 2000
    assert [(r["rows"], r["error"]) for r in archives.outcomes(bronze).collect()] == [(2000, None)]


def test_a_load_leaves_no_lines_and_no_inflated_zips(spark, folder):
    big_nested(folder, lines=200, files=2)
    scratch = Path(shared_folder(spark, "x")).parent
    before = {*scratch.glob("lines-*"), *scratch.glob("nested-*")}
    bronze = archives.write_bronze(archives.archive_entries(spark, str(folder / "n.zip")), str(folder / "bronze"), 40, "txt$")
    assert not {*scratch.glob("lines-*"), *scratch.glob("nested-*")} - before
    assert archives.rows_of(bronze, archives.outcomes(bronze)).count() == 400


def test_text_that_is_used_up_goes_once_it_is_zipped(spark, folder):
    tape = spark.createDataFrame([("a", "1"), ("b", "2")], "column0 string, column1 string")
    for used_up in (False, True):
        text, out = folder / f"text{used_up}", folder / f"zip{used_up}"
        files.write_text(tape, tape.columns, f"{text}/file=tape.csv", packed=True)
        files.zip_parts(spark, str(text), str(out), F.lit("whole"), used_up=used_up)
        assert text.exists() != used_up
        bronze = archives.write_bronze(archives.archive_entries(spark, str(out)), f"{out}-bronze", 2, "csv$")
        rows = archives.rows_of(bronze, archives.outcomes(bronze)).select(*tape.columns).collect()
        assert sorted(map(tuple, rows)) == [("a", "1"), ("b", "2")]


def test_shuffle_files_go_with_their_query(spark, folder):
    def there():
        stored = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f.rsplit("/", 1)[1] for f in stored.split(",") if "/shuffle_" in f}

    before = there()
    spark.range(1000).repartition(3, "id").write.parquet(str(folder / "dealt"))
    until = time.time() + 20
    while (left := there() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.read.parquet(str(folder / "dealt")).count() == 1000


def test_bronze_keeps_the_history_of_other_archives(spark, folder):
    def load(name, text):
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("tape.csv", text)
        bronze = archives.write_bronze(archives.archive_entries(spark, str(folder / name)), str(folder / "bronze"), 2, "csv$")
        return sorted((r.source, r.column0) for r in archives.rows_of(bronze, archives.outcomes(bronze)).collect())

    def files(name):
        return {f.name for f in (folder / "bronze" / f"source={name}").glob("*.parquet")}

    assert load("a.zip", "1|\n") == [("a.zip", "1")]
    kept = files("a.zip")
    assert load("007.zip", "2|\n") == [("007.zip", "2")]
    assert files("a.zip") == kept != set()
    assert load("a.zip", "3|\n4|\n") == [("a.zip", "3"), ("a.zip", "4")]
    assert files("007.zip") and not files("a.zip") & kept


def test_index_csv(spark, folder):
    (folder / "i.csv").write_text("GEO_Type,GEO_Name,GEO_Code,Year,Month,Index_NSA,Index_SA\nCBSA,\"Austin, TX\",12420,2021,1,1.5,2\nUS,USA,,2021,1,1,1\n")
    rows = [tuple(r) for r in tapes.read_index_csv(spark, str(folder / "i.csv")).collect()]
    assert rows == [("CBSA", "Austin, TX", 12420, 2021, 1, 1.5, 2.0), ("US", "USA", None, 2021, 1, 1.0, 1.0)]


def test_partition_overwrite_and_codec(spark, folder):
    path = str(folder / "layer")
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    sinks.write_layer(df, path, sinks.ZSTD, ("part",), rebalance=True)
    sinks.write_layer(df.where("part = 1 AND id < 4"), path, sinks.ZSTD, ("part",))
    assert sorted(r.id for r in tapes.read_layer(spark, path).collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert list((folder / "layer").glob("part=0/*.zstd.parquet"))
    count = tapes.footprint(spark, path).first()
    assert count.files >= 2 and count.bytes > 0


def test_shared_folder_is_the_configured_one(spark):
    first, second = shared_folder(spark, "a"), shared_folder(spark, "a")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_data_can_be_removed(spark):
    import os

    from tapelake.session import discard

    class Other:
        """The same session, as another application."""

        conf, _jvm, _jsc = spark.conf, spark._jvm, spark._jsc

        class sparkContext:  # noqa: N801
            applicationId = "app-other"

    kept, gone = shared_folder(spark, "kept"), shared_folder(Other, "gone")
    for path in (kept, gone):
        spark.range(1).write.parquet(path)
    discard(Other)
    assert spark.read.parquet(kept).count() == 1 and not os.path.exists(gone.removeprefix("file:"))


def test_no_local_folder_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://host:7077"}.get(key, default)

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session, "x")
