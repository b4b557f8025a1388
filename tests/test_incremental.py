"""Loads touch only the parts they bring, and a run that stops half-way is made good by the next."""

import shutil

import pytest
from pyspark.sql import functions as F

from catalog import standins
from tapelake.operators import profile
from tapelake.operators.contract import FNM, FRE
from tapelake.plans import incremental, lakehouse
from tapelake.sources import tapes

SF = "/root/testdata/sf0.001"
LAYERS = ("gold/unified", "gold/marked", "gold/final", "profile/states")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    made = {"fnm": standins.fnm_tape(spark, SF), "orig": standins.orig_tape(spark, SF), "perf": standins.perf_tape(spark, SF), "index": standins.raw_index(spark, SF)}
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in made}


def load_fnm(spark, raw, root, archive, remainder, columns=()):
    rows = raw["fnm"].where(F.col("column001").cast("long") % 3 == remainder).withColumn("archive", F.lit(archive))
    for name, value in columns:
        rows = rows.withColumn(name, value)
    lakehouse.write_fnm_silver(spark, rows, f"{root}/silver/fnm")


@pytest.fixture
def lake(spark, raw, tmp_path):
    """Two archives, all quarters and the index, brought up to date once."""
    root = str(tmp_path / "lake")
    load_fnm(spark, raw, root, "a.zip", 0)
    load_fnm(spark, raw, root, "b: 1+1.zip", 1)
    some = F.col("quarter").isin("2005Q1", "2005Q2", "2006Q1")
    lakehouse.write_fre_silver(spark, raw["orig"].where(some), raw["perf"].where(some), f"{root}/silver/fre")
    lakehouse.write_index(spark, raw["index"], f"{root}/silver/index")
    made = incremental.Lake(spark, root)
    made.update()
    return made


def files(lake, layer):
    return {p.relative_to(lake.root) for p in __import__("pathlib").Path(lake.root, layer).rglob("*.parquet")}


def content(df):
    return sorted(map(str, df.collect()))


def whole(spark, raw, root):
    """The final table made in one piece from what lies in silver."""
    fnm = tapes.read_parts(spark, f"{root}/silver/fnm", incremental.FNM_SCHEMA, ("agency", "archive"))
    fre = tapes.read_parts(spark, f"{root}/silver/fre", incremental.FRE_SCHEMA, ("agency", "quarter"))
    gold = lakehouse.unify_tapes(fnm, fre)
    index = tapes.read_layer(spark, f"{root}/silver/index")
    return lakehouse.polish(incremental.mark_to_market(gold, index))


def test_a_load_replaces_its_parts_and_no_others(spark, raw, lake):
    assert content(lake.layer("gold/final")) == content(whole(spark, raw, lake.root))
    assert lake.layer("gold/final").columns == whole(spark, raw, lake.root).columns
    assert {n: u.replaced for n, u in lake.update().items()} == dict.fromkeys(LAYERS, [])
    before = {n: files(lake, n) for n in LAYERS}
    load_fnm(spark, raw, lake.root, "c.zip", 2)
    load_fnm(spark, raw, lake.root, "a.zip", 0, [("column011", F.lit("7"))])
    done = lake.update()
    for n in LAYERS:
        assert done[n].replaced == [(FNM, "a.zip"), (FNM, "c.zip")] and done[n].removed == []
        kept = {f for f in before[n] if "part=a.zip" not in str(f)}
        assert kept and kept <= files(lake, n)
        assert not {f for f in before[n] - kept} & files(lake, n)
    assert content(lake.layer("gold/final")) == content(whole(spark, raw, lake.root))


def test_only_the_files_of_stale_parts_are_read(spark, lake):
    one = lake._parts("gold/unified").where(incremental.of_parts([(FNM, "a.zip"), (FRE, "2005Q1")]))
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "a.zip" in text
    plan = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert {f.f.split("part=")[1].split("/")[0] for f in plan} == {"a.zip", "2005Q1"}


def test_a_run_that_stops_half_way(spark, raw, lake, monkeypatch):
    load_fnm(spark, raw, lake.root, "c.zip", 2)

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "polish", fails)
    with pytest.raises(RuntimeError, match="lost"):
        lake.update()
    monkeypatch.undo()
    shutil.rmtree(f"{lake.root}/state/gold/marked")  # and of what was written, the record was lost
    done = lake.update()
    assert done["gold/unified"].replaced == [] and (FNM, "c.zip") in done["gold/final"].replaced
    assert content(lake.layer("gold/final")) == content(whole(spark, raw, lake.root))


def test_a_part_that_leaves_silver_leaves_every_layer(spark, raw, lake):
    folder = next(p for p in __import__("pathlib").Path(lake.root, "silver/fnm").rglob("archive=*") if "1+1" in p.name)
    shutil.rmtree(folder)
    done = lake.update()
    assert all(done[n].removed == [(FNM, "b: 1+1.zip")] and done[n].replaced == [] for n in LAYERS)
    assert content(lake.layer("gold/final")) == content(whole(spark, raw, lake.root))
    assert lake.update() == dict.fromkeys(LAYERS, incremental.Update())


def test_a_part_without_rows_is_emptied(spark, tmp_path):
    df = spark.createDataFrame([("A", "x", 1), ("A", "y", 2)], "agency string, part string, n int")
    path, state = str(tmp_path / "layer"), str(tmp_path / "state")

    def inputs(v):
        return spark.createDataFrame([("A", "x", v), ("A", "y", "1")], "agency string, part string, version string")

    assert incremental.bring_up(inputs("1"), path, state, lambda _: df).replaced == [("A", "x"), ("A", "y")]
    assert incremental.bring_up(inputs("2"), path, state, lambda _: df.where("false")).replaced == [("A", "x")]
    assert [r.n for r in spark.read.parquet(path).collect()] == [2]


def test_the_index_marks_everything_anew_only_if_its_rows_differ(spark, raw, lake):
    lakehouse.write_index(spark, raw["index"].repartition(3), f"{lake.root}/silver/index")
    assert all(u.replaced == [] for u in lake.update().values())
    lakehouse.write_index(spark, raw["index"].withColumn("Index_NSA", F.col("Index_NSA") * 2), f"{lake.root}/silver/index")
    done = lake.update()
    assert done["gold/unified"].replaced == [] and len(done["gold/marked"].replaced) == 5


def test_the_profile_comes_from_states(spark, raw, lake):
    load_fnm(spark, raw, lake.root, "c.zip", 2)
    lake.update()
    final = lake.layer("gold/final")
    exact, merged = ({r.column_name: r for r in p.collect()} for p in (profile.numeric_profile(final), lake.numeric_profile()))
    assert set(exact) == set(merged) and len(merged) == 26
    n = final.count()
    for name, want in exact.items():
        got = merged[name]
        assert (got.null_count, got.min_value, got.max_value) == (want.null_count, want.min_value, want.max_value)
        assert (got.mean_value is None) == (want.mean_value is None) and abs((got.mean_value or 0) - (want.mean_value or 0)) <= 1e-9 * max(abs(want.mean_value or 0), 1)
        if got.median is not None:
            row = final.agg(F.count_if(F.col(name) < got.median).alias("below"), F.count_if(F.col(name) <= got.median).alias("to"), F.count(name).alias("n")).first()
            assert row.below <= 0.51 * row.n + 1 and row.to >= 0.49 * row.n - 1, name
    assert n > 0 and all("/profile/states/" in f for f in lake.numeric_profile().inputFiles())


def test_casts_are_counted_in_the_write(spark, raw, lake):
    load_fnm(spark, raw, lake.root, "d.zip", 2, [("column012", F.lit("x12")), ("column014", F.lit("132021")), ("column009", F.lit(" "))])
    lake.update()
    rows = raw["fnm"].where(F.col("column001").cast("long") % 3 == 2).count()
    found = {(r.agency, r.column_name): r.failures for r in lake.cast_status().collect()}
    assert found[FNM, "orig_term"] == found[FNM, "first_pay_date"] == rows
    assert (FNM, "orig_upb") not in found and not any(a == FRE for a, _ in found)
