"""The plans are the ones meant: where data is shuffled, broadcast and scanned."""

import pytest
from pyspark.sql import functions as F

from catalog import queries, standins
from tapelake.operators import profile
from tapelake.operators.canonical import unify_tapes
from tapelake.operators.polish import polish
from tapelake.operators.price_index import standardise
from tapelake.operators.tape_join import join_performance
from tapelake.operators.valuation import mark_to_market
from tapelake.plans import lakehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    parts = {
        "fnm": standins.fnm_tape(spark, SF),
        "orig": standins.orig_tape(spark, SF),
        "perf": standins.perf_tape(spark, SF),
        "index": standins.raw_index(spark, SF),
    }
    for name, df in parts.items():
        df.write.parquet(f"{root}/{name}")
    raw = {name: spark.read.parquet(f"{root}/{name}") for name in parts}
    raw["final"] = lakehouse.refresh(spark, raw["fnm"], raw["orig"], raw["perf"], raw["index"], f"{root}/lake")
    raw["fre"] = spark.read.parquet(f"{root}/lake/silver/fre")
    raw["gold"] = spark.read.parquet(f"{root}/lake/gold/unified")
    return raw


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unify_and_polish_do_not_shuffle(layers):
    assert "Exchange" not in plan(unify_tapes(layers["fnm"], layers["fre"]))
    marked = polish(mark_to_market(layers["gold"], standardise(layers["index"])).drop("x"))
    assert "Exchange" not in plan(marked).split("BroadcastExchange")[0]


def test_marking_broadcasts_twice(layers):
    text = plan(mark_to_market(layers["gold"], standardise(layers["index"])))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    # What is shuffled is the index, into a row per geography.
    loans, *series = text.split("BroadcastExchange")
    assert len(series) == 2 and "hashpartitioning" not in loans and all("prop_state" not in s.split("hashpartitioning")[1] for s in series)


def test_marking_falls_back_beyond_the_bound(spark, layers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(mark_to_market(layers["gold"], standardise(layers["index"]), max_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in text


def test_marking_keeps_every_row(layers):
    gold = layers["gold"]
    assert layers["final"].count() == gold.count() == layers["fnm"].count() + layers["fre"].count()


def test_numeric_profile_scans_once(layers):
    text = plan(profile.numeric_profile(layers["final"]))
    assert text.count("FileScan") == 1
    assert len(profile.numeric_columns(layers["final"])) == 26
    assert len(profile.text_columns(layers["final"])) == 20


def test_profile_reads_only_its_columns(layers):
    text = plan(profile.numeric_profile(layers["final"], ["loan_age"]))
    assert "ReadSchema: struct<loan_age:int>" in text


def test_categorical_profile_limits_before_the_shuffle(layers):
    text = plan(profile.categorical_profile(layers["final"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filter_reaches_the_scan(layers):
    assert "PushedFilters: [IsNotNull(loan_age), GreaterThanOrEqual(loan_age,1)]" in plan(layers["final"].where("loan_age >= 1"))


def test_hot_loan_side_can_be_split(spark, layers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(join_performance(layers["orig"], layers["perf"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Inner" in text and "LeftAnti" in text and "LeftOuter" not in text


def test_no_query_joins_without_a_key(spark):
    for name in ("mtm_enrich", "profile_categorical", "count_by_geo_type", "agency_split"):
        text = plan(queries.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_a_duplicate_index_key_stops_the_load(spark, layers, tmp_path):
    with pytest.raises(ValueError, match="State"):
        lakehouse.write_index(spark, layers["index"].union(layers["index"].where("GEO_Type = 'State'").limit(1)), f"{tmp_path}/index")


def test_the_job_reads_each_archive_once_and_writes_the_report(spark, tmp_path):
    from tapelake import job
    from tapelake.sources import tapes

    queries._zipped_fre(spark, SF, f"{tmp_path}/fre")
    queries._zipped_fnm(spark, standins.fnm_tape(spark, SF), f"{tmp_path}/fnm")
    standins.raw_index(spark, SF).write.csv(f"{tmp_path}/index", header=True)
    job.run(spark, f"{tmp_path}/fnm/zip", f"{tmp_path}/fre/zip", f"{tmp_path}/index", f"{tmp_path}/lake")
    for name in job.BLOCKS:
        assert spark.read.parquet(f"{tmp_path}/lake/profile/{name}").count() > 0
    status = {r.status for r in spark.read.parquet(f"{tmp_path}/lake/status").collect()}
    assert status == {"loaded"}
    bronze = spark.read.parquet(f"{tmp_path}/lake/bronze/fre")
    members = lakehouse.fre_members(bronze).where("kind = 'performance'")
    orig = bronze.select(tapes.quarter_of_path(F.col("member")).alias("quarter"), *tapes.FRE_FIELDS)
    text = plan(lakehouse.fre_silver(orig, orig, lakehouse.member_quarters(members)))
    assert "MapInArrow" not in text  # silver comes from bronze, not from the archives
