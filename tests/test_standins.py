"""How the stand-in tapes are derived: nothing wider than a query needs, no side of a join sorted, rows dealt to all tasks."""

from catalog import standins

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


def test_a_tape_is_derived_as_wide_as_it_is_read(spark):
    optimized, _ = _plan(standins.fnm_tape(spark, SF).select("column001", "column002"))
    assert "c_name" not in optimized.split("Relation")[0] and "column109" not in optimized


def test_line_items_are_joined_last_and_nothing_is_sorted(spark):
    optimized, physical = _plan(standins.fnm_tape(spark, SF))
    joins = [line for line in optimized.splitlines() if "Join" in line]
    assert "l_orderkey" in joins[0] and not any("l_orderkey" in line for line in joins[1:])
    assert "SortMergeJoin" not in physical and "ShuffledHashJoin" in physical


def test_a_file_of_one_row_group_is_dealt_to_all_tasks(spark):
    assert standins.table(spark, SF, "lineitem").rdd.getNumPartitions() == 1
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert standins.perf_tape(spark, SF).select("column00").rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
