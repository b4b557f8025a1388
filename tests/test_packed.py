"""Text columns that travel as one."""

from pyspark.sql import functions as F

from catalog import queries
from tapelake.functions.packed import pack, text_columns, unpack
from tapelake.operators.tape_join import join_performance

SF = "/root/testdata/sf0.001"


def test_nothing_is_lost_in_a_pack(spark):
    rows = [(None, "", "|", 1), ("a", "\\", "\\p", 2), (None, None, None, 3), ("||", "\\\\p", "é\n", None), ("e", " ", "b", 5)]
    df = spark.createDataFrame(rows, "a string, b string, c string, n int")
    assert text_columns(df, ("b",)) == ["a", "c"]
    back = unpack(pack(df, ["a", "b", "c"], "_x"), {"_x": ["a", "b", "c"]}, df.columns)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert [tuple(r) for r in back.collect()] == rows


def test_packed_rows_join_to_the_same(spark):
    orig = spark.createDataFrame([("q", "a", "1", None, ["x"]), ("q", "b", "|", "", None), (None, "a", "3", "n", None)], "quarter string, column19 string, column00 string, column01 string, beyond array<string>")
    perf = spark.createDataFrame([("q", "a", "x|", None, "", None), ("q", "a", None, "y", "z", ["", None]), (None, "a", "z", "u", "v", None)], "quarter string, column00 string, column01 string, column02 string, column03 string, beyond array<string>")
    want = join_performance(orig, perf)
    for travel in ({}, {"by_quarter": True}):
        got = join_performance(orig, perf, packed=True, **travel)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 4


def _shuffled(df):
    """Columns of the widest row that the tape join and the regrouping for the write shuffle."""
    stack, widest = [df._jdf.queryExecution().optimizedPlan()], 0
    while stack:
        node = stack.pop()
        if node.nodeName() == "RebalancePartitions" or node.nodeName() == "Join" and "struct(" in node.toString().splitlines()[0]:
            widest = max(widest, *[node.children().apply(i).output().size() for i in range(node.children().size())])
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return widest


def test_whole_tables_travel_packed_and_narrow_reads_stay_narrow(spark):
    silver = queries.fre_silver(spark, SF, packed=True, by_quarter=True)
    assert _shuffled(silver) < 20 < _shuffled(queries.fre_silver(spark, SF))
    whole, plain = (queries.gold(spark, SF, packed=packed) for packed in (True, False))
    columns = [F.col(c) for c in plain.columns]
    sums = [df.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first() for df in (whole, plain)]
    assert sums[0] == sums[1]
    assert "concat_ws" not in queries.QUERIES["row_count"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
