import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.operators import profile
from tapelake.operators.exact_quantiles import exact_quantiles


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(0, 10_000, 1, 5)
    return df.select(
        F.col("id").cast("int").alias("whole"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 4).alias("half_null"),
        F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 3 > 0, "common").when(F.col("id") % 2 == 0, F.concat(F.lit("v"), F.col("id") % 90)).alias("word"),
        F.lit("x").alias("same"),
    )


def test_numeric_profile(table):
    got = {r.column_name: r for r in profile.numeric_profile(table).collect()}
    whole, half, empty = got["whole"], got["half_null"], got["empty"]
    assert (whole.null_count, whole.min_value, whole.max_value, whole.mean_value) == (0, 0.0, 9999.0, 4999.5)
    assert abs(whole.median - 5000) < 100 and abs(whole.q1 - 2500) < 100 and abs(whole.q3 - 7500) < 100
    assert (half.null_count, half.max_value) == (5000, 2499.5)
    assert (empty.null_count, empty.min_value, empty.median, empty.mean_value) == (10_000, None, None, None)


def test_numeric_profile_of_nothing(table):
    assert profile.numeric_profile(table.where("whole < 0")).count() == 0


def test_percentile_approx(table):
    got = {r.column_name: (r.q1, r.median, r.q3) for r in profile.quartiles_percentile_approx(table).collect()}
    assert got["empty"] == (None, None, None)
    assert abs(got["whole"][1] - 5000) <= 2


def test_categorical_profile(table):
    rows = profile.categorical_profile(table, exclude=["same"]).collect()
    assert {r.column_name for r in rows} == {"word"} and len(rows) == 10
    ranked = sorted(rows, key=lambda r: -r.freq)
    assert (ranked[0].val, ranked[0].freq, ranked[0].pct) == ("common", 6666, 66.66)
    assert (ranked[1].val, ranked[1].freq) == (None, 1667)


def test_top_values_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "kjihgfedcba"] + [(None,)], "v string")
    assert [r.v for r in profile.top_values(df, "v").collect()] == list("abcdefghij")
    top = profile.categorical_profile(df).collect()
    assert sorted(r.val for r in top) == list("abcdefghij")


def test_shares_and_density(table):
    (r,) = profile.share_where(table, F.col("whole") < 10).collect()
    assert (r.matching, r.total, r.pct) == (10, 10_000, 0.1)
    assert profile.null_density(table, ["whole", "half_null"]).first() == (0.0, 50.0)
    assert profile.value_shares(table, "same").collect() == [("x", 10_000, 100.0)]
    assert profile.mean_by(table, "same", "half_null").collect() == [("x", 10_000, 1249.75)]


def test_compare(table):
    before = profile.numeric_profile(table, quartiles=False)
    changed = table.withColumn("whole", F.col("whole") + 1).drop("half_null")
    after = profile.numeric_profile(changed, quartiles=False)
    got = {(r.column_name, r.metric): r.status for r in profile.compare_profiles(before, after).collect()}
    assert got["whole", "null_count"] == "match" and got["whole", "min_value"] == "differs"
    assert got["empty", "min_value"] == "match" and got["half_null", "mean_value"] == "missing"


@pytest.mark.parametrize("buckets", [4, 512])
def test_exact_quantiles(spark, buckets):
    rng = random.Random(7)
    columns = {
        "skewed": [rng.expovariate(1) ** 8 for _ in range(500)],
        "heavy": [1.0] * 400 + [float(i) for i in range(100)],
        "constant": [3.0] * 500,
        "none": [None] * 500,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column_name, r.probability): r.value for r in exact_quantiles(df, list(columns), probabilities, buckets).collect()}
    for name, values in columns.items():
        for p in probabilities:
            want = None if values[0] is None else float(np.quantile(values, p))
            assert got[name, p] == (want if want is None else pytest.approx(want))


@pytest.mark.parametrize("band", [0.0, 0.3])
def test_exact_quantiles_when_the_sketch_is_off(spark, monkeypatch, band):
    """A rank outside its interval is found over the whole column."""
    import tapelake.operators.exact_quantiles as module

    rng = random.Random(3)
    values = [round(rng.gauss(0, 1), 2) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    original = module._sketched

    def off(*args):
        rows = [r.asDict() for r in original(*args)]
        return [r | {"bounds": [[9.0, 9.5] if i == 1 else b for i, b in enumerate(r["bounds"])]} for r in rows]

    for sketched in (original, off):
        monkeypatch.setattr(module, "_sketched", sketched)
        got = [r.value for r in exact_quantiles(df, ["v"], [0.1, 0.5, 0.75], 16, band).collect()]
        assert got == [pytest.approx(float(np.quantile(values, p))) for p in (0.1, 0.5, 0.75)]


def test_exact_quantiles_scan_the_table_twice(spark, monkeypatch, tmp_path):
    import tapelake.operators.exact_quantiles as module

    rng = random.Random(5)
    spark.createDataFrame([(rng.random(), rng.random()) for _ in range(20_000)], "a double, b double").repartition(4).write.parquet(str(tmp_path / "t"))
    scanned, left = [], []
    for name, seen in (("_sketched", scanned), ("_enclosed", scanned)):
        original = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, original=original, seen=seen: (seen.append(1), original(*a))[1])
    narrowed = module._narrowed
    monkeypatch.setattr(module, "_narrowed", lambda values, ranks, buckets: (left.append((values.inputFiles(), len(ranks), values.count())), narrowed(values, ranks, buckets))[1])
    exact_quantiles(spark.read.parquet(str(tmp_path / "t")), ["a", "b"], [0.25, 0.5, 0.75])
    (files, ranks, rows), (_, far, _) = left
    assert len(scanned) == 2 and ranks >= 6 and far == 0
    assert rows < 0.15 * 2 * 20_000 and not any("/t/" in f for f in files)


def test_odd_names_and_values(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), (None, 3.0), ("y", float("inf"))], "`a.b` string, `c``d` double")
    top = {(r.val, r.freq, r.pct) for r in profile.categorical_profile(df).collect()}
    assert top == {("x", 2, 50.0), ("y", 1, 25.0), (None, 1, 25.0)}
    assert {r.freq for r in profile.value_shares(df, "a.b").collect()} == {2, 1}
    assert profile.null_density(df, ["a.b"]).first()[0] == 25.0
    plain = df.toDF("t", "v")
    assert [r.value for r in exact_quantiles(plain, ["v"], [0.0, 1.0]).collect()] == [1.0, 3.0]
