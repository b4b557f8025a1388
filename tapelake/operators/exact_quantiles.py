"""Exact quantiles of many columns in two scans, without sorting them or bringing a column to one task.

The first scan makes a KLL sketch of each column, whose quantiles a little below and above each probability almost surely
enclose it. The second counts the rows below that interval and, by value, the rows inside it; only these, a few in a hundred,
are written. What is left is done on that small table: histograms of at most ``buckets`` value ranges per open interval narrow
it to the wanted rank, and an interval always splits because its smallest and largest value fall in different buckets. If a
sketch was wrong about a rank, the counts show it, and that rank is narrowed over the whole column instead: results are exact
in any case. All aggregates are bounded, whatever the number of rows or how they are distributed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.operators.profile import SKETCH_SIZE
from tapelake.session import shared_folder

_INTERVAL = "column_name string, low double, high double"
#: How far the sketch may be off, as a share of all rows; several times its usual error.
BAND = 0.01
_GROUPS = 256


def _histogram(values: DataFrame, intervals: list[tuple], buckets: int) -> list:
    """Rows, smallest and largest value per bucket of the intervals, in value order. ``values``: column_name, value, n."""
    spark = values.sparkSession
    bounds = F.broadcast(spark.createDataFrame(sorted(set(intervals)), _INTERVAL))
    inside = values.join(bounds, "column_name").where(F.col("value").between(F.col("low"), F.col("high")))
    position = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * float(buckets))
    bucket = F.when(F.col("value") < F.col("high"), F.least(position, F.lit(buckets - 1))).otherwise(buckets)
    counted = inside.groupBy("column_name", "low", bucket.alias("bucket")).agg(
        F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    return counted.orderBy("column_name", "lo").collect()


def _narrowed(values: DataFrame, open_ranks: dict, buckets: int) -> dict:
    """The value of each (name, rank), given an interval that holds it and the rows before that interval."""
    open_ranks, found = dict(open_ranks), {}
    while open_ranks:
        for key, (lo, hi, _) in list(open_ranks.items()):
            if lo == hi:
                found[key] = lo
                del open_ranks[key]
        if not open_ranks:
            break
        seen = _histogram(values, [(name, lo, hi) for (name, _), (lo, hi, _) in open_ranks.items()], buckets)
        for (name, rank), (lo, _, before) in list(open_ranks.items()):
            for b in (b for b in seen if b["column_name"] == name and b["low"] == lo):
                if rank < before + b["n"]:
                    open_ranks[name, rank] = (b["lo"], b["hi"], before)
                    break
                before += b["n"]
    return found


def _sketched(values: DataFrame, probabilities: Sequence[float], band: float) -> list:
    """column_name, n, lo, hi and bounds: the sketch's quantiles ``band`` below and above each probability."""
    partial = [F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.kll_sketch_agg_double("value", F.lit(SKETCH_SIZE)).alias("kll")]
    merged = [F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("kll").alias("kll")]
    group = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("task_group")
    counted = values.groupBy("column_name", group).agg(*partial).groupBy("column_name").agg(*merged)

    def at(p: float) -> Column:
        return F.col("lo") if p <= 0 else F.col("hi") if p >= 1 else F.kll_sketch_get_quantile_double("kll", F.lit(float(p)))

    bounds = F.array(*[F.array(at(p - band), at(p + band)) for p in probabilities])
    return counted.select("column_name", "n", "lo", "hi", bounds.alias("bounds")).collect()


def _enclosed(values: DataFrame, intervals: dict[str, tuple[str, float, float]]) -> DataFrame:
    """column_name (the interval's), value and n: the values inside each interval; a null value counts those below it."""
    rows = [(column, name, low, high) for name, (column, low, high) in intervals.items()]
    bounds = F.broadcast(values.sparkSession.createDataFrame(rows, "column_name string, interval string, low double, high double"))
    near = values.join(bounds, "column_name").where(F.col("value") <= F.col("high"))
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    return near.groupBy(F.col("interval").alias("column_name"), inside.alias("value")).agg(F.count("*").alias("n"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], buckets: int = 512, band: float = BAND) -> DataFrame:
    """``column_name, probability, value``, interpolated between neighbouring ranks; NULL for a column without values.

    Eager, and a table of ``columns x probabilities`` rows. NaN and the infinities are no values here.
    """
    spark = df.sparkSession
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    values = doubles.unpivot([], list(columns), "column_name", "value").where(F.abs("value") < float("inf"))
    ranges = {r["column_name"]: r for r in _sketched(values, probabilities, band)}
    intervals = {f"{name}#{i}": (name, *r["bounds"][i]) for name, r in ranges.items() for i in range(len(probabilities))}
    found: dict = {}
    if intervals:
        path = shared_folder(spark, "quantiles")
        _enclosed(values, intervals).write.parquet(path)
        inside = spark.read.parquet(path)
        below = {r["column_name"]: r["n"] for r in inside.where("value IS NULL").collect()}
        held = {r["column_name"]: r for r in inside.where("value IS NOT NULL").groupBy("column_name").agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
        near, far = {}, {}
        for name, r in ranges.items():
            for i, p in enumerate(probabilities):
                place, key, before = p * (r["n"] - 1), f"{name}#{i}", below.get(f"{name}#{i}", 0)
                for rank in (math.floor(place), math.ceil(place)):
                    if key in held and before <= rank < before + held[key]["n"]:
                        near[key, rank] = (held[key]["lo"], held[key]["hi"], before)
                    else:
                        far[name, rank] = (r["lo"], r["hi"], 0)
        found = {(key.rsplit("#", 1)[0], rank): v for (key, rank), v in _narrowed(inside.where("value IS NOT NULL"), near, buckets).items()}
        found |= _narrowed(values.withColumn("n", F.lit(1)), far, buckets)
    rows = []
    for name in columns:
        for p in probabilities:
            value = None
            if name in ranges:
                place = p * (ranges[name]["n"] - 1)
                below_, above = found[name, math.floor(place)], found[name, math.ceil(place)]
                value = below_ + (above - below_) * (place - math.floor(place))
            rows.append((name, float(p), value))
    return spark.createDataFrame(rows, "column_name string, probability double, value double")
