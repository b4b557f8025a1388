"""Statistical profile of a table: numeric distributions, top values, shares, and comparison with an earlier profile.

Each block is one pass over the data whatever the number of columns, and its results are DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StringType

from tapelake.functions.casts import percent, round_half_away

NUMERIC_TYPES = (DoubleType, FloatType, LongType, IntegerType)
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
SKETCH_SIZE = 1000
"""KLL sketch parameter: rank error about 0.3 %, about 25 KB per column and task."""
MERGE_GROUPS = 256


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC_TYPES)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def _col(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col(f"`{name.replace('`', '``')}`")


def _as_double(name: str) -> Column:
    return _col(name).cast("double")


def _partial(columns: Sequence[str], quartiles: bool = True) -> list[Column]:
    """What is counted of each column, and the number of rows."""
    out = [F.count("*").alias("rows")]
    for i, name in enumerate(columns):
        value = _as_double(name)
        out += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"), F.sum(value).alias(f"sum{i}")]
        if quartiles:
            out.append(F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE)).alias(f"kll{i}"))
    return out


def _merged(i: int | str = "", quartiles: bool = True) -> list[Column]:
    """The same, of what was counted in parts."""
    out = [F.sum(f"n{i}").alias(f"n{i}"), F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"), F.sum(f"sum{i}").alias(f"sum{i}")]
    return out + [F.kll_merge_agg_double(f"kll{i}").alias(f"kll{i}")] if quartiles else out


def _figures(column_name: Column, i: int | str = "", quartiles: bool = True) -> list[Column]:
    """The profile's columns from what was counted."""
    known = F.col(f"n{i}") > 0
    sketched = [F.when(known, F.kll_sketch_get_quantile_double(f"kll{i}", F.lit(q))).alias(label) for label, q in QUARTILES.items()]
    return [
        column_name.alias("column_name"),
        (F.col("rows") - F.coalesce(f"n{i}", F.lit(0))).alias("null_count"),
        F.col(f"lo{i}").alias("min_value"),
        *(sketched if quartiles else []),
        F.col(f"hi{i}").alias("max_value"),
        F.try_divide(f"sum{i}", f"n{i}").alias("mean_value"),
    ]


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, quartiles: bool = True) -> DataFrame:
    """One row per numeric column: ``column_name, null_count, min_value, [q1, median, q3,] max_value, mean_value``.

    Quartiles are approximate. One scan; the partial results (sketches above all) are merged in groups of tasks
    before the final merge, so no single task receives a sketch from every other task. A column with no values has
    NULL statistics.
    """
    columns = list(columns or numeric_columns(df))
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("task_group")
    merged = [F.sum("rows").alias("rows"), *[c for i in range(len(columns)) for c in _merged(i, quartiles)]]
    totals = df.groupBy(group).agg(*_partial(columns, quartiles)).agg(*merged)
    rows = F.array(*[F.struct(*_figures(F.lit(name), i, quartiles)) for i, name in enumerate(columns)])
    return totals.where(F.col("rows").isNotNull()).select(F.explode(rows).alias("r")).select("r.*")


def numeric_states(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``<keys>, column_name, rows, n, lo, hi, sum, kll``: what the numeric profile of each part is made of, to be kept.

    States of parts merge to the profile of all of them (:func:`merged_profile`), so a part is read once, when it changes.
    """
    columns = list(columns or [c for c in numeric_columns(df) if c not in keys])
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("task_group")
    merged = [F.sum("rows").alias("rows"), *[c for i in range(len(columns)) for c in _merged(i)]]
    counted = df.groupBy(*keys, group).agg(*_partial(columns)).groupBy(*keys).agg(*merged)
    names = ("n", "lo", "hi", "sum", "kll")
    states = [F.struct(F.lit(name).alias("column_name"), "rows", *[F.col(f"{x}{i}").alias(x) for x in names]) for i, name in enumerate(columns)]
    return counted.select(*keys, F.explode(F.array(*states)).alias("s")).select(*keys, "s.*")


def merged_profile(states: DataFrame, quartiles: bool = True) -> DataFrame:
    """The rows of :func:`numeric_profile`, from states; sketches of a column are merged in groups, then once more."""
    rows, group = F.sum("rows").alias("rows"), F.pmod(F.xxhash64(*states.columns[:1], F.spark_partition_id()), F.lit(16)).alias("merge_group")
    merged = [rows, *_merged(quartiles=quartiles)]
    return states.groupBy("column_name", group).agg(*merged).groupBy("column_name").agg(*merged).select(*_figures(F.col("column_name"), quartiles=quartiles))


def quartiles_percentile_approx(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10000) -> DataFrame:
    """``column_name, q1, median, q3`` by ``percentile_approx``: actual values of the column, rank error 1/accuracy."""
    columns = list(columns or numeric_columns(df))
    found = df.agg(
        *[F.percentile_approx(_as_double(c), list(QUARTILES.values()), accuracy).alias(f"q{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.get(f"q{i}", F.lit(j)).alias(q) for j, q in enumerate(QUARTILES)])
            for i, c in enumerate(columns)
        ]
    )
    return found.select(F.explode(rows).alias("r")).select("r.*")


def categorical_profile(df: DataFrame, columns: Sequence[str] | None = None, top: int = 10, exclude: Sequence[str] = ()) -> DataFrame:
    """``column_name, val, freq, pct``: the most frequent values of every text column; NULL is a value.

    One scan for all columns. Counting is combined before the shuffle, so a value that fills a column costs one row
    per task; ranking keeps ``top`` rows per column in each task before the rows of a column meet. Ties go to the
    smaller value, NULL last.
    """
    columns = [c for c in (columns or text_columns(df)) if c not in exclude]
    pairs = df.select(*[F.struct(F.lit(c).alias("column_name"), _col(c).alias("val")).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = pairs.select(F.explode(F.array(*pairs.columns)).alias("pair")).select("pair.*")
    counts = pairs.groupBy("column_name", "val").agg(F.count("*").alias("freq"))
    totals = counts.groupBy("column_name").agg(F.sum("freq").alias("total"))
    best = Window.partitionBy("column_name").orderBy(F.desc("freq"), F.asc_nulls_last("val"))
    return (
        counts.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= top)
        .join(F.broadcast(totals), "column_name")
        .select("column_name", "val", "freq", percent(F.col("freq"), F.col("total")).alias("pct"))
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """``<column>, freq, pct`` of every value of one column."""
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(_col(column)).agg(F.count("*").alias("freq"))
    return counts.select(_col(column), "freq", percent(F.col("freq"), total).alias("pct"))


def top_values(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """The most frequent values of one column, most frequent first."""
    return value_shares(df, column).orderBy(F.desc("freq"), _col(column).asc_nulls_last()).limit(top)


def share_where(df: DataFrame, condition: Column) -> DataFrame:
    """``matching, total, pct`` (four places) of the rows that satisfy a condition, in one scan."""
    counted = df.agg(F.count_if(condition).alias("matching"), F.count("*").alias("total"))
    return counted.withColumn("pct", percent(F.col("matching"), F.col("total"), 4))


def null_density(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_null_pct`` for each column: what an enrichment filled shows as the difference between two of them."""
    counted = df.agg(F.count("*").alias("rows"), *[F.count(_col(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    return counted.select(*[percent(F.col("rows") - F.col(f"n{i}"), F.col("rows"), 6).alias(f"{c}_null_pct") for i, c in enumerate(columns)])


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """``<key>, rows, mean_value``: the read-back check after a layer is written."""
    means = df.groupBy(_col(key)).agg(F.count("*").alias("rows"), F.avg(_col(value)).alias("mean_value"))
    return means.withColumn("mean_value", round_half_away(F.col("mean_value"), 6))


def describe(df: DataFrame) -> DataFrame:
    """``ordinal, column_name, column_type, values``: the schema, with the number of non-NULL values."""
    columns = list(enumerate(df.schema))
    counted = df.agg(*[F.count(_col(field.name)).alias(f"n{i}") for i, field in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col(f"n{i}").alias("values"),
            )
            for i, field in columns
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def long_profile(profile: DataFrame) -> DataFrame:
    """A numeric profile as ``column_name, metric, value``."""
    metrics = [c for c in profile.columns if c != "column_name"]
    as_doubles = profile.select("column_name", *[F.col(m).cast("double").alias(m) for m in metrics])
    return as_doubles.unpivot("column_name", metrics, "metric", "value")


def compare_profiles(expected: DataFrame, actual: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """``column_name, metric, expected, actual, status`` of each figure of a known-good profile.

    Status is ``match`` (both NULL, or apart by no more than ``tolerance`` relative to the expected figure, or to 1 if
    that is smaller), ``differs`` or ``missing``. Profiles are a few rows per column.
    """
    want = long_profile(expected).withColumnRenamed("value", "expected")
    have = long_profile(actual).select("column_name", "metric", F.col("value").alias("actual"), F.lit(True).alias("found"))
    close = F.abs(F.col("actual") - F.col("expected")) <= tolerance * F.greatest(F.abs("expected"), F.lit(1.0))
    same = F.col("actual").eqNullSafe(F.col("expected")) | F.coalesce(close, F.lit(False))
    status = F.when(F.col("found").isNull(), "missing").when(same, "match").otherwise("differs")
    joined = want.join(have, ["column_name", "metric"], "left")
    return joined.select("column_name", "metric", "expected", "actual", status.alias("status"))
