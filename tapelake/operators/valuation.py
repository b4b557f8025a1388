"""Mark-to-market loan-to-value from the price index.

The index has four roles: state and metro, origination month and current month. It is joined twice, from the left, once for
each level of geography: a geography is one row with all its months, of which both roles take theirs, so a loan row is kept
whether or not it finds an index and can never be multiplied. Broadcast, the loan table is never shuffled and a hot state
cannot skew a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.casts import month_of, round_half_away
from tapelake.operators.lookup import MAX_BROADCAST_ROWS, is_small
from tapelake.operators.price_index import METRO, STATE, level

_KEY = {STATE: ("prop_state", "GEO_Name"), METRO: ("msa_code", "msa_code")}
_MONTH = {"orig": "j_orig_dt", "now": "j_now_dt"}
_PREFIX = {STATE: "state", METRO: "msa"}
RATIO_COLUMNS = ("msa_index_orig", "msa_index_now", "state_index_orig", "state_index_now")


def with_month_keys(loans: DataFrame) -> DataFrame:
    """Add the origination and the current month, both as first of month."""
    return loans.withColumns(
        {"j_orig_dt": month_of(F.col("first_pay_date")), "j_now_dt": month_of(F.col("report_period"))}
    )


def _month_number(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def month_arrays(index: DataFrame, geo_type: str) -> DataFrame:
    """``geo, first_month, months``: one row per geography, the index (not seasonally adjusted) month by month without gaps.

    A month without an index is NULL, and one that occurs twice has its larger value, so a loan meets one row at most.
    """
    key = _KEY[geo_type][1]
    rows = level(index, geo_type).where(F.col(key).isNotNull() & F.col("hpi_date").isNotNull())
    once = rows.groupBy(F.col(key).alias("geo"), _month_number(F.col("hpi_date")).alias("month")).agg(F.max("index_nsa").alias("value"))
    known = once.groupBy("geo").agg(F.array_sort(F.collect_list(F.struct("month", "value"))).alias("known"))

    def with_gap(x: Column, i: Column) -> Column:
        missing = F.coalesce(F.get("known", i + 1)["month"], x["month"] + 1) - x["month"] - 1
        return F.concat(F.array(x["value"]), F.array_repeat(F.lit(None).cast("double"), missing))

    return known.select("geo", F.get("known", F.lit(0))["month"].alias("first_month"), F.flatten(F.transform("known", with_gap)).alias("months"))


def with_index(loans: DataFrame, index: DataFrame, geo_type: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add ``<level>_index_orig`` and ``<level>_index_now`` (not seasonally adjusted) by exact month.

    One join for both months: a geography's months are an array, addressed by the months since its first. It is broadcast
    if the level's rows, a value each, are at most ``max_rows``.
    """
    loan_key = _KEY[geo_type][0]
    series = month_arrays(index, geo_type).withColumnsRenamed({"geo": "_geo", "first_month": "_first", "months": "_months"})
    if is_small(level(index, geo_type), max_rows):
        series = F.broadcast(series)
    joined = loans.join(series, loans[loan_key] == series["_geo"], "left")
    found = {f"{_PREFIX[geo_type]}_index_{role}": F.get("_months", _month_number(F.col(month)) - F.col("_first")) for role, month in _MONTH.items()}
    return joined.withColumns(found).drop("_geo", "_first", "_months")


def index_ratio() -> Column:
    """Growth since origination: the metro's if both months are known, else the state's."""
    return F.coalesce(
        F.try_divide("msa_index_now", "msa_index_orig"), F.try_divide("state_index_now", "state_index_orig")
    )


def mtm_ltv(ratio: Column) -> Column:
    """Current balance as a percentage of the original value carried forward by ``ratio``; NULL when undefined."""
    original_value = F.try_divide(F.col("orig_upb"), F.try_divide(F.col("orig_ltv"), F.lit(100.0)))
    return F.try_divide(F.col("current_upb"), original_value * ratio) * 100.0


def mark_to_market(loans: DataFrame, index: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Canonical loan-months plus ``j_orig_dt, j_now_dt, mtm_cltv, final_cltv``; row count unchanged.

    ``final_cltv`` is the agency's own valuation where it has one, the marked one otherwise.
    """
    keyed = with_month_keys(loans)
    joined = with_index(with_index(keyed, index, STATE, max_rows), index, METRO, max_rows)
    marked = joined.withColumn("mtm_cltv", mtm_ltv(index_ratio()))
    rounded = marked.withColumn("mtm_cltv", round_half_away(F.col("mtm_cltv"), 2))
    return rounded.select(*keyed.columns, "mtm_cltv", F.coalesce("eltv", "mtm_cltv").alias("final_cltv"))
