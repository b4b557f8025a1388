"""Origination file joined to its performance file, inside one quarter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions.packed import pack, text_columns, unpack

# Where each file keeps the loan number.
ORIG_LOAN, PERF_LOAN = "column19", "column00"
SUFFIX = "_1"


def suffixed(perf: DataFrame, suffix: str = SUFFIX) -> DataFrame:
    """Performance columns renamed so that both files fit in one row; ``quarter`` keeps its name."""
    return perf.select("quarter", *[F.col(c).alias(c + suffix) for c in perf.columns if c != "quarter"])


def performing_loans(perf: DataFrame) -> DataFrame:
    """(quarter, loan) of the loans with performance rows, each once; combined in the tasks before it is shuffled."""
    return perf.select("quarter", F.col(PERF_LOAN)).distinct()


def _key(quarter: str, loan: str) -> Column:
    return F.struct(F.col(quarter).alias("quarter"), F.col(loan).alias("loan"))


def join_performance(orig: DataFrame, perf: DataFrame, performing: DataFrame | None = None, packed: bool = False, by_quarter: bool = False) -> DataFrame:
    """Every origination row with each of its performance rows; NULL performance columns if it has none.

    This is a left join on (quarter, loan), written as an inner join plus the loans without performance: Spark can
    split a hot key on the many-rows side of an inner join, which it cannot on the right side of a left join.
    ``performing``: the result of :func:`performing_loans`, if the caller has it.

    The key is one value that is never NULL, with NULL parts left out on the performance side. So neither join filters
    the originations, both read them alike, and Spark derives and shuffles them once.

    ``packed``: each file's text columns but its key travel as one column, which takes little more than half the bytes; for
    tables that are used whole, as no column that nobody reads is left out then. ``by_quarter``: joined rows are regrouped by
    quarter, as they travel, for a write by quarter.
    """
    wide_right, held = suffixed(perf), {}
    columns = [*orig.columns, *[c for c in wide_right.columns if c != "quarter"]]
    if packed:
        held = {"_orig": text_columns(orig, ("quarter", ORIG_LOAN)), "_perf": text_columns(wide_right, ("quarter", PERF_LOAN + SUFFIX))}
        orig, wide_right = pack(orig, held["_orig"], "_orig"), pack(wide_right, held["_perf"], "_perf")
    right = wide_right.withColumnRenamed("quarter", "_quarter")
    own = [*orig.columns, *[c for c in right.columns if c != "_quarter"]]
    right = right.where(F.col("_quarter").isNotNull() & F.col(PERF_LOAN + SUFFIX).isNotNull())
    matched = right.join(orig, _key("_quarter", PERF_LOAN + SUFFIX) == _key("quarter", ORIG_LOAN)).select(*own)
    loans = (performing_loans(perf) if performing is None else performing).select(F.col("quarter").alias("_quarter"), F.col(PERF_LOAN).alias("_loan"))
    loans = loans.where("_quarter IS NOT NULL AND _loan IS NOT NULL")
    idle = orig.join(loans, _key("quarter", ORIG_LOAN) == _key("_quarter", "_loan"), "left_anti")
    joined = matched.unionByName(idle, allowMissingColumns=True)
    if by_quarter:
        joined = joined.hint("rebalance", "quarter")
    return unpack(joined, held, columns) if packed else joined
