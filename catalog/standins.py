"""Loan tapes and a price index derived from the driver tables: an order is a loan, a line item one of its months.

The SQL below is valid in Spark and in DuckDB and fills every field the canonical contract reads, so both engines
start from the same tapes. Only whole numbers, strings and two-decimal amounts are cast to text, because computed
doubles print and round differently in the two engines. Quarters are ten years on, since tape names start with ``2``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.session import shared_folder
from tapelake.sources.tapes import FNM_FIELDS, FRE_FIELDS

ORIG_SQL = """
SELECT
 concat(CAST(year(o_orderdate) + 10 AS STRING), 'Q', CAST(quarter(o_orderdate) AS STRING)) AS quarter,
 CASE WHEN o_orderkey % 23 = 0 THEN '9999' ELSE CAST(300 + o_orderkey % 551 AS STRING) END AS column00,
 CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING) AS column01,
 CASE WHEN o_orderkey % 3 = 0 THEN 'Y' WHEN o_orderkey % 37 = 0 THEN '9' ELSE 'N' END AS column02,
 CASE WHEN o_orderkey % 53 = 0 THEN '205013' ELSE CAST((year(o_orderdate) + 30) * 100 + month(o_orderdate) AS STRING) END AS column03,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE lpad(CAST(c_custkey % 20 AS STRING), 5, '0') END AS column04,
 CASE WHEN o_orderkey % 17 = 0 THEN '999' ELSE CAST(o_orderkey % 56 AS STRING) END AS column05,
 CASE WHEN o_orderkey % 19 = 0 THEN '99' ELSE CAST(1 + o_orderkey % 4 AS STRING) END AS column06,
 CASE o_orderkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'S' WHEN 2 THEN 'I' WHEN 3 THEN '9' ELSE 'U' END AS column07,
 CASE WHEN o_orderkey % 29 = 1 THEN '999' ELSE CAST(31 + o_orderkey % 68 AS STRING) END AS column08,
 CASE WHEN o_orderkey % 13 = 0 THEN '999' ELSE CAST(1 + o_orderkey % 65 AS STRING) END AS column09,
 CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS column10,
 CASE WHEN o_orderkey % 29 = 0 THEN '999' WHEN o_orderkey % 31 = 0 THEN '0' ELSE CAST(30 + o_orderkey % 68 AS STRING) END AS column11,
 CASE WHEN o_orderkey % 47 = 0 THEN '0' WHEN o_orderkey % 47 = 1 THEN '999' ELSE concat(CAST(2 + o_orderkey % 5 AS STRING), '.', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')) END AS column12,
 CASE o_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'T' WHEN 2 THEN '9' ELSE 'B' END AS column13,
 CASE WHEN o_orderkey % 59 = 0 THEN 'Y' ELSE 'N' END AS column14,
 'FRM' AS column15,
 n_name AS column16,
 CASE o_orderkey % 3 WHEN 0 THEN 'SF' WHEN 1 THEN 'CO' ELSE 'PU' END AS column17,
 CASE WHEN c_custkey % 13 = 0 THEN '000' ELSE concat(lpad(CAST(c_custkey % 100 AS STRING), 3, '0'), '00') END AS column18,
 CAST(o_orderkey AS STRING) AS column19,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'P' WHEN '2-HIGH' THEN 'C' WHEN '3-MEDIUM' THEN 'R' WHEN '5-LOW' THEN 'N' ELSE '9' END AS column20,
 CASE WHEN o_orderkey % 41 = 0 THEN '998' WHEN o_orderkey % 43 = 0 THEN 'x' ELSE '359' END AS column21,
 CASE WHEN o_orderkey % 61 = 0 THEN '99' ELSE CAST(1 + o_orderkey % 3 AS STRING) END AS column22,
 lower(c_name) AS column23,
 concat('Servicer ', CAST(c_nationkey AS STRING)) AS column24,
 CASE o_orderstatus WHEN 'P' THEN 'Y' WHEN 'F' THEN ' ' ELSE NULL END AS column25,
 CASE o_orderkey % 6 WHEN 0 THEN 'H' WHEN 1 THEN 'F' WHEN 2 THEN '7' WHEN 3 THEN 'R' ELSE '9' END AS column27,
 CAST(1 + o_orderkey % 7 AS STRING) AS column29,
 CASE WHEN o_orderkey % 67 = 0 THEN 'Y' ELSE 'N' END AS column30,
 CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN '7' ELSE '9' END AS column31
FROM {orders} AS o JOIN {customer} AS c ON o_custkey = c_custkey JOIN {nation} AS n ON c_nationkey = n_nationkey
"""

PERF_SQL = """
SELECT
 concat(CAST(year(o_orderdate) + 10 AS STRING), 'Q', CAST(quarter(o_orderdate) AS STRING)) AS quarter,
 CAST(l_orderkey AS STRING) AS column00,
 CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS column01,
 CASE WHEN l_quantity = 1 THEN '-1' ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS column02,
 CASE WHEN l_quantity = 50 THEN 'RA' WHEN l_quantity = 49 THEN 'XX' WHEN l_quantity = 48 THEN '100' ELSE CAST(CAST(l_quantity AS INT) % 4 AS STRING) END AS column03,
 CAST(l_linenumber - 3 AS STRING) AS column04,
 CASE WHEN l_quantity = 9 THEN '999' ELSE CAST(360 - l_linenumber AS STRING) END AS column05,
 CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'P' ELSE NULL END AS column07,
 CASE l_linenumber WHEN 1 THEN '01' WHEN 2 THEN '03' WHEN 3 THEN '15' WHEN 4 THEN '96' WHEN 5 THEN '77' ELSE NULL END AS column08,
 CASE WHEN l_linenumber < 5 THEN CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) ELSE NULL END AS column09,
 CASE WHEN l_quantity = 10 THEN '0' WHEN l_quantity = 11 THEN '999' ELSE concat(CAST(2 + CAST(l_quantity AS INT) % 5 AS STRING), '.', lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')) END AS column10,
 CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_quantity * 3 AS DECIMAL(15,2)) AS STRING) ELSE '0' END AS column11,
 CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS column12,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_tax * 1000 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column13,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_extendedprice - 500 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column14,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_discount * 1000 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column15,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 - l_partkey AS STRING) ELSE NULL END AS column16,
 CASE WHEN l_linenumber % 3 = 0 THEN '-1' WHEN l_linenumber % 3 = 1 THEN CAST(l_suppkey AS STRING) ELSE NULL END AS column21,
 CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_quantity * 7 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column22,
 CASE WHEN l_linestatus = 'F' THEN NULL WHEN l_quantity = 2 THEN '999' ELSE CAST(40 + CAST(l_quantity AS INT) AS STRING) END AS column25,
 CASE WHEN l_linenumber < 5 THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column26,
 CASE WHEN l_linenumber = 2 THEN CAST(l_suppkey * 10 AS STRING) ELSE NULL END AS column27,
 CASE l_linenumber WHEN 1 THEN 'F' WHEN 2 THEN 'R' WHEN 3 THEN 'T' ELSE NULL END AS column29,
 CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 100 - 5 AS STRING) ELSE NULL END AS column30,
 CASE WHEN l_quantity = 1 THEN '-1' ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS column31
FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey
"""

FNM_SQL = """
SELECT
 CAST(l_orderkey AS STRING) AS column001,
 concat(lpad(CAST(month(l_shipdate) AS STRING), 2, '0'), CAST(year(l_shipdate) AS STRING)) AS column002,
 CASE l_returnflag WHEN 'R' THEN 'R' WHEN 'A' THEN 'B' ELSE '9' END AS column003,
 lower(c_name) AS column004,
 concat('servicer ', CAST(c_nationkey AS STRING)) AS column005,
 CASE WHEN l_quantity = 12 THEN '0' WHEN l_quantity = 13 THEN '999' ELSE concat(CAST(2 + o_orderkey % 5 AS STRING), '.', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')) END AS column007,
 CASE WHEN l_quantity = 14 THEN '0.000' WHEN l_quantity = 15 THEN '999' WHEN l_quantity = 16 THEN '1d' ELSE concat(CAST(2 + l_partkey % 5 AS STRING), '.5') END AS column008,
 CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS column009,
 CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) AS column011,
 CASE WHEN l_quantity = 3 THEN '360.0' WHEN l_quantity = 4 THEN 'bad' WHEN l_quantity = 5 THEN '3.6e2' WHEN l_quantity = 6 THEN '180.5' ELSE '360' END AS column012,
 concat(lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), CAST(year(o_orderdate) AS STRING)) AS column014,
 CASE WHEN l_quantity = 17 THEN '999' WHEN l_quantity = 18 THEN '-2.5' ELSE CAST(l_linenumber - 2 AS STRING) END AS column015,
 CASE WHEN l_quantity = 19 THEN '999' WHEN l_quantity = 20 THEN '3000000000' ELSE CAST(361 - l_linenumber AS STRING) END AS column017,
 CASE WHEN l_quantity = 21 THEN '132050' ELSE concat(lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), CAST(year(o_orderdate) + 30 AS STRING)) END AS column018,
 CASE WHEN l_quantity = 5 THEN '999' ELSE CAST(30 + CAST(l_quantity AS INT) AS STRING) END AS column019,
 CASE WHEN l_quantity = 8 THEN '999' ELSE CAST(31 + CAST(l_quantity AS INT) AS STRING) END AS column020,
 CASE WHEN l_quantity = 22 THEN '99' ELSE CAST(1 + l_partkey % 3 AS STRING) END AS column021,
 CASE WHEN l_quantity = 6 THEN '999' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS column022,
 CASE WHEN l_quantity = 23 THEN '9999' WHEN l_quantity = 24 THEN ' ' ELSE CAST(300 + o_orderkey % 551 AS STRING) END AS column023,
 CASE WHEN l_quantity = 7 THEN 'y' WHEN l_linenumber % 2 = 0 THEN 'Y' ELSE 'N' END AS column025,
 CASE l_partkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'R' WHEN 2 THEN 'P' ELSE 'U' END AS column026,
 CASE l_partkey % 3 WHEN 0 THEN 'SF' WHEN 1 THEN 'CO' ELSE 'PU' END AS column027,
 CASE WHEN l_quantity = 25 THEN '99' ELSE CAST(1 + l_partkey % 4 AS STRING) END AS column028,
 CASE l_linenumber WHEN 1 THEN 'U' WHEN 2 THEN 'S' WHEN 3 THEN 'I' ELSE 'P' END AS column029,
 n_name AS column030,
 lpad(CAST(c_custkey % 20 AS STRING), 5, '0') AS column031,
 lpad(CAST(c_custkey % 100 AS STRING), 3, '0') AS column032,
 CASE WHEN l_quantity = 26 THEN NULL ELSE CAST(l_partkey % 56 AS STRING) END AS column033,
 'FRM' AS column034,
 CASE WHEN l_quantity = 27 THEN 'Y' ELSE 'N' END AS column035,
 CASE WHEN l_quantity = 28 THEN 'Y' ELSE 'N' END AS column036,
 CASE WHEN l_quantity = 49 THEN 'XX' ELSE lpad(CAST(CAST(l_quantity AS INT) % 4 AS STRING), 2, '0') END AS column039,
 CASE l_linestatus WHEN 'F' THEN 'Y' ELSE NULL END AS column041,
 CASE l_linenumber WHEN 1 THEN 'M' WHEN 2 THEN 'Y' WHEN 3 THEN '9' ELSE 'NA' END AS column042,
 CASE l_linenumber WHEN 1 THEN '01' WHEN 2 THEN '97' WHEN 3 THEN '16' WHEN 4 THEN '06' WHEN 5 THEN '96' WHEN 6 THEN '55' ELSE NULL END AS column043,
 CASE WHEN l_linenumber < 6 THEN concat(lpad(CAST(month(l_shipdate) AS STRING), 2, '0'), CAST(year(l_shipdate) AS STRING)) ELSE NULL END AS column044,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column045,
 CASE WHEN l_quantity = 29 THEN 'x' ELSE concat(lpad(CAST(month(l_shipdate) AS STRING), 2, '0'), CAST(year(l_shipdate) AS STRING)) END AS column050,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_tax * 100 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column053,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_tax * 200 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column054,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_discount * 100 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column055,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_discount * 200 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column056,
 CASE WHEN l_linenumber % 5 = 0 THEN CAST(CAST(l_quantity AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column057,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_extendedprice - 500 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column058,
 CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_tax * 50 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column059,
 CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_discount * 50 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column060,
 CASE WHEN l_linenumber % 7 = 0 THEN CAST(CAST(l_quantity * 2 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column061,
 CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(l_quantity * 3 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column062,
 CASE WHEN l_linenumber = 4 THEN CAST(l_partkey % 1000 - 100 AS STRING) ELSE NULL END AS column074,
 CASE WHEN l_linenumber = 4 THEN CAST(l_partkey % 9000 - 900 AS STRING) ELSE NULL END AS column075,
 CASE l_partkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'H' WHEN 2 THEN 'R' WHEN 3 THEN '7' ELSE '9' END AS column078,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity * 4 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column083,
 CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey * 3 AS STRING) ELSE NULL END AS column084,
 CASE l_linenumber WHEN 1 THEN 'A' WHEN 2 THEN 'W' WHEN 3 THEN 'C' WHEN 4 THEN '7' ELSE 'P' END AS column085,
 CASE WHEN l_partkey % 5 = 0 THEN 'Y' ELSE 'N' END AS column086,
 CASE l_linenumber WHEN 1 THEN 'F' WHEN 2 THEN 'R' WHEN 3 THEN 'T' WHEN 4 THEN 'O' ELSE '7' END AS column101,
 CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(l_quantity * 5 AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column107,
 CASE WHEN l_quantity = 30 THEN '-1' WHEN l_linestatus = 'O' THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) ELSE NULL END AS column109
FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey JOIN {customer} AS c ON o_custkey = c_custkey JOIN {nation} AS n ON c_nationkey = n_nationkey
"""

# DuckDB only; Spark builds the same rows in ``raw_index`` without a cross join.
INDEX_SQL = """
SELECT 'State' AS GEO_Type, n_name AS GEO_Name, CAST(n_nationkey AS BIGINT) AS GEO_Code, CAST(y AS BIGINT) AS Year, CAST(mo AS BIGINT) AS Month,
 CAST(100 + (n_nationkey * 7 + (y * 12 + mo) * 3) % 50 AS DOUBLE) AS Index_NSA, CAST(101 + (n_nationkey * 5 + (y * 12 + mo) * 3) % 50 AS DOUBLE) AS Index_SA
FROM nation CROSS JOIN months
UNION ALL
SELECT 'CBSA', concat('MSA_', CAST(k AS STRING)), k, CAST(y AS BIGINT), CAST(mo AS BIGINT),
 CAST(100 + (k * 11 + (y * 12 + mo) * 2) % 60 AS DOUBLE), CAST(101 + (k * 11 + (y * 12 + mo) * 2) % 60 AS DOUBLE)
FROM (SELECT DISTINCT c_custkey % 20 AS k FROM customer) AS metros CROSS JOIN months WHERE k > 0 AND NOT (k % 6 = 0 AND y < 1998)
UNION ALL
SELECT 'US', 'USA', CAST(NULL AS BIGINT), CAST(y AS BIGINT), CAST(mo AS BIGINT), CAST(150 AS DOUBLE), CAST(150 AS DOUBLE) FROM months
"""
MONTHS_SQL = """
SELECT DISTINCT year(d) AS y, month(d) AS mo FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) AS t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loans(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Orders with their customers and nations, those that are among ``names``.

    No side is sorted: of each shuffle the smaller one is hashed, so nothing spills that is as wide as both.
    """
    loans = table(spark, sf_dir, "orders")
    if "customer" in names:
        borrowers = table(spark, sf_dir, "customer").hint("shuffle_hash")
        loans = loans.join(borrowers, F.col("o_custkey") == F.col("c_custkey"))
        loans = loans.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return loans


def _derive(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """The SQL's select list over its joins, those of orders first: line items are shuffled once, narrow, by their order.

    That shuffle also deals the rows to all tasks, however few row groups the file has; a row's fields are made after it.
    """
    rows = _loans(spark, sf_dir, *names)
    if "lineitem" in names:
        rows = table(spark, sf_dir, "lineitem").join(rows.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    return spark.sql(sql[: sql.rindex("FROM ")] + "FROM {rows}", rows=rows)


def _all_fields(tape: DataFrame, fields: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Positional columns in order; a field the stand-in leaves out is an empty (NULL) field of the tape."""
    present = set(tape.columns)
    return tape.selectExpr(*extra, *[f if f in present else f"CAST(NULL AS STRING) AS {f}" for f in fields])


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(make):
    """A small stand-in that takes a scan of large tables is derived once per application and data set, written, and read back."""

    @wraps(make)
    def table_of(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId, sf_dir, make.__name__
        if key in _WRITTEN:
            try:
                return spark.read.parquet(_WRITTEN[key])
            except AnalysisException:  # the folder was cleared since
                del _WRITTEN[key]
        path = shared_folder(spark, make.__name__.replace("_", "-"))
        make(spark, sf_dir).write.parquet(path)
        _WRITTEN[key] = path
        return spark.read.parquet(path)

    return table_of


def orig_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    tape = _derive(spark, sf_dir, ORIG_SQL, "orders", "customer", "nation")
    return _all_fields(tape, FRE_FIELDS, ("quarter",))


def perf_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_fields(_derive(spark, sf_dir, PERF_SQL, "lineitem", "orders"), FRE_FIELDS, ("quarter",))


def fnm_tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_fields(_derive(spark, sf_dir, FNM_SQL, "lineitem", "orders", "customer", "nation"), FNM_FIELDS)


@_once
def raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows for every state, metro and the nation, for every month in the data.

    The months (some hundred at most: calendar months, whatever the table size) travel as one array value.
    """
    dates = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").alias("d"))
        .unionAll(table(spark, sf_dir, "lineitem").select("l_shipdate"))
    )
    months = dates.select(F.year("d").alias("y"), F.month("d").alias("mo")).agg(
        F.collect_set(F.struct("y", "mo")).alias("months")
    )
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    no_code = F.lit(None).cast("bigint")
    states = nation.select(
        F.lit("State").alias("GEO_Type"), F.col("n_name").alias("GEO_Name"), F.col("n_nationkey").cast("bigint").alias("GEO_Code")
    )
    metros = (
        customer.select((F.col("c_custkey") % 20).alias("k"))
        .distinct()
        .where("k > 0")
        .select(F.lit("CBSA"), F.concat(F.lit("MSA_"), F.col("k").cast("string")), "k")
    )
    whole_country = nation.agg(F.lit("US"), F.lit("USA"), no_code)
    places = states.unionAll(metros).unionAll(whole_country)
    monthly = places.select("*", F.explode(months.scalar()).alias("m")).select(
        "*", F.col("m.y").alias("y"), F.col("m.mo").alias("mo")
    )
    code, t = F.col("GEO_Code"), F.col("y") * 12 + F.col("mo")

    def pick(state, metro):
        return F.when(F.col("GEO_Type") == "State", state).when(F.col("GEO_Type") == "CBSA", metro).otherwise(150).cast("double")

    return monthly.where(~((F.col("GEO_Type") == "CBSA") & (code % 6 == 0) & (F.col("y") < 1998))).select(
        "GEO_Type",
        "GEO_Name",
        "GEO_Code",
        F.col("y").cast("bigint").alias("Year"),
        F.col("mo").cast("bigint").alias("Month"),
        pick(100 + (code * 7 + t * 3) % 50, 100 + (code * 11 + t * 2) % 60).alias("Index_NSA"),
        pick(101 + (code * 5 + t * 3) % 50, 101 + (code * 11 + t * 2) % 60).alias("Index_SA"),
    )
