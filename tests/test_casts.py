import math
import re
from datetime import date

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapelake.functions import casts

X = F.col


def test_try_int(apply):
    texts = ["3.5", "2.5", "-2.5", "360.0", " 12 ", "1e3", "3000000000", "x", "", "1d", "NaN", "inf", None, "0", "-7", "+7"]
    want = [4, 3, -3, 360, 12, 1000, None, None, None, None, None, None, None, 0, -7, 7]
    assert apply(texts, casts.try_int(X("x"))) == want


def test_try_double(apply):
    texts = [" 1.5 ", "1,000", "1d", "12f", "1.f", "1D ", "", "A", "W", None, "1e3", ".5", "5.", "-0.25", "+1"]
    want = [1.5, None, None, None, None, None, None, None, None, None, 1000.0, 0.5, 5.0, -0.25, 1.0]
    assert apply(texts, casts.try_double(X("x"))) == want
    assert apply(["inf", "-Infinity"], casts.try_double(X("x"))) == [math.inf, -math.inf]
    assert math.isnan(apply(["NaN"], casts.try_double(X("x")))[0])


def test_yyyymm(apply):
    texts = ["202101", "20210199", "202113", "202100", "abc", None, "", "+20211", " 20211", "2021", "2021 1"]
    want = [date(2021, 1, 1), date(2021, 1, 1)] + [None] * 9
    assert apply(texts, casts.yyyymm_to_date(X("x"))) == want


def test_mmyyyy(apply):
    texts = ["012021", "122021", "132021", "12021", "002021", "x", None, "", "1 2021", "+12021", "12021 "]
    want = [date(2021, 1, 1), date(2021, 12, 1), None, date(2021, 12, 1), None, None, None, None, None, None, None]
    assert apply(texts, casts.mmyyyy_to_date(X("x"))) == want


def test_casts_without_ansi(spark, apply):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert apply(["bad", "1.5", "12"], casts.try_int(X("x"))) == [None, 2, 12]
        assert apply(["bad", "202113", "202112"], casts.yyyymm_to_date(X("x"))) == [None, None, date(2021, 12, 1)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_round_half_away(apply):
    values = [1.005, 2.675, -2.5, 0.125, 1e300, float("inf"), None, 0.0, 2.5]
    got = apply(values, casts.round_half_away(X("x"), 2), "double")
    assert got == [1.0, 2.68, -2.5, 0.13, 1e300, math.inf, None, 0.0, 2.5]
    assert apply([2.5, -2.5, 0.4999], casts.round_half_away(X("x"), 0), "double") == [3.0, -3.0, 0.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.decimals(-10**7, 10**7, places=3).map(float), min_size=20, max_size=40))
def test_round_equals_sql(apply, values):
    want = [duckdb.execute("SELECT round(?, 2)", [v]).fetchone()[0] for v in values]
    assert apply(values, casts.round_half_away(X("x"), 2), "double") == want


def test_numbers_equal_sql(apply):
    pieces = ["", "-", "+", "1", "12", "007", "3.5", ".5", "5.", "1e2", "1E-1", "e", "x", " ", "2147483647", "99999999999"]
    # Left out: exponents of five digits and more overflow the SQL engine's own counter, and it reads '1E-15.' as the
    # integer 0 although it is no number to it as a double.
    texts = sorted(t for t in {a + b for a in pieces for b in pieces} if not re.search(r"[eE]-?(\d{5}|\d+\.)", t))
    sql = [duckdb.execute("SELECT TRY_CAST(? AS DOUBLE), TRY_CAST(? AS INTEGER)", [t, t]).fetchone() for t in texts]
    assert apply(texts, casts.try_double(X("x"))) == [d for d, _ in sql]
    assert apply(texts, casts.try_int(X("x"))) == [i for _, i in sql]


def test_months_equal_sql(apply):
    texts = [f"{a}{b}" for a in ("2021", "1999", "1042", "12", "01", "13") for b in ("01", "12", "13", "2021", "00", "x1")]
    cut = [t for t in texts if len(t) >= 6 and t[0] != "0"]
    want = [duckdb.execute("SELECT CAST(try_strptime(left(?, 6), '%Y%m') AS DATE)", [t]).fetchone()[0] for t in cut]
    assert apply(cut, casts.yyyymm_to_date(X("x"))) == want
