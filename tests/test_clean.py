from pyspark.sql import functions as F

from tapelake.functions import casts, clean
from tapelake.operators import contract

X = F.col


def test_sentinels(apply):
    score = clean.sentinel_to_null(casts.try_int(X("x")), (9999,))
    assert apply(["9999", "850", None], score) == [None, 850, None]
    rate = clean.sentinel_to_null(casts.try_double(X("x")), (0.0, 999.0))
    assert apply(["0", "0.000", "999", "3.5", None], rate) == [None, None, None, 3.5, None]


def test_scrub_is_idempotent(apply):
    once = clean.sentinel_to_null(X("x"), ("9", "U"))
    twice = clean.sentinel_to_null(once, ("9", "U"))
    values = ["9", "U", "P", None, "99"]
    assert apply(values, once) == apply(values, twice) == [None, None, "P", None, "99"]


def test_offset_precedes_scrub(apply):
    age = clean.sentinel_to_null(clean.one_more(X("x")), (999,))
    assert apply(["998", "999", "359", "x", None, "2147483647"], age) == [None, 1000, 360, None, None, None]


def test_delinquency(apply):
    status = clean.sentinel_to_null(clean.delinquency_code(X("x")), ("XX",))
    assert apply(["0", "RA", "XX", "100", None], status) == ["00", "RA", None, "10", None]


def test_blank_flag(apply):
    assert apply([" ", "", None, "Y", "\t"], clean.blank_to_no(X("x"))) == ["N", "N", "N", "Y", "\t"]


def test_code_maps(apply):
    codes = ["06", "96", "01", "98", "15", "55", None]
    fnm = clean.code_map(X("x"), contract.ZERO_BALANCE_FNM)
    fre = clean.code_map(X("x"), contract.ZERO_BALANCE_FRE)
    assert apply(codes, fnm) == ["Repurchase", "Other/Removal", "Prepayment", "Credit Event", "Note Sale", None, None]
    assert apply(codes, fre) == [None, "Repurchase", "Prepayment", None, "Note Sale", None, None]
    kept = clean.code_map(X("x"), contract.VALUATION_FRE, clean.PASS)
    assert apply(["2", "7", "5", None], kept) == ["A", "7", "5", None]
    assert apply(["P", "Y", None, "x"], clean.code_map(X("x"), contract.MODIFIED_FRE, "N")) == ["Y", "Y", "N", "N"]
    assert apply(["M", "7"], clean.code_map(X("x"), contract.MI_CANCEL_FNM, clean.PASS)) == ["N", "7"]
    assert apply(["M", "7"], clean.code_map(X("x"), contract.MI_CANCEL_FRE, clean.PASS)) == ["M", "NA"]


def test_sums(spark):
    df = spark.createDataFrame([(None, None, None), ("1.5", "bad", "2")], "a string, b string, c string")
    total = clean.null_safe_sum([X("a"), X("b"), X("c")])
    assert sorted(r[0] for r in df.select(total).collect()) == [0.0, 3.5]
    loss = clean.net_loss(X("a"), X("b"), X("c"), [X("a")], [X("c")])
    assert sorted(r[0] for r in df.select(loss).collect()) == [0.0, 0.0]
