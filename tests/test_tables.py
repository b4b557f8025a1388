from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapelake.operators import price_index
from tapelake.operators.canonical import canonical, unify
from tapelake.operators.contract import CANONICAL_SCHEMA, COLUMNS, FNM, FRE, check_contract
from tapelake.operators.polish import polish
from tapelake.operators.tape_join import join_performance
from tapelake.operators.valuation import mark_to_market, month_arrays, with_index
from tapelake.sources.tapes import FNM_FIELDS, FRE_FIELDS, orphan_quarters, paired


def tape(spark, fields, *rows, extra=""):
    names = [*([extra] if extra else []), *fields]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def fre_tape(spark, orig, perf):
    o = tape(spark, FRE_FIELDS, *orig, extra="quarter")
    return join_performance(o, tape(spark, FRE_FIELDS, *perf, extra="quarter"))


def loans(spark, *rows):
    """Canonical rows from a few named values."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in CANONICAL_SCHEMA) for r in rows], CANONICAL_SCHEMA)


INDEX = "GEO_Type string, GEO_Name string, msa_code string, hpi_date date, index_nsa double, index_sa double"
JAN, FEB = date(2021, 1, 1), date(2021, 2, 1)


def index(spark):
    rows = [
        ("State", "TX", None, JAN, 100.0, 1.0),
        ("State", "TX", None, FEB, 110.0, 1.0),
        ("CBSA", "Austin", "12420", JAN, 100.0, 1.0),
        ("CBSA", "Austin", "12420", FEB, 200.0, 1.0),
        ("CBSA", "Waco", "47380", FEB, 150.0, 1.0),
        ("CBSA", "Zero", "00001", JAN, 0.0, 1.0),
        ("CBSA", "Zero", "00001", FEB, 10.0, 1.0),
        ("US", "USA", None, JAN, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, INDEX)


def test_contract_size_and_order(spark):
    assert len(COLUMNS) == 52 and len({c.name for c in COLUMNS}) == 52
    assert canonical(tape(spark, FNM_FIELDS), FNM).schema.names == CANONICAL_SCHEMA.names
    empty_fre = fre_tape(spark, [], [])
    assert check_contract(canonical(empty_fre, FRE)).columns[:3] == ["agency", "loan_id", "report_period"]


def test_contract_errors(spark):
    good = loans(spark)
    assert check_contract(good) is good
    with pytest.raises(ValueError, match="missing: eltv"):
        check_contract(good.drop("eltv"))
    with pytest.raises(ValueError, match="unexpected: more"):
        check_contract(good.withColumn("more", F.lit(1)))
    swapped = ["agency", "report_period", "loan_id", *good.columns[3:]]
    with pytest.raises(ValueError, match="out of order: report_period, loan_id"):
        unify(good, good.select(*swapped))
    with pytest.raises(ValueError, match="wrong type: eltv"):
        check_contract(good.withColumn("eltv", F.lit("x")))
    with pytest.raises(ValueError, match="repeated"):
        check_contract(good.select("*", "eltv"), StructType(good.schema.fields))


def test_fnm_row(spark):
    row = {
        "column001": "L1", "column002": "022021", "column003": "9", "column012": "360.0", "column019": "999",
        "column025": "y", "column029": "U", "column039": "XX", "column042": "M", "column043": "96",
        "column045": "100", "column058": "40", "column083": "5", "column053": "66", "column085": "A", "column101": "7",
    }
    (got,) = canonical(tape(spark, FNM_FIELDS, row), FNM).collect()
    assert (got.loan_id, got.report_period, got.channel, got.orig_term, got.orig_ltv) == ("L1", FEB, None, 360, None)
    assert (got.first_time_buyer, got.occupancy_status, got.delinq_status, got.mi_cancel_flag) == ("y", None, None, "N")
    assert (got.zero_bal_code, got.valuation_method, got.eltv, got.borrower_assist) == ("Other/Removal", "A", None, None)
    # 100 - 40 + 5 - 66 is exactly the placeholder -1
    assert (got.actual_loss, got.total_expenses, got.non_int_upb, got.mod_flag) == (None, 66.0, 0.0, None)


def test_orig_perf_join(spark):
    orig = [
        {"quarter": "2021Q1", "column19": "A", "column10": "1"},
        {"quarter": "2021Q2", "column19": "A", "column10": "2"},
        {"quarter": "2021Q1", "column19": "B", "column10": "3"},
        {"quarter": "2021Q1", "column19": None, "column10": "4"},
    ]
    perf = [
        {"quarter": "2021Q1", "column00": "A", "column01": "202101"},
        {"quarter": "2021Q1", "column00": "A", "column01": "202102"},
        {"quarter": "2021Q1", "column00": "Z", "column01": "202101"},
        {"quarter": "2021Q1", "column00": None, "column01": "202101"},
    ]
    joined = fre_tape(spark, orig, perf)
    assert len(joined.columns) == 1 + 64
    got = sorted((r.quarter, r.column10, r.column00_1, r.column01_1) for r in joined.fillna("-").collect())
    assert got == [
        ("2021Q1", "1", "A", "202101"),
        ("2021Q1", "1", "A", "202102"),
        ("2021Q1", "3", "-", "-"),
        ("2021Q1", "4", "-", "-"),
        ("2021Q2", "2", "-", "-"),
    ]
    orphan = canonical(joined.where("column10 = '3'"), FRE).first()
    assert (orphan.loan_id, orphan.mod_flag, orphan.super_conf_flag) == (None, "N", "N")


def test_pairing(spark):
    orig = spark.createDataFrame([("2021Q1", 1), ("2021Q2", 2)], "quarter string, x int")
    perf = spark.createDataFrame([("2021Q1",), ("2021Q3",)], "quarter string")
    assert [r.quarter for r in orphan_quarters(orig, perf).collect()] == ["2021Q2"]
    assert [r.x for r in paired(orig, perf).collect()] == [1]


def test_standardise_index(spark):
    raw = spark.createDataFrame(
        [("CBSA", "Abilene", 180, 2021, 2, 1.0, 2.0), ("State", "TX", 48, 2021, 12, 1.0, 2.0), ("US", "USA", None, 2021, 13, 1.0, 2.0)],
        "GEO_Type string, GEO_Name string, GEO_Code long, Year long, Month long, Index_NSA double, Index_SA double",
    )
    got = {r.GEO_Name: (r.msa_code, r.hpi_date) for r in price_index.standardise(raw).collect()}
    assert got == {"Abilene": ("00180", FEB), "TX": (None, date(2021, 12, 1)), "USA": (None, None)}
    twice = index(spark).unionAll(index(spark).where("GEO_Name = 'Waco'"))
    assert [(r.geography, r.copies) for r in price_index.duplicate_keys(twice).collect()] == [("47380", 2)]


def loan(**values):
    base = {"agency": "FNM", "prop_state": "TX", "first_pay_date": JAN, "report_period": FEB}
    return base | {"orig_upb": 80.0, "orig_ltv": 80.0, "current_upb": 55.0} | values


CASES = [
    (loan(loan_id="metro", msa_code="12420"), 27.5, 27.5),
    (loan(loan_id="no origin month", msa_code="47380"), 50.0, 50.0),
    (loan(loan_id="zero index", msa_code="00001"), 50.0, 50.0),
    (loan(loan_id="no metro"), 50.0, 50.0),
    (loan(loan_id="nowhere", prop_state="ZZ"), None, None),
    (loan(loan_id="no ltv", orig_ltv=0.0), None, None),
    (loan(loan_id="no upb", orig_upb=0.0), None, None),
    (loan(loan_id="paid", current_upb=0.0), 0.0, 0.0),
    (loan(loan_id="valued", eltv=80.0), 50.0, 80.0),
    (loan(loan_id="unmarked but valued", prop_state=None, eltv=70.0), None, 70.0),
]


@pytest.mark.parametrize("max_rows", [1_000_000, 1])
def test_mark_to_market(spark, max_rows):
    marked = mark_to_market(loans(spark, *[c[0] for c in CASES]), index(spark), max_rows)
    got = {r.loan_id: (r.mtm_cltv, r.final_cltv) for r in marked.collect()}
    assert got == {c["loan_id"]: (mtm, final) for c, mtm, final in CASES}
    assert marked.columns[-4:] == ["j_orig_dt", "j_now_dt", "mtm_cltv", "final_cltv"] and len(marked.columns) == 57


def test_months_are_addressed_by_their_place(spark):
    months = [date(2020, 11, 1), date(2020, 12, 1), date(2021, 3, 1), date(2021, 3, 1)]
    rows = [("State", "TX", None, m, v, 0.0) for m, v in zip(months, (1.0, None, 4.0, 3.0), strict=True)]
    rows += [("State", None, None, months[0], 9.0, 0.0), ("State", "ZZ", None, None, 9.0, 0.0), ("CBSA", "Waco", "47380", months[0], 7.0, 0.0)]
    table = spark.createDataFrame(rows, "GEO_Type string, GEO_Name string, msa_code string, hpi_date date, index_nsa double, index_sa double")
    got = {r.geo: (r.first_month, r.months) for r in month_arrays(table, "State").collect()}
    assert got == {"TX": (2020 * 12 + 11, [1.0, None, None, None, 4.0])}
    keyed = spark.createDataFrame(
        [(i, s, a, b) for i, (s, a, b) in enumerate([("TX", months[0], months[2]), ("TX", date(2020, 10, 1), date(2021, 4, 1)), ("TX", None, date(2021, 1, 1)), ("ZZ", months[0], months[0]), (None, months[0], None)])],
        "i int, prop_state string, j_orig_dt date, j_now_dt date",
    )
    for max_rows in (1_000_000, 1):
        found = {r.i: (r.state_index_orig, r.state_index_now) for r in with_index(keyed, table, "State", max_rows).collect()}
        assert found == {0: (1.0, 4.0), 1: (None, None), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_polish(spark):
    rows = [
        {"agency": "FRE", "seller_name": "Bank a", "msa_code": "00000", "zip_3": "48200"},
        {"agency": "FRE", "servicer_name": "b", "msa_code": "12420", "zip_3": "00000"},
    ]
    marked = mark_to_market(loans(spark, *rows), index(spark))
    final = polish(marked)
    assert len(final.columns) == 53
    assert final.columns[-4:] == ["seller_name", "servicer_name", "msa_code", "zip_3"]
    got = {(r.seller_name, r.servicer_name, r.msa_code, r.zip_3) for r in final.collect()}
    assert got == {("BANK A", None, None, "482"), (None, "B", "12420", "000")}


def test_originations_are_shuffled_once_and_null_keys_match_nothing(spark):
    orig = spark.createDataFrame([("q", "a", "1"), ("q", "b", "2"), (None, "a", "3"), ("q", None, "4")], "quarter string, column19 string, column00 string")
    perf = spark.createDataFrame([("q", "a", "x"), ("q", "a", "y"), (None, "a", "z"), ("q", None, "w")], "quarter string, column00 string, column01 string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_performance(orig, perf)
        rows = sorted((r.column00, r.quarter, r.column19, r.column00_1, r.column01_1) for r in joined.collect())
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows[:2] == [("1", "q", "a", "a", "x"), ("1", "q", "a", "a", "y")]
    assert rows[2:] == [("2", "q", "b", None, None), ("3", None, "a", None, None), ("4", "q", None, None, None)]
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_a_small_side_is_hashed_and_the_wide_one_not_sorted(spark):
    orig = spark.range(2000).selectExpr("'q' quarter", "cast(id as string) column19")
    perf = spark.range(9000).selectExpr("'q' quarter", "cast(id % 1500 as string) column00", "'x' column01")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_performance(orig, perf)
        assert joined.count() == 9500
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan.split("Initial Plan")[0]
