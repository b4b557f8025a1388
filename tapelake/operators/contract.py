"""The canonical table: its 52 columns, where each comes from, and what counts as missing.

One row per column holds both agencies' rules, so the two sides of the union cannot drift apart in name or order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType, StringType, StructField, StructType

from tapelake.functions.clean import PASS
from tapelake.operators.rules import (
    Rule,
    blank_no,
    coded,
    delinquency,
    loss,
    mmyyyy,
    number,
    text,
    total,
    whole,
    whole_plus_one,
    yyyymm,
)

TEXT, DATE, WHOLE, NUMBER = StringType(), DateType(), IntegerType(), DoubleType()

FNM, FRE = "FNM", "FRE"


@dataclass(frozen=True)
class CanonicalColumn:
    name: str
    type: DataType
    fnm: Rule
    fre: Rule
    placeholders: tuple = ()

    def rule(self, agency: str) -> Rule:
        return {FNM: self.fnm, FRE: self.fre}[agency]


# Code lists of the two published tape layouts.
ZERO_BALANCE_FNM = {
    "Prepayment": ("01",),
    "Credit Event": ("02", "03", "09", "97", "98"),
    "Note Sale": ("15", "16"),
    "Repurchase": ("06",),
    "Other/Removal": ("96",),
}
ZERO_BALANCE_FRE = {
    "Prepayment": ("01",),
    "Credit Event": ("02", "03", "09"),
    "Note Sale": ("15", "16"),
    "Repurchase": ("96",),
}
VALUATION_FRE = {"W": ("1",), "A": ("2",), "O": ("3",), "C": ("4",)}
PURPOSE_FRE = {"U": ("R",)}
MI_CANCEL_FNM = {"N": ("M",)}
MI_CANCEL_FRE = {"NA": ("7",)}
MODIFIED_FRE = {"Y": ("Y", "P")}
ASSISTANCE_FNM = {"F": ("F",), "R": ("R",), "T": ("T",)}

# Cost fields of the single-file tape.
EXPENSES_FNM = ("column053", "column054", "column055", "column056", "column057")
CREDITS_FNM = ("column059", "column060", "column061")

# Name, type, field of the single-file tape (FNM), field of the origination/performance pair
# (FRE; ``_1`` marks the performance file), placeholder values. Dates take no placeholders.
_C = CanonicalColumn
COLUMNS: tuple[CanonicalColumn, ...] = (
    _C("loan_id", TEXT, text("column001"), text("column00_1")),
    _C("report_period", DATE, mmyyyy("column002"), yyyymm("column01_1")),
    _C("first_pay_date", DATE, mmyyyy("column014"), yyyymm("column01")),
    _C("maturity_date", DATE, mmyyyy("column018"), yyyymm("column03")),
    _C("zero_bal_date", DATE, mmyyyy("column044"), yyyymm("column09_1")),
    _C("ddlpi", DATE, mmyyyy("column050"), yyyymm("column12_1")),
    _C("channel", TEXT, text("column003"), text("column13"), ("9",)),
    _C("seller_name", TEXT, text("column004"), text("column23")),
    _C("servicer_name", TEXT, text("column005"), text("column24")),
    _C("orig_int_rate", NUMBER, number("column007"), number("column12"), (0.0, 999.0)),
    _C("orig_upb", NUMBER, number("column009"), number("column10"), (-1.0,)),
    _C("orig_term", WHOLE, whole("column012"), whole_plus_one("column21"), (999,)),
    _C("orig_ltv", NUMBER, number("column019"), number("column11"), (999.0,)),
    _C("orig_cltv", NUMBER, number("column020"), number("column08"), (999.0,)),
    _C("borrower_count", WHOLE, whole("column021"), whole("column22"), (99,)),
    _C("orig_dti", NUMBER, number("column022"), number("column09"), (999.0,)),
    _C("credit_score", WHOLE, whole("column023"), whole("column00"), (9999,)),
    _C("first_time_buyer", TEXT, text("column025"), text("column02"), ("9",)),
    _C("loan_purpose", TEXT, text("column026"), coded("column20", PURPOSE_FRE, PASS), ("9",)),
    _C("prop_type", TEXT, text("column027"), text("column17")),
    _C("unit_count", WHOLE, whole("column028"), whole("column06"), (99,)),
    _C("occupancy_status", TEXT, text("column029"), text("column07"), ("9", "U")),
    _C("prop_state", TEXT, text("column030"), text("column16")),
    _C("msa_code", TEXT, text("column031"), text("column04")),
    _C("zip_3", TEXT, text("column032"), text("column18"), ("000",)),
    _C("mi_percent", NUMBER, number("column033"), number("column05"), (999.0,)),
    _C("amort_type", TEXT, text("column034"), text("column15")),
    _C("ppm_flag", TEXT, text("column035"), text("column14")),
    _C("io_indicator", TEXT, text("column036"), text("column30")),
    _C("special_elig_prog", TEXT, text("column078"), text("column27"), ("9", "7")),
    _C("valuation_method", TEXT, text("column085"), coded("column29", VALUATION_FRE, PASS), ("7",)),
    _C("super_conf_flag", TEXT, text("column086"), blank_no("column25")),
    _C("current_rate", NUMBER, number("column008"), number("column10_1"), (0.0, 999.0)),
    _C("current_upb", NUMBER, number("column011"), number("column02_1"), (-1.0,)),
    _C("loan_age", WHOLE, whole("column015"), whole_plus_one("column04_1"), (999,)),
    _C("months_to_mat", WHOLE, whole("column017"), whole("column05_1"), (999,)),
    _C("delinq_status", TEXT, text("column039"), delinquency("column03_1"), ("XX",)),
    _C("mod_flag", TEXT, text("column041"), coded("column07_1", MODIFIED_FRE, "N")),
    _C(
        "mi_cancel_flag",
        TEXT,
        coded("column042", MI_CANCEL_FNM, PASS),
        coded("column31", MI_CANCEL_FRE, PASS),
        ("9",),
    ),
    _C("borrower_assist", TEXT, coded("column101", ASSISTANCE_FNM), text("column29_1")),
    # The single-file tape discloses no current valuation; the field read here is its valuation method.
    _C("eltv", NUMBER, number("column085"), number("column25_1"), (999.0,)),
    _C("int_bearing_upb", NUMBER, number("column109"), number("column31_1"), (-1.0,)),
    _C("non_int_upb", NUMBER, total("column062", "column107"), number("column11_1"), (-1.0,)),
    _C("zero_bal_code", TEXT, coded("column043", ZERO_BALANCE_FNM), coded("column08_1", ZERO_BALANCE_FRE)),
    _C("zero_bal_upb", NUMBER, number("column045"), number("column26_1"), (-1.0,)),
    _C("total_expenses", NUMBER, total(*EXPENSES_FNM), number("column16_1"), (-1.0,)),
    _C("net_sales_proc", NUMBER, number("column058"), number("column14_1"), (-1.0,)),
    _C(
        "actual_loss",
        NUMBER,
        loss("column045", "column058", "column083", EXPENSES_FNM, CREDITS_FNM),
        number("column21_1"),
        (-1.0,),
    ),
    _C("delinq_int", NUMBER, number("column084"), number("column27_1"), (-1.0,)),
    _C("current_mod_cost", NUMBER, number("column074"), number("column30_1"), (-1.0,)),
    _C("cumulative_mod_cost", NUMBER, number("column075"), number("column22_1"), (-1.0,)),
    _C("credit_enhancements", NUMBER, total(*CREDITS_FNM), total("column13_1", "column15_1"), (-1.0,)),
)

CANONICAL_SCHEMA = StructType([StructField("agency", TEXT)] + [StructField(c.name, c.type) for c in COLUMNS])


def check_contract(df: DataFrame, expected: StructType = CANONICAL_SCHEMA) -> DataFrame:
    """Return ``df`` if it has exactly the contract's columns, in order and by type; raise ``ValueError`` if not.

    Works on the schema alone: no job runs.
    """
    want = [(f.name, f.dataType) for f in expected]
    have = [(f.name, f.dataType) for f in df.schema]
    if want == have:
        return df
    want_names, have_names = [n for n, _ in want], [n for n, _ in have]
    problems = {
        "missing": [n for n in want_names if n not in have_names],
        "unexpected": [n for n in have_names if n not in want_names],
    }
    if not any(problems.values()):
        problems["out of order"] = [h for w, h in zip(want_names, have_names) if w != h]
        have_types = dict(have)
        problems["wrong type"] = [n for n, t in want if have_types[n] != t]
    found = "; ".join(f"{kind}: {', '.join(names)}" for kind, names in problems.items() if names)
    raise ValueError(f"columns do not match the contract ({found or 'repeated columns'})")
