"""The SQL each query is checked against, for DuckDB on the same tables.

Tables that several checks share are named below once and pulled in as common table expressions where used.
"""

from __future__ import annotations

import re

from catalog import standins
from tapelake.sources.tapes import FNM_FIELDS, FRE_FIELDS

_TABLES = {name: name for name in ("orders", "customer", "nation", "lineitem")}


def _num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _int(c: str) -> str:
    return f"TRY_CAST({c} AS INTEGER)"


def _zero(c: str) -> str:
    return f"coalesce({_num(c)}, 0)"


def _ym(c: str) -> str:
    return f"CAST(try_strptime(left({c}, 6), '%Y%m') AS DATE)"


def _my(c: str) -> str:
    return f"CAST(try_strptime(concat(right({c}, 4), left({c}, 2)), '%Y%m') AS DATE)"


def _not(value: str, *placeholders: str) -> str:
    for placeholder in placeholders:
        value = f"nullif({value}, {placeholder})"
    return value


_EXPENSES = ["column053", "column054", "column055", "column056", "column057"]
_CREDITS = ["column059", "column060", "column061"]
_EXPENSE_SUM = " + ".join(map(_zero, _EXPENSES))
_LOSS = " - ".join([f"{_zero('column045')} - {_zero('column058')} + {_zero('column083')}", *map(_zero, _EXPENSES + _CREDITS)])

_FRE_REASON = """
 CASE WHEN {c} = '01' THEN 'Prepayment' WHEN {c} IN ('02', '03', '09') THEN 'Credit Event'
  WHEN {c} IN ('15', '16') THEN 'Note Sale' WHEN {c} = '96' THEN 'Repurchase' END"""
_VALUATION = "coalesce(map {'1': 'W', '2': 'A', '3': 'O', '4': 'C'}[column29], column29)"

_CTES = {
    "orig_tape": standins.ORIG_SQL.format(**_TABLES),
    "perf_tape": standins.PERF_SQL.format(**_TABLES),
    "fnm_tape": standins.FNM_SQL.format(**_TABLES),
    "months": standins.MONTHS_SQL,
    "raw_index": standins.INDEX_SQL,
    "price_index": """
SELECT GEO_Type, GEO_Name, CASE WHEN GEO_Type = 'CBSA' THEN lpad(CAST(GEO_Code AS VARCHAR), 5, '0') END AS msa_code,
 CAST(concat(Year, '-', lpad(CAST(Month AS VARCHAR), 2, '0'), '-01') AS DATE) AS hpi_date,
 Index_NSA AS index_nsa, Index_SA AS index_sa FROM raw_index""",
    "fre_silver": """
SELECT o.*, p.* EXCLUDE (quarter, column00, column01, column02, column03, column04, column05, column07, column08, column09,
  column10, column11, column12, column13, column14, column15, column16, column21, column22, column25, column26, column27,
  column29, column30, column31),
 p.column00 AS column00_1, p.column01 AS column01_1, p.column02 AS column02_1, p.column03 AS column03_1,
 p.column04 AS column04_1, p.column05 AS column05_1, p.column07 AS column07_1, p.column08 AS column08_1,
 p.column09 AS column09_1, p.column10 AS column10_1, p.column11 AS column11_1, p.column12 AS column12_1,
 p.column13 AS column13_1, p.column14 AS column14_1, p.column15 AS column15_1, p.column16 AS column16_1,
 p.column21 AS column21_1, p.column22 AS column22_1, p.column25 AS column25_1, p.column26 AS column26_1,
 p.column27 AS column27_1, p.column29 AS column29_1, p.column30 AS column30_1, p.column31 AS column31_1,
 'freddie' AS agency
FROM orig_tape AS o LEFT JOIN perf_tape AS p ON o.quarter = p.quarter AND o.column19 = p.column00""",
    "fnm_gold": f"""
SELECT 'FNM' AS agency, column001 AS loan_id, {_my('column002')} AS report_period, {_my('column014')} AS first_pay_date,
 {_my('column018')} AS maturity_date, {_my('column044')} AS zero_bal_date, {_my('column050')} AS ddlpi,
 {_not('column003', "'9'")} AS channel, column004 AS seller_name, column005 AS servicer_name,
 {_not(_num('column007'), '0', '999')} AS orig_int_rate, {_not(_num('column009'), '-1')} AS orig_upb,
 {_not(_int('column012'), '999')} AS orig_term, {_not(_num('column019'), '999')} AS orig_ltv,
 {_not(_num('column020'), '999')} AS orig_cltv, {_not(_int('column021'), '99')} AS borrower_count,
 {_not(_num('column022'), '999')} AS orig_dti, {_not(_int('column023'), '9999')} AS credit_score,
 {_not('column025', "'9'")} AS first_time_buyer, {_not('column026', "'9'")} AS loan_purpose, column027 AS prop_type,
 {_not(_int('column028'), '99')} AS unit_count, {_not('column029', "'9'", "'U'")} AS occupancy_status,
 column030 AS prop_state, column031 AS msa_code, {_not('column032', "'000'")} AS zip_3,
 {_not(_num('column033'), '999')} AS mi_percent, column034 AS amort_type, column035 AS ppm_flag,
 column036 AS io_indicator, {_not('column078', "'9'", "'7'")} AS special_elig_prog,
 {_not('column085', "'7'")} AS valuation_method, column086 AS super_conf_flag,
 {_not(_num('column008'), '0', '999')} AS current_rate,
 {_not(_num('column011'), '-1')} AS current_upb, {_not(_int('column015'), '999')} AS loan_age,
 {_not(_int('column017'), '999')} AS months_to_mat, {_not('column039', "'XX'")} AS delinq_status,
 column041 AS mod_flag, {_not("CASE WHEN column042 = 'M' THEN 'N' ELSE column042 END", "'9'")} AS mi_cancel_flag,
 CASE WHEN column101 IN ('F', 'R', 'T') THEN column101 END AS borrower_assist,
 {_not(_num('column085'), '999')} AS eltv, {_not(_num('column109'), '-1')} AS int_bearing_upb,
 {_not(f"{_zero('column062')} + {_zero('column107')}", '-1')} AS non_int_upb,
 CASE WHEN column043 = '01' THEN 'Prepayment' WHEN column043 IN ('02', '03', '09', '97', '98') THEN 'Credit Event'
  WHEN column043 IN ('15', '16') THEN 'Note Sale' WHEN column043 = '06' THEN 'Repurchase'
  WHEN column043 = '96' THEN 'Other/Removal' END AS zero_bal_code,
 {_not(_num('column045'), '-1')} AS zero_bal_upb, {_not(_EXPENSE_SUM, '-1')} AS total_expenses,
 {_not(_num('column058'), '-1')} AS net_sales_proc, {_not(_LOSS, '-1')} AS actual_loss,
 {_not(_num('column084'), '-1')} AS delinq_int, {_not(_num('column074'), '-1')} AS current_mod_cost,
 {_not(_num('column075'), '-1')} AS cumulative_mod_cost,
 {_not(' + '.join(map(_zero, _CREDITS)), '-1')} AS credit_enhancements
FROM fnm_tape""",
    "fre_gold": f"""
SELECT 'FRE' AS agency, column00_1 AS loan_id, {_ym('column01_1')} AS report_period, {_ym('column01')} AS first_pay_date,
 {_ym('column03')} AS maturity_date, {_ym('column09_1')} AS zero_bal_date, {_ym('column12_1')} AS ddlpi,
 {_not('column13', "'9'")} AS channel, column23 AS seller_name, column24 AS servicer_name,
 {_not(_num('column12'), '0', '999')} AS orig_int_rate, {_not(_num('column10'), '-1')} AS orig_upb,
 {_not(_int('column21') + ' + 1', '999')} AS orig_term, {_not(_num('column11'), '999')} AS orig_ltv,
 {_not(_num('column08'), '999')} AS orig_cltv, {_not(_int('column22'), '99')} AS borrower_count,
 {_not(_num('column09'), '999')} AS orig_dti, {_not(_int('column00'), '9999')} AS credit_score,
 {_not('column02', "'9'")} AS first_time_buyer,
 {_not("CASE WHEN column20 = 'R' THEN 'U' ELSE column20 END", "'9'")} AS loan_purpose, column17 AS prop_type,
 {_not(_int('column06'), '99')} AS unit_count, {_not('column07', "'9'", "'U'")} AS occupancy_status,
 column16 AS prop_state, column04 AS msa_code, {_not('column18', "'000'")} AS zip_3,
 {_not(_num('column05'), '999')} AS mi_percent, column15 AS amort_type, column14 AS ppm_flag,
 column30 AS io_indicator, {_not('column27', "'9'", "'7'")} AS special_elig_prog,
 {_not(_VALUATION, "'7'")} AS valuation_method, coalesce(nullif(trim(column25), ''), 'N') AS super_conf_flag,
 {_not(_num('column10_1'), '0', '999')} AS current_rate, {_not(_num('column02_1'), '-1')} AS current_upb,
 {_not(_int('column04_1') + ' + 1', '999')} AS loan_age, {_not(_int('column05_1'), '999')} AS months_to_mat,
 {_not("if(column03_1 = 'RA', 'RA', lpad(column03_1, 2, '0'))", "'XX'")} AS delinq_status,
 if(column07_1 IN ('Y', 'P'), 'Y', 'N') AS mod_flag,
 {_not("CASE WHEN column31 = '7' THEN 'NA' ELSE column31 END", "'9'")} AS mi_cancel_flag,
 column29_1 AS borrower_assist, {_not(_num('column25_1'), '999')} AS eltv,
 {_not(_num('column31_1'), '-1')} AS int_bearing_upb, {_not(_num('column11_1'), '-1')} AS non_int_upb,
 {_FRE_REASON.format(c='column08_1')} AS zero_bal_code, {_not(_num('column26_1'), '-1')} AS zero_bal_upb,
 {_not(_num('column16_1'), '-1')} AS total_expenses, {_not(_num('column14_1'), '-1')} AS net_sales_proc,
 {_not(_num('column21_1'), '-1')} AS actual_loss, {_not(_num('column27_1'), '-1')} AS delinq_int,
 {_not(_num('column30_1'), '-1')} AS current_mod_cost, {_not(_num('column22_1'), '-1')} AS cumulative_mod_cost,
 {_not(f"{_zero('column13_1')} + {_zero('column15_1')}", '-1')} AS credit_enhancements
FROM fre_silver""",
    "gold": "SELECT * FROM fnm_gold UNION ALL SELECT * FROM fre_gold",
    "keyed": """
SELECT *, CAST(date_trunc('month', first_pay_date) AS DATE) AS j_orig_dt, CAST(date_trunc('month', report_period) AS DATE) AS j_now_dt
FROM gold""",
    "indexed": """
SELECT k.*, so.index_nsa AS state_index_orig, sn.index_nsa AS state_index_now, mo.index_nsa AS msa_index_orig, mn.index_nsa AS msa_index_now
FROM keyed AS k
LEFT JOIN price_index AS so ON so.GEO_Type = 'State' AND so.GEO_Name = k.prop_state AND so.hpi_date = k.j_orig_dt
LEFT JOIN price_index AS sn ON sn.GEO_Type = 'State' AND sn.GEO_Name = k.prop_state AND sn.hpi_date = k.j_now_dt
LEFT JOIN price_index AS mo ON mo.GEO_Type = 'CBSA' AND mo.msa_code = k.msa_code AND mo.hpi_date = k.j_orig_dt
LEFT JOIN price_index AS mn ON mn.GEO_Type = 'CBSA' AND mn.msa_code = k.msa_code AND mn.hpi_date = k.j_now_dt""",
    "ratioed": """
SELECT *, coalesce(msa_index_now / nullif(msa_index_orig, 0), state_index_now / nullif(state_index_orig, 0)) AS ratio FROM indexed""",
    "valued": """
SELECT *, round(current_upb / nullif((orig_upb / (nullif(orig_ltv, 0) / 100)) * ratio, 0) * 100, 2) AS mtm_cltv FROM ratioed""",
    "marked": """
SELECT * EXCLUDE (state_index_orig, state_index_now, msa_index_orig, msa_index_now, ratio), coalesce(eltv, mtm_cltv) AS final_cltv
FROM valued""",
    "final": """
SELECT * EXCLUDE (amort_type, ppm_flag, io_indicator, eltv)
 REPLACE (upper(seller_name) AS seller_name, upper(servicer_name) AS servicer_name, nullif(msa_code, '00000') AS msa_code, left(zip_3, 3) AS zip_3)
FROM marked""",
}


def _with(sql: str) -> str:
    """Put the shared tables a statement uses, and those they use, in front of it."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text):
            if name in _CTES and name not in needed:
                add(_CTES[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    return (f"WITH {', '.join(f'{name} AS ({_CTES[name]})' for name in needed)} " if needed else "") + sql.strip()


_DATES = ["report_period", "first_pay_date", "maturity_date", "zero_bal_date", "ddlpi"]
_TEXTS = [
    *("loan_id", "channel", "seller_name", "servicer_name", "first_time_buyer", "loan_purpose", "prop_type"),
    *("occupancy_status", "prop_state", "msa_code", "zip_3", "amort_type", "ppm_flag", "io_indicator"),
    *("special_elig_prog", "valuation_method", "super_conf_flag", "delinq_status", "mod_flag", "mi_cancel_flag"),
    *("borrower_assist", "zero_bal_code"),
]
_CONTRACT = [c.strip() for c in """
loan_id, report_period, first_pay_date, maturity_date, zero_bal_date, ddlpi, channel, seller_name, servicer_name,
orig_int_rate, orig_upb, orig_term, orig_ltv, orig_cltv, borrower_count, orig_dti, credit_score, first_time_buyer,
loan_purpose, prop_type, unit_count, occupancy_status, prop_state, msa_code, zip_3, mi_percent, amort_type, ppm_flag,
io_indicator, special_elig_prog, valuation_method, super_conf_flag, current_rate, current_upb, loan_age, months_to_mat,
delinq_status, mod_flag, mi_cancel_flag, borrower_assist, eltv, int_bearing_upb, non_int_upb, zero_bal_code,
zero_bal_upb, total_expenses, net_sales_proc, actual_loss, delinq_int, current_mod_cost, cumulative_mod_cost,
credit_enhancements""".split(",")]
_NUMBERS = [c for c in _CONTRACT if c not in _DATES and c not in _TEXTS]
_GONE = ["amort_type", "ppm_flag", "io_indicator", "eltv"]
_MOVED = ["seller_name", "servicer_name", "msa_code", "zip_3"]
_FINAL = [
    *["agency", *[c for c in _CONTRACT if c not in _GONE + _MOVED]],
    *["j_orig_dt", "j_now_dt", "mtm_cltv", "final_cltv"],
    *_MOVED,
]
_MARKED_NUMBERS = [*_NUMBERS, "mtm_cltv", "final_cltv"]
_FINAL_NUMBERS = [c for c in _MARKED_NUMBERS if c not in _GONE]
_FINAL_TEXTS = ["agency", *[c for c in _TEXTS if c not in _GONE]]


def _type_name(column: str) -> str:
    if column in _DATES or column in ("j_orig_dt", "j_now_dt"):
        return "date"
    if column in ("orig_term", "borrower_count", "credit_score", "unit_count", "loan_age", "months_to_mat"):
        return "int"
    return "double" if column in _MARKED_NUMBERS else "string"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _numeric_profile(source: str, columns: list[str]) -> str:
    return _union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, CAST(min({c}) AS DOUBLE) AS min_value, "
        f"CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 6) AS mean_value FROM {source}"
        for c in columns
    )


def _metrics(source: str, columns: list[str]) -> str:
    metrics = {"null_count": "count(*) - count({c})", "min_value": "min({c})", "max_value": "max({c})", "mean_value": "avg({c})"}
    return _union(
        f"SELECT '{c}' AS column_name, '{m}' AS metric, round(CAST({e.format(c=c)} AS DOUBLE), 4) AS expected FROM {source}"
        for c in columns
        for m, e in metrics.items()
    )


def _fields(table: str, names: list[str], suffix: str = "") -> str:
    """All fields of a layout as columns; those that the stand-in leaves out are NULL."""
    there = set(re.findall(r"AS (column\d+)", _CTES[table]))
    return ", ".join(n + suffix if n in there else f"CAST(NULL AS VARCHAR) AS {n}{suffix}" for n in names)


def _within(columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{q}' AS quartile, true AS within" for c in columns for q in ("q1", "median", "q3"))


# The one field that each of these columns is cast from.
_CAST_FNM = {
    _my: {"report_period": "002", "first_pay_date": "014", "maturity_date": "018", "zero_bal_date": "044", "ddlpi": "050"},
    _num: {
        **{"orig_int_rate": "007", "orig_upb": "009", "orig_ltv": "019", "orig_cltv": "020", "orig_dti": "022", "mi_percent": "033"},
        **{"current_rate": "008", "current_upb": "011", "eltv": "085", "int_bearing_upb": "109", "zero_bal_upb": "045"},
        **{"net_sales_proc": "058", "delinq_int": "084", "current_mod_cost": "074", "cumulative_mod_cost": "075"},
    },
    _int: {"orig_term": "012", "borrower_count": "021", "credit_score": "023", "unit_count": "028", "loan_age": "015", "months_to_mat": "017"},
}
_CAST_FRE = {
    _ym: {"report_period": "01_1", "first_pay_date": "01", "maturity_date": "03", "zero_bal_date": "09_1", "ddlpi": "12_1"},
    _num: {
        **{"orig_int_rate": "12", "orig_upb": "10", "orig_ltv": "11", "orig_cltv": "08", "orig_dti": "09", "mi_percent": "05"},
        **{"current_rate": "10_1", "current_upb": "02_1", "eltv": "25_1", "int_bearing_upb": "31_1", "non_int_upb": "11_1"},
        **{"zero_bal_upb": "26_1", "total_expenses": "16_1", "net_sales_proc": "14_1", "actual_loss": "21_1", "delinq_int": "27_1"},
        **{"current_mod_cost": "30_1", "cumulative_mod_cost": "22_1"},
    },
    _int: {"orig_term": "21", "borrower_count": "22", "credit_score": "00", "unit_count": "06", "loan_age": "04_1", "months_to_mat": "05_1"},
}


def _failures(agency: str, source: str, casts: dict) -> str:
    return _union(
        f"SELECT '{agency}' AS agency, '{c}' AS column_name, count(*) FILTER (trim(column{f}) <> '' AND {cast('column' + f)} IS NULL) AS failures FROM {source}"
        for cast, columns in casts.items()
        for c, f in columns.items()
    )


_SHIP_QUARTER = """concat(CAST(CAST(left(column01, 4) AS INTEGER) + 10 AS VARCHAR), 'Q',
 CAST(CAST(ceil(CAST(right(column01, 2) AS INTEGER) / 3) AS INTEGER) AS VARCHAR))"""

_ORACLES = {
    "src_pipe_text": f"SELECT {_fields('fnm_tape', FNM_FIELDS)} FROM fnm_tape",
    "src_typed_csv": "SELECT * FROM raw_index",
    "src_parquet": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "src_parquet_glob": "SELECT quarter, column00, column01, column02 FROM perf_tape",
    "src_zip_members": f"""
SELECT 'origination' AS kind, quarter, {_fields("orig_tape", FRE_FIELDS)} FROM orig_tape
UNION ALL SELECT 'performance', quarter, {_fields("perf_tape", FRE_FIELDS)} FROM perf_tape""",
    "src_zip_single_file": f"SELECT {_fields('fnm_tape', FNM_FIELDS)} FROM fnm_tape",
    "src_zip_split": f"""
SELECT 'whole.zip' AS source, 'tapes.zip' AS entry, 'tape.csv' AS member, {_fields("fnm_tape", FNM_FIELDS)} FROM fnm_tape""",
    "src_zip_source": f"""
SELECT concat(left(quarter, 4), '.zip') AS source, quarter, {_fields("perf_tape", FRE_FIELDS)} FROM perf_tape WHERE quarter IN ('2005Q1', '2006Q2')""",
    "stream_archives": "SELECT * FROM final WHERE agency = 'FNM'",
    "ingest_second_archive": f"""
SELECT 'fannie' AS agency, if(CAST(column001 AS BIGINT) % 2 = 0, 'first.zip', 'second.zip') AS archive, {_fields("fnm_tape", FNM_FIELDS)} FROM fnm_tape""",
    "ingest_duplicate_vintage": """
SELECT 'loaded' AS status, count(DISTINCT quarter) AS sources, count(*) AS row_count FROM fre_silver
UNION ALL SELECT 'superseded', (SELECT count(DISTINCT quarter) FROM orig_tape) + (SELECT count(DISTINCT quarter) FROM perf_tape), 0""",
    "dataset_footprint": f"""
SELECT sum(octet_length(CAST(concat_ws('|', {", ".join(f"coalesce({c}, '')" for c in re.findall(r"column[0-9]+", _fields("perf_tape", FRE_FIELDS)))}) AS BLOB)) + 1)::BIGINT AS bytes
FROM (SELECT {_fields("perf_tape", FRE_FIELDS)} FROM perf_tape)""",
    "refresh_incremental": """
SELECT 'FNM' AS agency, if(CAST(loan_id AS BIGINT) % 2 = 0, 'early.zip', 'late.zip') AS part, count(*) AS row_count, round(avg(final_cltv), 6) AS mean_cltv,
 CAST(loan_id AS BIGINT) % 2 = 1 AS replaced
FROM final WHERE agency = 'FNM' GROUP BY CAST(loan_id AS BIGINT) % 2
UNION ALL
SELECT 'FRE', concat(CAST(year(first_pay_date) + 10 AS VARCHAR), 'Q', CAST(quarter(first_pay_date) AS VARCHAR)), count(*), round(avg(final_cltv), 6), false
FROM final WHERE agency = 'FRE' GROUP BY year(first_pay_date), quarter(first_pay_date)""",
    "profile_from_states": _numeric_profile("final", _FINAL_NUMBERS),
    "cast_failures": f"SELECT * FROM ({_failures('FNM', 'fnm_tape', _CAST_FNM)} UNION ALL {_failures('FRE', 'fre_silver', _CAST_FRE)}) WHERE failures > 0",
    "profile_report": """
SELECT 'rows ' || agency AS figure, CAST(count(*) AS DOUBLE) AS value FROM final GROUP BY agency
UNION ALL SELECT 'negative age pct', round(100.0 * count(*) FILTER (loan_age < 0) / count(*), 4) FROM final""",
    "profile_quantiles_approx": _within(_FINAL_NUMBERS),
    "profile_quantiles_percentile": _within(_FINAL_NUMBERS),
    "src_quarter_from_path": "SELECT quarter, count(*) AS row_count, count(column25) AS valuations FROM perf_tape GROUP BY quarter",
    "manifest_orphans": f"""
SELECT DISTINCT {_SHIP_QUARTER} AS quarter FROM perf_tape EXCEPT SELECT DISTINCT quarter FROM perf_tape""",
    "ingest_status": f"""
SELECT q.quarter AS source, if(n.row_count IS NULL, 'no performance file', 'loaded') AS status,
 coalesce(n.row_count, 0) AS row_count, CAST(NULL AS VARCHAR) AS error
FROM (SELECT DISTINCT {_SHIP_QUARTER} AS quarter FROM perf_tape) AS q
LEFT JOIN (SELECT quarter, count(*) AS row_count FROM fre_silver GROUP BY quarter) AS n ON q.quarter = n.quarter
UNION ALL SELECT 'damaged.zip', 'failed', 0, 'BadZipFile'
UNION ALL SELECT 'historical_data_time_2099Q1.txt', 'failed', 0, 'ArrowInvalid'
UNION ALL SELECT 'latin.zip', 'failed', 0, 'ArrowInvalid'
UNION ALL SELECT 'whole.zip', 'loaded', (SELECT count(*) FROM fnm_tape), NULL""",
    "describe_schema": _union(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, '{_type_name(c)}' AS column_type, count({c}) AS \"values\" FROM final"
        for i, c in enumerate(_FINAL, 1)
    ),
    "sink_roundtrip_snappy": f"""
SELECT agency, quarter, column00, column19, {", ".join(f"column{i:02d}_1" for i in (*range(6), *range(7, 17), 21, 22, 25, 26, 27, 29, 30, 31))} FROM fre_silver""",
    "sink_roundtrip_zstd": "SELECT * FROM fnm_gold",
    "sink_overwrite_partition": """
SELECT column19, if(quarter = '2005Q1', 'reload', 'first load') AS load, quarter FROM orig_tape""",
    "view_sql": """
SELECT agency, prop_state, count(*) AS row_count, max(current_upb) AS max_upb FROM gold GROUP BY agency, prop_state""",
    "proj_literal": "SELECT 'fannie' AS agency, column001, column002 FROM fnm_tape",
    "proj_star_dedup": """
SELECT quarter, column00 AS column00_1, column01 AS column01_1, column03 AS column03_1, column25 AS column25_1 FROM perf_tape""",
    "canonical_fnm": "SELECT * FROM fnm_gold",
    "canonical_fre": "SELECT * FROM fre_gold",
    "unify_agencies": "SELECT * FROM gold",
    "month_keys": "SELECT agency, loan_id, first_pay_date, report_period, j_orig_dt, j_now_dt FROM keyed",
    "month_of_timestamp": "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
    "lateral_alias": """
SELECT loan_id, current_upb / orig_upb AS upb_share, coalesce(eltv, current_upb / orig_upb) AS eltv_or_share FROM fnm_gold""",
    "typed_projection": f"""
SELECT column001 AS loan_id, {_my('column018')} AS maturity_date, {_int('column012')} AS orig_term,
 {_num('column008')} AS current_rate, column039 AS delinq_status FROM fnm_tape""",
    "schema_contract": _union(
        f"SELECT {i} AS ordinal, '{c}' AS column_name, count({c}) AS \"values\" FROM gold"
        for i, c in enumerate(["agency", *_CONTRACT], 1)
    ),
    "filter_geo_level": "SELECT * FROM price_index WHERE GEO_Type = 'CBSA'",
    "filter_age_valid": "SELECT agency, loan_id, report_period, loan_age FROM gold WHERE loan_age >= 1",
    "filter_ilike": "SELECT agency, loan_id, first_time_buyer FROM gold WHERE first_time_buyer ILIKE 'y'",
    "negative_age": """
SELECT count(*) FILTER (loan_age < 0) AS matching, count(*) AS total,
 round(100.0 * count(*) FILTER (loan_age < 0) / count(*), 4) AS pct FROM gold""",
    "orig_perf_join": "SELECT quarter, column19, column00, column10, column00_1, column01_1, column02_1 FROM fre_silver",
    "hpi_join_state": "SELECT agency, loan_id, prop_state, j_orig_dt, j_now_dt, state_index_orig, state_index_now FROM indexed",
    "hpi_join_msa": "SELECT agency, loan_id, msa_code, j_orig_dt, j_now_dt, msa_index_orig, msa_index_now FROM indexed",
    "hpi_ratio_fallback": "SELECT agency, loan_id, report_period, ratio FROM ratioed",
    "mtm_enrich": "SELECT * FROM marked",
    "final_ltv": "SELECT agency, loan_id, eltv, mtm_cltv, final_cltv FROM marked",
    "index_duplicates": """
SELECT GEO_Type, msa_code AS geography, hpi_date, 2 AS copies FROM price_index WHERE GEO_Type = 'CBSA'""",
    "row_count": "SELECT count(*) AS row_count FROM gold",
    "count_by_agency": "SELECT agency, count(*) AS row_count FROM gold GROUP BY agency",
    "count_by_geo_type": "SELECT GEO_Type, count(*) AS row_count FROM price_index GROUP BY GEO_Type",
    "verify_by_agency": "SELECT agency, count(*) AS rows, round(avg(final_cltv), 6) AS mean_value FROM marked GROUP BY agency",
    "profile_numeric": _numeric_profile("final", _FINAL_NUMBERS),
    "profile_quantiles_exact": _union(
        f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS probability, round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value FROM final"
        for c in _FINAL_NUMBERS
        for q in (0.25, 0.5, 0.75)
    ),
    "profile_categorical": _union(
        f"SELECT * FROM (SELECT '{c}' AS column_name, {c} AS val, count(*) AS freq, "
        f"round(count(*) * 100.0 / (SELECT count(*) FROM final), 2) AS pct FROM final GROUP BY {c} ORDER BY freq DESC, val NULLS LAST LIMIT 10)"
        for c in _FINAL_TEXTS
    ),
    "topk_values": """
SELECT prop_state, count(*) AS freq, round(count(*) * 100.0 / (SELECT count(*) FROM gold), 2) AS pct
FROM gold GROUP BY prop_state ORDER BY freq DESC, prop_state NULLS LAST LIMIT 10""",
    "group_by_ordinal": "SELECT zero_bal_code AS code, count(*) AS freq FROM gold GROUP BY 1 ORDER BY 2 DESC",
    "agency_split": """
SELECT agency, count(*) AS freq, round(count(*) * 100.0 / (SELECT count(*) FROM gold), 2) AS pct FROM gold GROUP BY agency""",
    "null_density_gain": """
SELECT round(100.0 * (count(*) - count(eltv)) / count(*), 6) AS eltv_null_pct,
 round(100.0 * (count(*) - count(final_cltv)) / count(*), 6) AS final_cltv_null_pct FROM marked""",
    "profile_compare": f"""
SELECT column_name, metric, expected, CASE WHEN column_name <> 'eltv' THEN expected END AS actual,
 if(column_name = 'eltv', 'missing', 'match') AS status FROM ({_metrics('marked', _MARKED_NUMBERS)})""",
    "try_cast_double": f"SELECT column001 AS loan_id, column008 AS raw, {_num('column008')} AS value FROM fnm_tape",
    "try_cast_int": f"""
SELECT column001 AS loan_id, {', '.join(f'{_int(c)} AS {c}_int' for c in ('column012', 'column015', 'column017', 'column023'))}
FROM fnm_tape""",
    "cast_string": """
SELECT l_orderkey, CAST(l_orderkey AS VARCHAR) AS key_text, CAST(l_linenumber AS VARCHAR) AS line_text FROM lineitem""",
    "offset_plus_one": """
SELECT column19 AS loan_id, TRY_CAST(column21 AS INTEGER) + 1 AS orig_term FROM orig_tape
UNION ALL SELECT column00, TRY_CAST(column04 AS INTEGER) + 1 FROM perf_tape""",
    "parse_yyyymm": f"""
SELECT column19 AS loan_id, {_ym('column01')} AS first_pay_date, {_ym('column03')} AS maturity_date, {_ym('column01')} AS cut_to_six
FROM orig_tape""",
    "parse_mmyyyy": f"""
SELECT column001 AS loan_id, {_my('column002')} AS report_period, {_my('column018')} AS maturity_date, {_my('column050')} AS ddlpi
FROM fnm_tape""",
    "str_left_right": "SELECT column001 AS loan_id, right(column014, 4) AS year, left(column014, 2) AS month FROM fnm_tape",
    "build_month_date": "SELECT GEO_Type, GEO_Name, hpi_date FROM price_index",
    "str_lpad": "SELECT column00 AS loan_id, column03 AS raw, lpad(column03, 2, '0') AS padded FROM perf_tape",
    "str_upper": "SELECT column001 AS loan_id, upper(column004) AS seller_name, upper(column005) AS servicer_name FROM fnm_tape",
    "null_safe_sum": f"SELECT column001 AS loan_id, {_EXPENSE_SUM} AS total_expenses FROM fnm_tape",
    "net_loss": f"SELECT column001 AS loan_id, {_LOSS} AS net_loss FROM fnm_tape",
    "nullif_code": "SELECT column19 AS loan_id, nullif(column04, '00000') AS msa_code FROM orig_tape",
    "code_map": f"SELECT column00 AS loan_id, column08 AS code, {_FRE_REASON.format(c='column08')} AS reason FROM perf_tape",
    "code_map_passthrough": f"""
SELECT column19 AS loan_id, {_VALUATION} AS valuation_method, if(column20 = 'R', 'U', column20) AS loan_purpose FROM orig_tape""",
    "code_map_default": "SELECT column00 AS loan_id, if(column07 IN ('Y', 'P'), 'Y', 'N') AS mod_flag FROM perf_tape",
    "round2": "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 2) AS net FROM lineitem",
    "sentinel_null": "SELECT column19 AS loan_id, nullif(CAST(column00 AS INTEGER), 9999) AS credit_score FROM orig_tape",
    "sentinel_multi": """
SELECT column19 AS loan_id, nullif(nullif(CAST(column12 AS DOUBLE), 0), 999) AS orig_int_rate,
 nullif(nullif(column07, '9'), 'U') AS occupancy_status FROM orig_tape""",
    "flag_normalise": """
SELECT column19 AS loan_id, column25 AS raw, coalesce(nullif(trim(column25), ''), 'N') AS flag FROM orig_tape""",
    "delinq_pad": """
SELECT column00 AS loan_id, column03 AS raw, nullif(if(column03 = 'RA', 'RA', lpad(column03, 2, '0')), 'XX') AS delinq_status
FROM perf_tape""",
    "hpi_standardise": "SELECT * FROM price_index",
    "polish_final": "SELECT * FROM final",
    "full_refresh": _numeric_profile("final", _FINAL_NUMBERS),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _ORACLES.items()}
