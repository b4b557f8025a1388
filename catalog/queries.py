"""One query per operator, over whole tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from catalog import files, standins
from tapelake.functions import casts, clean
from tapelake.operators import contract, price_index, profile, valuation
from tapelake.operators.canonical import canonical, unify, unify_tapes
from tapelake.operators.contract import FNM, FRE
from tapelake.operators.exact_quantiles import exact_quantiles
from tapelake.operators.polish import polish
from tapelake.operators.tape_join import join_performance, suffixed
from tapelake.plans import lakehouse
from tapelake.session import configure, shared_folder, side_by_side
from tapelake.sources import archives, sinks, tapes, tapezip
from tapelake.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QUARTILES = (0.25, 0.5, 0.75)


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# ---- inputs shared by the queries


def fre_silver(spark, sf_dir, **travel):
    return lakehouse.fre_silver(standins.orig_tape(spark, sf_dir), standins.perf_tape(spark, sf_dir), **travel)


def gold(spark, sf_dir, **travel):
    return unify_tapes(standins.fnm_tape(spark, sf_dir), fre_silver(spark, sf_dir, **travel))


def index(spark, sf_dir):
    return price_index.standardise(standins.raw_index(spark, sf_dir))


def marked(spark, sf_dir, **travel):
    return valuation.mark_to_market(gold(spark, sf_dir, **travel), index(spark, sf_dir))


def final(spark, sf_dir, **travel):
    return polish(marked(spark, sf_dir, **travel))


def fnm_raw(spark, sf_dir, *fields):
    return standins.fnm_tape(spark, sf_dir).select(F.col("column001").alias("loan_id"), *fields)


def orig_raw(spark, sf_dir, *fields):
    return standins.orig_tape(spark, sf_dir).select(F.col("column19").alias("loan_id"), *fields)


def perf_raw(spark, sf_dir, *fields):
    return standins.perf_tape(spark, sf_dir).select(F.col("column00").alias("loan_id"), *fields)


def exact_profile(df):
    rows = profile.numeric_profile(df, quartiles=False)
    rounded = [casts.round_half_away(F.col("mean_value"), 6).alias("mean_value")]
    return rows.select("column_name", "null_count", "min_value", "max_value", *rounded)


# ---- sources


@query
def src_pipe_text(spark, sf_dir):
    path = shared_folder(spark, "pipe-text")
    files.write_text(standins.fnm_tape(spark, sf_dir), tapes.FNM_FIELDS, path, packed=True)
    read = tapes.read_tape(spark, path)
    return read.select(*tapes.FNM_FIELDS)


@query
def src_typed_csv(spark, sf_dir):
    path = shared_folder(spark, "index-csv")
    standins.raw_index(spark, sf_dir).write.csv(path, header=True)
    return tapes.read_index_csv(spark, path)


@query
def src_parquet(spark, sf_dir):
    return tapes.read_layer(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def src_parquet_glob(spark, sf_dir):
    root = shared_folder(spark, "glob")
    silver = standins.perf_tape(spark, sf_dir).select("quarter", "column00", "column01", "column02")
    for flag in ("2005Q*", "2006Q*"):
        year = flag[:4]
        sinks.write_layer(silver.where(F.col("quarter").startswith(year)), f"{root}/vintage_{year}.parquet", sinks.SNAPPY)
    sinks.write_layer(silver.where(~F.substring("quarter", 1, 4).isin("2005", "2006")), f"{root}/vintage_later.parquet", sinks.SNAPPY)
    return tapes.read_layer(spark, f"{root}/vintage_*.parquet")


def _perf_files(spark, sf_dir, root, packed=False):
    name = F.concat(F.lit("historical_data_time_"), F.col("quarter"), F.lit(".txt"))
    files.write_text(standins.perf_tape(spark, sf_dir), tapes.FRE_FIELDS, root, name, packed)
    return root


@query
def src_zip_members(spark, sf_dir):
    """Origination and performance files of a year in one nested zip per archive."""
    orig, perf, _ = _zipped_fre(spark, sf_dir, shared_folder(spark, "zips"))
    named = orig.select(F.lit("origination").alias("kind"), "quarter", *tapes.FRE_FIELDS)
    return named.unionByName(perf.select(F.lit("performance").alias("kind"), "quarter", *tapes.FRE_FIELDS))


@query
def src_zip_single_file(spark, sf_dir):
    """Single-file tapes, a nested zip per part."""
    root = shared_folder(spark, "zips-fnm")
    return _zipped_fnm(spark, standins.fnm_tape(spark, sf_dir), root)[0].select(*tapes.FNM_FIELDS)


@query
def src_zip_split(spark, sf_dir):
    """One member in a nested zip that is deflated itself: inflated to lines by one task, parsed by as many as there are chunks."""
    root = shared_folder(spark, "split")
    files.zip_parts(spark, _text(standins.fnm_tape(spark, sf_dir), f"{root}/text"), f"{root}/zip", F.lit("whole"), deflated=True, used_up=True)
    entries = archives.archive_entries(spark, f"{root}/zip")
    bronze = archives.write_bronze(entries, f"{root}/bronze", tapes.FNM_WIDTH, r"\.csv$", chunk_lines=10_000)
    rows = archives.rows_of(bronze, archives.outcomes(bronze))
    return rows.select("source", "entry", "member", *tapes.FNM_FIELDS)


@query
def src_zip_source(spark, sf_dir):
    """The archives' data source, with a filter on kind and quarter that chooses what is opened."""
    root = shared_folder(spark, "tapezip")
    _perf_files(spark, sf_dir, f"{root}/text", packed=True)
    files.zip_parts(spark, f"{root}/text", f"{root}/zip", F.regexp_extract("member", "_(2[0-9]{3})Q", 1), used_up=True)
    table = tapezip.read_zipped(spark, f"{root}/zip", tapes.FRE_WIDTH, vintages=True)
    wanted = table.where("kind = 'performance' AND quarter IN ('2005Q1', '2006Q2')")
    return wanted.select("source", "quarter", *tapes.FRE_FIELDS)


@query
def stream_archives(spark, sf_dir):
    """Archives that arrive as a stream, batch by batch, into the lake."""
    root = shared_folder(spark, "arriving")
    tape = standins.fnm_tape(spark, sf_dir)

    def zipped(k):
        files.zip_parts(spark, _text(tape.where(F.col("column001") % 3 == k), f"{root}/text{k}"), f"{root}/zip", F.lit(f"part{k}"), used_up=True)

    side_by_side(spark, *[partial(zipped, k) for k in range(3)])
    lakehouse.write_index(spark, standins.raw_index(spark, sf_dir), f"{root}/lake/silver/index")
    arrivals.load_archives(arrivals.archive_arrivals(spark, f"{root}/zip", 2), "fnm", f"{root}/lake", f"{root}/checkpoint").awaitTermination()
    return lakehouse.Lake(spark, f"{root}/lake").layer("gold/final")


@query
def ingest_second_archive(spark, sf_dir):
    """An archive is loaded after another, then the first once more: both are there, once."""
    root = shared_folder(spark, "second")
    tape = standins.fnm_tape(spark, sf_dir)
    early = F.col("column001") % 2 == 0

    def zipped(name, rows):
        files.zip_parts(spark, _text(rows, f"{root}/{name}/text"), f"{root}/{name}/zip", F.lit(name), used_up=True)

    side_by_side(spark, lambda: zipped("first", tape.where(early)), lambda: zipped("second", tape.where(~early)))
    for name in ("first", "second", "first"):
        rows, _ = lakehouse.read_fnm_archives(archives.archive_entries(spark, f"{root}/{name}/zip"), f"{root}/bronze")
        silver = lakehouse.write_fnm_silver(spark, rows, f"{root}/silver")
    return silver.select("agency", F.col("archive").cast("string").alias("archive"), *tapes.FNM_FIELDS)


@query
def ingest_duplicate_vintage(spark, sf_dir):
    """Every quarter comes in two archives: each is loaded from one, the other is reported."""
    root = shared_folder(spark, "twice")
    orig, perf, members = _zipped_fre(spark, sf_dir, root, copies=("a", "b"))
    silver = lakehouse.write_fre_silver(spark, orig, perf, f"{root}/silver", lakehouse.member_quarters(members))
    status = lakehouse.ingest_status(orig, silver, members)
    return status.groupBy("status").agg(F.count("*").alias("sources"), F.sum("row_count").alias("row_count"))


def _text(tape, path):
    files.write_text(tape, tapes.FNM_FIELDS, f"{path}/file=tape.csv", packed=True)
    return path


def _fre_archives(spark, sf_dir, root, copies=("a",)):
    """Both kinds of files in an archive per year, once for each name in ``copies``, under ``zip``."""
    _perf_files(spark, sf_dir, f"{root}/text/perf", packed=True)
    name = F.concat(F.lit("historical_data_"), F.col("quarter"), F.lit(".txt"))
    files.write_text(standins.orig_tape(spark, sf_dir), tapes.FRE_FIELDS, f"{root}/text/orig", name, packed=True)
    year = F.regexp_extract("member", "_(2[0-9]{3})Q", 1)
    for copy in copies:
        files.zip_parts(spark, f"{root}/text", f"{root}/zip", F.concat(year, F.lit(copy)), used_up=copy == copies[-1])


def _zipped_fre(spark, sf_dir, root, copies=("a",)):
    """The archives' rows and members, read back."""
    _fre_archives(spark, sf_dir, root, copies)
    return lakehouse.read_fre_archives(archives.archive_entries(spark, f"{root}/zip"), f"{root}/bronze")


def _fnm_archives(spark, tape, root):
    files.write_text(tape, tapes.FNM_FIELDS, f"{root}/text", packed=True)
    files.zip_parts(spark, f"{root}/text", f"{root}/zip", used_up=True)


def _zipped_fnm(spark, tape, root):
    _fnm_archives(spark, tape, root)
    return lakehouse.read_fnm_archives(archives.archive_entries(spark, f"{root}/zip"), f"{root}/bronze")


@query
def src_quarter_from_path(spark, sf_dir):
    root = _perf_files(spark, sf_dir, shared_folder(spark, "quarter-files"))
    tape = tapes.with_quarter(tapes.read_tape(spark, f"{root}/file={tapes.PERF_FILES}", tapes.FRE_WIDTH))
    return tape.groupBy("quarter").agg(F.count("*").alias("row_count"), F.count("column25").alias("valuations"))


def _ship_quarters(spark, sf_dir):
    """Reporting quarters: one more than there are origination quarters."""
    month = F.col("column01")
    quarter = F.concat(
        (F.left(month, F.lit(4)).cast("int") + 10).cast("string"),
        F.lit("Q"),
        F.ceil(F.right(month, F.lit(2)).cast("int") / 3).cast("string"),
    )
    return standins.perf_tape(spark, sf_dir).select(quarter.alias("quarter"), "column00", "column01")


@query
def manifest_orphans(spark, sf_dir):
    root = shared_folder(spark, "manifest")
    name = F.concat(F.lit("historical_data_"), F.col("quarter"), F.lit(".txt"))
    files.write_text(_ship_quarters(spark, sf_dir), ["column00", "column01"], f"{root}/orig", name)
    _perf_files(spark, sf_dir, f"{root}/perf")

    def quarters(folder):
        return tapes.list_files(spark, folder).select(tapes.quarter_of_path(F.col("path")).alias("quarter"))

    return tapes.orphan_quarters(quarters(f"{root}/orig"), quarters(f"{root}/perf"))


@query
def ingest_status(spark, sf_dir):
    root = shared_folder(spark, "status")
    files.zip_parts(spark, _perf_files(spark, sf_dir, f"{root}/text", packed=True), f"{root}/zip", used_up=True)
    files.write_bytes(f"{root}/zip/damaged.zip", b"this is no archive\n" * 100)
    files.write_zip(f"{root}/zip/latin.zip", "historical_data_time_2099Q1.txt", b"1|caf\xe9|\n")
    _, perf, members = lakehouse.read_fre_archives(archives.archive_entries(spark, f"{root}/zip"), f"{root}/bronze")
    quarters = lakehouse.member_quarters(members)
    silver = lakehouse.write_fre_silver(spark, standins.orig_tape(spark, sf_dir), perf, f"{root}/silver", quarters)
    files.zip_parts(spark, _text(standins.fnm_tape(spark, sf_dir), f"{root}/fnm/text"), f"{root}/fnm/zip", F.lit("whole"), used_up=True)
    files.write_zip(f"{root}/fnm/zip/latin.zip", "tape.csv", b"1|caf\xe9|\n")
    _, single = lakehouse.read_fnm_archives(archives.archive_entries(spark, f"{root}/fnm/zip"), f"{root}/fnm/bronze")
    status = lakehouse.ingest_status(_ship_quarters(spark, sf_dir), silver, members).unionByName(lakehouse.fnm_status(single))
    return status.withColumn("error", F.substring_index("error", ":", 1))


@query
def dataset_footprint(spark, sf_dir):
    """Size of the performance tape as text files."""
    path = shared_folder(spark, "footprint")
    files.write_text(standins.perf_tape(spark, sf_dir), tapes.FRE_FIELDS, path)
    return tapes.footprint(spark, path).select("bytes")


@query
def describe_schema(spark, sf_dir):
    return profile.describe(final(spark, sf_dir, packed=True))


# ---- sinks


@query
def sink_roundtrip_snappy(spark, sf_dir):
    path = shared_folder(spark, "snappy")
    sinks.write_layer(fre_silver(spark, sf_dir, packed=True, by_quarter=True), path, sinks.SNAPPY, ("agency", "quarter"))
    performance = [f"column{i:02d}_1" for i in (*range(6), *range(7, 17), 21, 22, 25, 26, 27, 29, 30, 31)]
    return tapes.read_layer(spark, path).select("agency", "quarter", "column00", "column19", *performance)


@query
def sink_roundtrip_zstd(spark, sf_dir):
    path = shared_folder(spark, "zstd")
    sinks.write_layer(canonical(standins.fnm_tape(spark, sf_dir), FNM), path, sinks.ZSTD, max_records_per_file=1_000_000)
    return tapes.read_layer(spark, path)


@query
def sink_overwrite_partition(spark, sf_dir):
    path = shared_folder(spark, "overwrite")
    loans = standins.orig_tape(spark, sf_dir).select("quarter", "column19", F.lit("first load").alias("load"))
    sinks.write_layer(loans, path, sinks.SNAPPY, ("quarter",), rebalance=True)
    again = loans.where("quarter = '2005Q1'").withColumn("load", F.lit("reload"))
    sinks.write_layer(again, path, sinks.SNAPPY, ("quarter",))
    return tapes.read_layer(spark, path).select("column19", "load", F.col("quarter").cast("string").alias("quarter"))


@query
def view_sql(spark, sf_dir):
    gold(spark, sf_dir).createOrReplaceTempView("tapelake_gold")
    return spark.sql(
        "SELECT agency, prop_state, count(*) AS row_count, max(current_upb) AS max_upb FROM tapelake_gold GROUP BY agency, prop_state"
    )


# ---- projections


@query
def proj_literal(spark, sf_dir):
    return lakehouse.fnm_silver(standins.fnm_tape(spark, sf_dir)).select("agency", "column001", "column002")


@query
def proj_star_dedup(spark, sf_dir):
    return suffixed(standins.perf_tape(spark, sf_dir)).select("quarter", "column00_1", "column01_1", "column03_1", "column25_1")


@query
def canonical_fnm(spark, sf_dir):
    return canonical(standins.fnm_tape(spark, sf_dir), FNM)


@query
def canonical_fre(spark, sf_dir):
    return canonical(fre_silver(spark, sf_dir, packed=True), FRE)


@query
def unify_agencies(spark, sf_dir):
    return gold(spark, sf_dir, packed=True)


@query
def month_keys(spark, sf_dir):
    keyed = valuation.with_month_keys(gold(spark, sf_dir))
    return keyed.select("agency", "loan_id", "first_pay_date", "report_period", "j_orig_dt", "j_now_dt")


@query
def month_of_timestamp(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", casts.month_of(F.col("o_orderdate")).alias("month"))


@query
def lateral_alias(spark, sf_dir):
    typed = canonical(standins.fnm_tape(spark, sf_dir), FNM)
    share = (F.col("current_upb") / F.col("orig_upb")).alias("upb_share")
    return typed.select("loan_id", share, F.coalesce("eltv", "upb_share").alias("eltv_or_share"))


@query
def typed_projection(spark, sf_dir):
    x = F.col
    return fnm_raw(
        spark,
        sf_dir,
        casts.mmyyyy_to_date(x("column018")).alias("maturity_date"),
        casts.try_int(x("column012")).alias("orig_term"),
        casts.try_double(x("column008")).alias("current_rate"),
        x("column039").cast("string").alias("delinq_status"),
    )


@query
def schema_contract(spark, sf_dir):
    both = unify(canonical(standins.fnm_tape(spark, sf_dir), FNM), canonical(fre_silver(spark, sf_dir, packed=True), FRE))
    return profile.describe(contract.check_contract(both)).select("ordinal", "column_name", "values")


# ---- filters


@query
def filter_geo_level(spark, sf_dir):
    return price_index.level(index(spark, sf_dir), price_index.METRO)


@query
def filter_age_valid(spark, sf_dir):
    return gold(spark, sf_dir).where("loan_age >= 1").select("agency", "loan_id", "report_period", "loan_age")


@query
def filter_ilike(spark, sf_dir):
    buyers = gold(spark, sf_dir).where(F.col("first_time_buyer").ilike("y"))
    return buyers.select("agency", "loan_id", "first_time_buyer")


@query
def negative_age(spark, sf_dir):
    return profile.share_where(gold(spark, sf_dir), F.col("loan_age") < 0)


# ---- joins


@query
def orig_perf_join(spark, sf_dir):
    joined = join_performance(standins.orig_tape(spark, sf_dir), standins.perf_tape(spark, sf_dir))
    return joined.select("quarter", "column19", "column00", "column10", "column00_1", "column01_1", "column02_1")


def _with_index(spark, sf_dir, level):
    keyed = valuation.with_month_keys(gold(spark, sf_dir))
    return valuation.with_index(keyed, index(spark, sf_dir), level)


@query
def hpi_join_state(spark, sf_dir):
    joined = _with_index(spark, sf_dir, price_index.STATE)
    return joined.select("agency", "loan_id", "prop_state", "j_orig_dt", "j_now_dt", "state_index_orig", "state_index_now")


@query
def hpi_join_msa(spark, sf_dir):
    joined = _with_index(spark, sf_dir, price_index.METRO)
    return joined.select("agency", "loan_id", "msa_code", "j_orig_dt", "j_now_dt", "msa_index_orig", "msa_index_now")


@query
def hpi_ratio_fallback(spark, sf_dir):
    prices, keyed = index(spark, sf_dir), valuation.with_month_keys(gold(spark, sf_dir))
    joined = valuation.with_index(valuation.with_index(keyed, prices, price_index.STATE), prices, price_index.METRO)
    return joined.select("agency", "loan_id", "report_period", valuation.index_ratio().alias("ratio"))


@query
def mtm_enrich(spark, sf_dir):
    return marked(spark, sf_dir, packed=True)


@query
def final_ltv(spark, sf_dir):
    return marked(spark, sf_dir).select("agency", "loan_id", "eltv", "mtm_cltv", "final_cltv")


@query
def index_duplicates(spark, sf_dir):
    twice = index(spark, sf_dir)
    return price_index.duplicate_keys(twice.unionAll(twice.where(F.col("GEO_Type") == price_index.METRO)))


# ---- aggregates and profile


@query
def row_count(spark, sf_dir):
    return gold(spark, sf_dir).agg(F.count("*").alias("row_count"))


@query
def count_by_agency(spark, sf_dir):
    return gold(spark, sf_dir).groupBy("agency").agg(F.count("*").alias("row_count"))


@query
def count_by_geo_type(spark, sf_dir):
    return index(spark, sf_dir).groupBy("GEO_Type").agg(F.count("*").alias("row_count"))


@query
def verify_by_agency(spark, sf_dir):
    return profile.mean_by(marked(spark, sf_dir), "agency", "final_cltv")


@query
def profile_numeric(spark, sf_dir):
    return exact_profile(final(spark, sf_dir))


@query
def profile_quantiles_approx(spark, sf_dir):
    """Whether each approximate quartile of the final table has the rank that the sketch promises."""
    return _within(spark, sf_dir, lambda table: profile.numeric_profile(table), 0.01)


@query
def profile_quantiles_percentile(spark, sf_dir):
    return _within(spark, sf_dir, lambda table: profile.quartiles_percentile_approx(table), 0.001)


def _within(spark, sf_dir, quartiles, error):
    """column_name, quartile, within: a column's rank of its quartile, over all rows, is off by no more than ``error``."""
    path = shared_folder(spark, "within")
    sinks.write_layer(final(spark, sf_dir, packed=True), path)
    table = tapes.read_layer(spark, path)
    columns = profile.numeric_columns(table)
    found = quartiles(table).select("column_name", *profile.QUARTILES)
    values = table.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    ranks = values.join(F.broadcast(found), "column_name").groupBy("column_name").agg(
        F.count("value").alias("n"), *[F.count_if(F.col("value") < F.col(q)).alias(f"below_{q}") for q in profile.QUARTILES], *[F.count_if(F.col("value") <= F.col(q)).alias(f"to_{q}") for q in profile.QUARTILES]
    )
    rows = [
        F.struct(F.lit(q).alias("quartile"), ((F.col("n") == 0) | ((F.col(f"below_{q}") <= (p + error) * F.col("n") + 1) & (F.col(f"to_{q}") >= (p - error) * F.col("n") - 1))).alias("within"))
        for q, p in profile.QUARTILES.items()
    ]
    return ranks.select("column_name", F.explode(F.array(*rows)).alias("r")).select("column_name", "r.*")


@query
def profile_quantiles_exact(spark, sf_dir):
    path = shared_folder(spark, "quantiles")
    table = final(spark, sf_dir)
    columns = profile.numeric_columns(table)
    sinks.write_layer(table.select(*columns), path)
    found = exact_quantiles(tapes.read_layer(spark, path), columns, QUARTILES)
    return found.withColumn("value", casts.round_half_away(F.col("value"), 6))


@query
def profile_categorical(spark, sf_dir):
    return profile.categorical_profile(final(spark, sf_dir))


@query
def topk_values(spark, sf_dir):
    return profile.top_values(gold(spark, sf_dir), "prop_state")


@query
def group_by_ordinal(spark, sf_dir):
    return spark.sql(
        "SELECT zero_bal_code AS code, count(*) AS freq FROM {gold} GROUP BY 1 ORDER BY 2 DESC", gold=gold(spark, sf_dir)
    )


@query
def agency_split(spark, sf_dir):
    return profile.value_shares(gold(spark, sf_dir), "agency")


@query
def null_density_gain(spark, sf_dir):
    return profile.null_density(marked(spark, sf_dir), ["eltv", "final_cltv"])


@query
def profile_compare(spark, sf_dir):
    table = marked(spark, sf_dir)
    compared = profile.compare_profiles(exact_profile(table), exact_profile(polish(table)))
    figures = [casts.round_half_away(F.col(c), 4).alias(c) for c in ("expected", "actual")]
    return compared.select("column_name", "metric", *figures, "status")


# ---- scalar functions and cleaning rules


@query
def try_cast_double(spark, sf_dir):
    return fnm_raw(spark, sf_dir, F.col("column008").alias("raw"), casts.try_double(F.col("column008")).alias("value"))


@query
def try_cast_int(spark, sf_dir):
    values = {c: casts.try_int(F.col(c)).alias(f"{c}_int") for c in ("column012", "column015", "column017", "column023")}
    return fnm_raw(spark, sf_dir, *values.values())


@query
def cast_string(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", F.col("l_orderkey").cast("string").alias("key_text"), F.col("l_linenumber").cast("string").alias("line_text"))


@query
def offset_plus_one(spark, sf_dir):
    return orig_raw(spark, sf_dir, clean.one_more(F.col("column21")).alias("orig_term")).unionByName(
        perf_raw(spark, sf_dir, clean.one_more(F.col("column04")).alias("orig_term"))
    )


@query
def parse_yyyymm(spark, sf_dir):
    return orig_raw(
        spark,
        sf_dir,
        casts.yyyymm_to_date(F.col("column01")).alias("first_pay_date"),
        casts.yyyymm_to_date(F.col("column03")).alias("maturity_date"),
        casts.yyyymm_to_date(F.concat("column01", F.lit("99"))).alias("cut_to_six"),
    )


@query
def parse_mmyyyy(spark, sf_dir):
    dates = {"column002": "report_period", "column018": "maturity_date", "column050": "ddlpi"}
    return fnm_raw(spark, sf_dir, *[casts.mmyyyy_to_date(F.col(c)).alias(name) for c, name in dates.items()])


@query
def str_left_right(spark, sf_dir):
    month = F.col("column014")
    return fnm_raw(spark, sf_dir, F.right(month, F.lit(4)).alias("year"), F.left(month, F.lit(2)).alias("month"))


@query
def build_month_date(spark, sf_dir):
    return index(spark, sf_dir).select("GEO_Type", "GEO_Name", "hpi_date")


@query
def str_lpad(spark, sf_dir):
    return perf_raw(spark, sf_dir, F.col("column03").alias("raw"), F.lpad("column03", 2, "0").alias("padded"))


@query
def str_upper(spark, sf_dir):
    return fnm_raw(spark, sf_dir, F.upper("column004").alias("seller_name"), F.upper("column005").alias("servicer_name"))


@query
def null_safe_sum(spark, sf_dir):
    parts = [F.col(c) for c in contract.EXPENSES_FNM]
    return fnm_raw(spark, sf_dir, clean.null_safe_sum(parts).alias("total_expenses"))


@query
def net_loss(spark, sf_dir):
    x = F.col
    expenses, credits = [x(c) for c in contract.EXPENSES_FNM], [x(c) for c in contract.CREDITS_FNM]
    loss = clean.net_loss(x("column045"), x("column058"), x("column083"), expenses, credits)
    return fnm_raw(spark, sf_dir, loss.alias("net_loss"))


@query
def nullif_code(spark, sf_dir):
    return orig_raw(spark, sf_dir, F.nullif(F.col("column04"), F.lit("00000")).alias("msa_code"))


@query
def code_map(spark, sf_dir):
    return perf_raw(
        spark, sf_dir, F.col("column08").alias("code"), clean.code_map(F.col("column08"), contract.ZERO_BALANCE_FRE).alias("reason")
    )


@query
def code_map_passthrough(spark, sf_dir):
    return orig_raw(
        spark,
        sf_dir,
        clean.code_map(F.col("column29"), contract.VALUATION_FRE, clean.PASS).alias("valuation_method"),
        clean.code_map(F.col("column20"), contract.PURPOSE_FRE, clean.PASS).alias("loan_purpose"),
    )


@query
def code_map_default(spark, sf_dir):
    return perf_raw(spark, sf_dir, clean.code_map(F.col("column07"), contract.MODIFIED_FRE, "N").alias("mod_flag"))


@query
def round2(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    net = lines.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    return net.withColumn("net", casts.round_half_away(F.col("net"), 2))


@query
def sentinel_null(spark, sf_dir):
    score = casts.try_int(F.col("column00"))
    return orig_raw(spark, sf_dir, clean.sentinel_to_null(score, (9999,)).alias("credit_score"))


@query
def sentinel_multi(spark, sf_dir):
    rate = casts.try_double(F.col("column12"))
    return orig_raw(
        spark,
        sf_dir,
        clean.sentinel_to_null(rate, (0.0, 999.0)).alias("orig_int_rate"),
        clean.sentinel_to_null(F.col("column07"), ("9", "U")).alias("occupancy_status"),
    )


@query
def flag_normalise(spark, sf_dir):
    return orig_raw(spark, sf_dir, F.col("column25").alias("raw"), clean.blank_to_no(F.col("column25")).alias("flag"))


@query
def delinq_pad(spark, sf_dir):
    padded = clean.delinquency_code(F.col("column03"))
    return perf_raw(spark, sf_dir, F.col("column03").alias("raw"), clean.sentinel_to_null(padded, ("XX",)).alias("delinq_status"))


@query
def hpi_standardise(spark, sf_dir):
    return index(spark, sf_dir)


@query
def polish_final(spark, sf_dir):
    return final(spark, sf_dir, packed=True)


@query
def full_refresh(spark, sf_dir):
    """Every layer written and read back, from archives and the index file to the numeric profile."""
    root = shared_folder(spark, "refresh")
    side_by_side(
        spark,
        lambda: _fre_archives(spark, sf_dir, f"{root}/fre"),
        lambda: _fnm_archives(spark, standins.fnm_tape(spark, sf_dir), f"{root}/fnm"),
        lambda: standins.raw_index(spark, sf_dir).write.csv(f"{root}/index", header=True),
    )
    built, _ = lakehouse.refresh_archives(spark, f"{root}/fnm/zip", f"{root}/fre/zip", f"{root}/index", f"{root}/lake")
    return exact_profile(built)


_LAKES: dict = {}


def _incremental(spark, sf_dir):
    """A lake that two loads came to: all but one archive, then that archive alone. Built once per application and data set."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _LAKES:
        _LAKES[key] = _two_loads(spark, sf_dir, shared_folder(spark, "incremental"))
    root, done = _LAKES[key]
    return lakehouse.Lake(spark, root), done


def _two_loads(spark, sf_dir, root):
    tape, late = standins.fnm_tape(spark, sf_dir), F.col("column001") % 2 == 1

    def zipped(name, rows):
        files.zip_parts(spark, _text(rows, f"{root}/{name}/text"), f"{root}/{name}/zip", F.lit(name), used_up=True)

    side_by_side(
        spark,
        lambda: zipped("early", tape.where(~late)),
        lambda: zipped("late", tape.where(late)),
        lambda: _fre_archives(spark, sf_dir, f"{root}/fre"),
        lambda: standins.raw_index(spark, sf_dir).write.csv(f"{root}/index", header=True),
    )
    lakehouse.refresh_archives(spark, f"{root}/early/zip", f"{root}/fre/zip", f"{root}/index", f"{root}/lake")
    lake = lakehouse.Lake(spark, f"{root}/lake")
    lakehouse.load_fnm(spark, archives.archive_entries(spark, f"{root}/late/zip"), f"{root}/lake")
    return lake.root, lake.update()


@query
def refresh_incremental(spark, sf_dir):
    """The final table's parts after a second load, and whether that load replaced them."""
    lake, done = _incremental(spark, sf_dir)
    replaced = [p for _, p in done["gold/final"].replaced]
    rows = lake._parts("gold/final").groupBy("agency", "part").agg(F.count("*").alias("row_count"), casts.round_half_away(F.avg("final_cltv"), 6).alias("mean_cltv"))
    return rows.withColumn("replaced", F.col("part").isin(replaced))


@query
def profile_from_states(spark, sf_dir):
    """The numeric profile merged from the states of the parts, of which a second load renewed one."""
    rows = _incremental(spark, sf_dir)[0].numeric_profile(quartiles=False)
    return rows.withColumn("mean_value", casts.round_half_away(F.col("mean_value"), 6))


@query
def cast_failures(spark, sf_dir):
    """Texts that a cast could not read, counted while gold was written."""
    root = shared_folder(spark, "observed")
    lakehouse.write_fnm_silver(spark, standins.fnm_tape(spark, sf_dir), f"{root}/silver/fnm")
    lakehouse.write_fre_silver(spark, standins.orig_tape(spark, sf_dir), standins.perf_tape(spark, sf_dir), f"{root}/silver/fre")
    lakehouse.write_index(spark, standins.raw_index(spark, sf_dir), f"{root}/silver/index")
    lake = lakehouse.Lake(spark, root)
    lake.update()
    return lake.cast_status()


@query
def profile_report(spark, sf_dir):
    """The short blocks of the profile: totals by agency and the loans of negative age."""
    totals, _, _, negative = lakehouse.profile(final(spark, sf_dir))
    figures = totals.select(F.concat(F.lit("rows "), "agency").alias("figure"), F.col("row_count").cast("double").alias("value"))
    return figures.unionByName(negative.select(F.lit("negative age pct").alias("figure"), F.col("pct").alias("value")))
