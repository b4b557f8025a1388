"""Raw tapes -> silver -> gold -> marked -> final -> profile, each layer written to Parquet and read back.

A layer on shared storage also cuts the lineage: after a lost executor, work restarts from the last layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.operators.canonical import prepare, unify_tapes
from tapelake.operators.lookup import small_side
from tapelake.operators.polish import polish
from tapelake.operators.price_index import duplicate_keys, standardise
from tapelake.operators.profile import categorical_profile, numeric_profile, share_where
from tapelake.operators.tape_join import join_performance, performing_loans
from tapelake.operators.valuation import mark_to_market
from tapelake.plans.incremental import Lake
from tapelake.session import shared_folder, side_by_side
from tapelake.sources import archives, tapes
from tapelake.sources.sinks import SNAPPY, ZSTD, write_layer

# Agency names in the silver layer.
FRE_SILVER, FNM_SILVER = "freddie", "fannie"
# The archive of a single-file tape that did not come in one.
UNPACKED = "none"


def fre_silver(orig: DataFrame, perf: DataFrame, perf_quarters: DataFrame | None = None, packed: bool = False, by_quarter: bool = False) -> DataFrame:
    """Joined pairs of the quarters that have both files, tagged with their agency.

    ``perf_quarters`` lists the quarters with a performance file; taken from file or member names it saves a pass over
    the performance rows. Without it the performing loans are written to the shared folder, and both the quarters and the
    loans without performance are told by them, in one pass. Fields past the layout are in ``beyond`` (origination) and
    ``beyond_1`` (performance). ``packed``, ``by_quarter``: how the rows travel (:func:`join_performance`).
    """
    performing = None
    if perf_quarters is None:
        path = shared_folder(perf.sparkSession, "performing-loans")
        performing_loans(perf).write.parquet(path)
        performing = perf_quarters = tapes.read_layer(perf.sparkSession, path)
    joined = join_performance(tapes.paired(_with_beyond(orig), perf_quarters), _with_beyond(perf), performing, packed, by_quarter)
    return joined.withColumn("agency", F.lit(FRE_SILVER))


def fnm_silver(tape: DataFrame) -> DataFrame:
    return _with_beyond(tape).withColumn("agency", F.lit(FNM_SILVER))


def _with_beyond(tape: DataFrame) -> DataFrame:
    """A tape that keeps the fields past its layout, so that all loads have the same columns."""
    return tape if "beyond" in tape.columns else tape.withColumn("beyond", F.lit(None).cast("array<string>"))


def read_fre_files(spark: SparkSession, folder: str, width: int = tapes.FRE_WIDTH) -> tuple[DataFrame, DataFrame]:
    """Unpacked origination and performance files under a folder, each with its quarter and ``beyond``."""
    orig = tapes.with_quarter(tapes.read_tape(spark, f"{folder}/{tapes.ORIG_FILES}", width))
    return orig, tapes.with_quarter(tapes.read_tape(spark, f"{folder}/{tapes.PERF_FILES}", width))


def read_fre_archives(entries: DataFrame, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Origination and performance rows of the archives' pairs, each with its quarter, and ``fre_members``.

    Every archive is read once, into a bronze table at ``path``. Rows end in ``beyond``, the fields past the layout.
    """
    bronze = archives.write_bronze(entries, path, tapes.FRE_WIDTH, tapes.QUARTER_PATTERN)
    members = fre_members(bronze)
    quarter = tapes.quarter_of_path(F.col("member"))

    def read(kind: str) -> DataFrame:
        rows = archives.rows_of(bronze, members.where((F.col("status") == "read") & (F.col("kind") == kind)))
        return rows.select(quarter.alias("quarter"), *tapes.FRE_FIELDS, "beyond")

    return read("origination"), read("performance"), members


def fre_members(bronze: DataFrame) -> DataFrame:
    """``archive, entry, member, rows, error, quarter, kind, status`` of the members of a bronze table.

    Of the undamaged members of one quarter and kind, one is ``read``: that of the archive whose name sorts last, so a later
    delivery replaces an earlier one. The others are ``superseded``; a member that could not be read is ``failed``.
    """
    found = archives.outcomes(bronze)
    kind = F.when(F.contains("member", F.lit("historical_data_time_")), "performance").when(F.col("member").isNotNull(), "origination")
    found = found.select("*", tapes.quarter_of_path(F.col("member")).alias("quarter"), kind.alias("kind"))
    last = Window.partitionBy("quarter", "kind", F.col("error").isNull()).orderBy(F.desc("archive"), F.desc("entry"), F.desc("member"))
    place = F.row_number().over(last)
    return found.select("*", F.when(F.col("error").isNotNull(), "failed").when(place == 1, "read").otherwise("superseded").alias("status"))


def read_fnm_archives(entries: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Every delimited member of the single-file archives, with its archive's name, and the outcome of each member.

    An archive with a member that failed is left out as a whole, so that what an earlier load has of it stays.
    """
    bronze = archives.write_bronze(entries, path, tapes.FNM_WIDTH, r"\.csv$")
    members = archives.outcomes(bronze)
    broken = members.where(F.col("error").isNotNull()).select("archive").distinct()
    whole = members.join(small_side(broken), "archive", "left_anti")
    return archives.rows_of(bronze, whole).select(archives.archive_name().alias("archive"), *tapes.FNM_FIELDS, "beyond"), members


def fnm_status(members: DataFrame) -> DataFrame:
    """``source, status, row_count, error``: one row per single-file archive."""
    error = F.max("error")
    return members.groupBy(archives.archive_name().alias("source")).agg(
        F.when(error.isNull(), "loaded").otherwise("failed").alias("status"),
        F.when(error.isNull(), F.sum("rows")).otherwise(F.lit(0)).alias("row_count"),
        error.alias("error"),
    )


def file_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """Quarters of the performance files under a folder."""
    files = tapes.list_files(spark, f"{folder}/{tapes.PERF_FILES}")
    return files.select(tapes.quarter_of_path(F.col("path")).alias("quarter"))


def member_quarters(members: DataFrame) -> DataFrame:
    """Quarters of the performance members that were read."""
    return members.where("status = 'read' AND kind = 'performance'").select("quarter")


def write_fre_silver(
    spark: SparkSession, orig: DataFrame, perf: DataFrame, path: str, perf_quarters: DataFrame | None = None
) -> DataFrame:
    silver = fre_silver(orig, perf, perf_quarters, packed=True, by_quarter=True)
    write_layer(silver, path, SNAPPY, ("agency", "quarter"))
    return tapes.read_parts(spark, path, silver.schema, ("agency", "quarter"))


def write_fnm_silver(spark: SparkSession, tape: DataFrame, path: str) -> DataFrame:
    """One partition per agency and archive: a load replaces the archives it brings and leaves all others.

    Rows lie together by archive in bronze, so tasks write what they read: no row, 110 fields wide, is shuffled.
    """
    if "archive" not in tape.columns:
        tape = tape.withColumn("archive", F.lit(UNPACKED))
    silver = fnm_silver(tape)
    write_layer(silver, path, SNAPPY, ("agency", "archive"))
    return tapes.read_parts(spark, path, silver.schema, ("agency", "archive"))


def ingest_status(orig_quarters: DataFrame, silver: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """``source, status, row_count, error``: one row per quarter, and per member that failed or was superseded.

    A quarter is ``loaded``, or ``no performance file``.
    """
    loaded = silver.groupBy("quarter").agg(F.count("*").alias("row_count"))
    status = orig_quarters.select("quarter").distinct().join(loaded, "quarter", "left")
    rows = status.select(
        F.col("quarter").alias("source"),
        F.when(F.col("row_count").isNull(), "no performance file").otherwise("loaded").alias("status"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.lit(None).cast("string").alias("error"),
    )
    if members is None:
        return rows
    source = F.coalesce("member", "entry", archives.archive_name())
    other = members.where("status <> 'read'").select(source.alias("source"), "status", F.lit(0).cast("bigint").alias("row_count"), "error")
    return rows.unionByName(other)


def write_gold(spark: SparkSession, fnm: DataFrame, fre: DataFrame, path: str) -> DataFrame:
    write_layer(unify_tapes(fnm, fre), path, ZSTD)
    return tapes.read_layer(spark, path)


def write_index(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """The index layer; a (level, geography, month) that occurs twice would multiply loans, so it stops the load."""
    write_layer(standardise(raw), path, SNAPPY)
    index = tapes.read_layer(spark, path)
    if twice := duplicate_keys(index).orderBy("GEO_Type", "geography", "hpi_date").limit(5).collect():
        names = "; ".join(f"{r.GEO_Type} {r.geography} {r.hpi_date} ({r.copies} times)" for r in twice)
        raise ValueError(f"index keys that are not unique, among them: {names}")
    return index


def write_marked(spark: SparkSession, gold: DataFrame, index: DataFrame, path: str) -> DataFrame:
    write_layer(mark_to_market(gold, index), path, ZSTD)
    return tapes.read_layer(spark, path)


def write_final(spark: SparkSession, marked: DataFrame, path: str) -> DataFrame:
    write_layer(polish(marked), path, ZSTD)
    return tapes.read_layer(spark, path)


def refresh(
    spark: SparkSession, fnm_tape: DataFrame, orig: DataFrame, perf: DataFrame, raw_index: DataFrame, root: str, perf_quarters: DataFrame | None = None
) -> DataFrame:
    """Load tapes and index into silver under ``root``, bring all later layers up to date and return the final table."""
    write_fnm_silver(spark, fnm_tape, f"{root}/silver/fnm")
    write_fre_silver(spark, orig, perf, f"{root}/silver/fre", perf_quarters)
    write_index(spark, raw_index, f"{root}/silver/index")
    lake = Lake(spark, root)
    lake.update()
    return lake.layer("gold/final")


def load_fnm(spark: SparkSession, entries: DataFrame, root: str) -> DataFrame:
    """Single-file archives into bronze and silver; the status of each. Layers after silver are brought up to date by :class:`Lake`."""
    fnm, found = read_fnm_archives(entries, f"{root}/bronze/fnm")
    write_fnm_silver(spark, fnm, f"{root}/silver/fnm")
    return fnm_status(found)


def load_fre(spark: SparkSession, entries: DataFrame, root: str) -> DataFrame:
    """Archives of paired files into bronze and silver; the status of each quarter, and of each member that was not loaded."""
    orig, perf, found = read_fre_archives(entries, f"{root}/bronze/fre")
    silver = write_fre_silver(spark, orig, perf, f"{root}/silver/fre", member_quarters(found))
    return ingest_status(orig, silver, found)


def refresh_archives(spark: SparkSession, fnm_archives: str, fre_archives: str, index_csv: str, root: str) -> tuple[DataFrame, DataFrame]:
    """From folders of archives and the index file to the final table, and the status of every archive and quarter."""
    fre, fnm, _, _ = side_by_side(
        spark,
        lambda: load_fre(spark, archives.archive_entries(spark, fre_archives), root),
        lambda: load_fnm(spark, archives.archive_entries(spark, fnm_archives), root),
        lambda: write_index(spark, tapes.read_index_csv(spark, index_csv), f"{root}/silver/index"),
        lambda: prepare(spark),
    )
    lake = Lake(spark, root)
    lake.update()
    return lake.layer("gold/final"), fre.unionByName(fnm)


def profile(final: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four blocks of the final table's profile: totals, numeric columns, text columns, loans of negative age."""
    totals = final.groupBy("agency").agg(F.count("*").alias("row_count"))
    return totals, numeric_profile(final), categorical_profile(final), share_where(final, F.col("loan_age") < 0)
