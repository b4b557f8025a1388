"""House price index: monthly series per geography."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE, METRO = "State", "CBSA"


def standardise(raw: DataFrame) -> DataFrame:
    """Master file -> ``GEO_Type, GEO_Name, msa_code, hpi_date, index_nsa, index_sa``.

    Only metro rows get an ``msa_code`` (five digits, zero-padded). A month outside 1-12 gives a NULL date.
    """
    is_metro = F.col("GEO_Type") == METRO
    year, month = F.col("Year").cast("int"), F.col("Month").cast("int")
    return raw.select(
        "GEO_Type",
        "GEO_Name",
        F.when(is_metro, F.lpad(F.col("GEO_Code").cast("string"), 5, "0")).alias("msa_code"),
        F.when(month.between(1, 12), F.make_date(year, month, F.lit(1))).alias("hpi_date"),
        F.col("Index_NSA").cast("double").alias("index_nsa"),
        F.col("Index_SA").cast("double").alias("index_sa"),
    )


def level(index: DataFrame, geo_type: str) -> DataFrame:
    """Rows of one geography level."""
    return index.where(F.col("GEO_Type") == geo_type)


def duplicate_keys(index: DataFrame) -> DataFrame:
    """(level, geography, month) keys that occur more than once; each would multiply loan rows in a join."""
    geography = F.when(F.col("GEO_Type") == METRO, F.col("msa_code")).otherwise(F.col("GEO_Name"))
    return (
        index.where(F.col("GEO_Type").isin(STATE, METRO))
        .groupBy("GEO_Type", geography.alias("geography"), "hpi_date")
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )
