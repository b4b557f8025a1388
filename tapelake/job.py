"""The whole lake as one job: ``spark-submit tapelake/job.py --fnm FOLDER --fre FOLDER --index CSV --lake FOLDER``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tapelake.plans import lakehouse
from tapelake.session import configure, discard

BLOCKS = ["totals", "numeric", "categorical", "negative_age"]


def run(spark: SparkSession, fnm: str, fre: str, index: str, lake: str) -> None:
    """Archives to profile; the status of the load and the four blocks of the profile are tables in the lake.

    Run again on new archives it rebuilds only what they touch. The numeric block is merged from the parts' states.
    """
    final, status = lakehouse.refresh_archives(spark, fnm, fre, index, lake)
    status.write.mode("overwrite").parquet(f"{lake}/status")
    totals, _, categorical, negative_age = lakehouse.profile(final)
    numeric = lakehouse.Lake(spark, lake).numeric_profile()
    for name, block in zip(BLOCKS, (totals, numeric, categorical, negative_age), strict=True):
        block.write.mode("overwrite").parquet(f"{lake}/profile/{name}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("fnm", "fre", "index", "lake"):
        parser.add_argument(f"--{name}", required=True)
    chosen = parser.parse_args(arguments)
    spark = configure(SparkSession.builder.appName("tapelake").getOrCreate())
    run(spark, chosen.fnm, chosen.fre, chosen.index, chosen.lake)
    discard(spark)


if __name__ == "__main__":
    main()
