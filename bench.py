"""Benchmark: the layers over prepared tapes, then registered queries end to end. Prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Every entry is the median of
``BENCH_RUNS`` (default 3) runs after one warm-up. Results go to a no-op sink unless the step itself writes Parquet.
"""

from __future__ import annotations

import itertools
import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import queries, standins  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from tapelake.operators.canonical import unify_tapes  # noqa: E402
from tapelake.operators.polish import polish  # noqa: E402
from tapelake.operators.profile import categorical_profile, numeric_profile  # noqa: E402
from tapelake.operators.valuation import mark_to_market  # noqa: E402
from tapelake.plans import lakehouse  # noqa: E402
from tapelake.session import local_session, shared_folder  # noqa: E402
from tapelake.sources import archives, sinks, tapes  # noqa: E402

HEADLINE = (
    "mtm_enrich",
    "orig_perf_join",
    "negative_age",
    "net_loss",
    "parse_mmyyyy",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int, warmups: int) -> float:
    seconds = []
    for _ in range(warmups + runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[warmups:]), 3)


def layer_steps(spark, sf_dir: str) -> dict:
    """Each layer's own work, reading the previous layer from Parquet and writing Parquet."""
    root = shared_folder(spark, "bench")
    made = {
        "orig": standins.orig_tape(spark, sf_dir),
        "perf": standins.perf_tape(spark, sf_dir),
        "fnm": standins.fnm_tape(spark, sf_dir),
        "index": standins.raw_index(spark, sf_dir),
    }
    for name, df in made.items():
        df.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/raw/{name}")
    raw = {name: tapes.read_layer(spark, f"{root}/raw/{name}") for name in made}
    fre = lakehouse.write_fre_silver(spark, raw["orig"], raw["perf"], f"{root}/lake/silver/fre")
    lakehouse.write_fnm_silver(spark, raw["fnm"].withColumn("archive", F.concat(F.lit("tape"), F.col("column001").cast("long") % 8)), f"{root}/lake/silver/fnm")
    index = lakehouse.write_index(spark, raw["index"], f"{root}/lake/silver/index")
    gold = lakehouse.write_gold(spark, raw["fnm"], fre, f"{root}/gold")
    marked = lakehouse.write_marked(spark, gold, index, f"{root}/marked")
    final = lakehouse.write_final(spark, marked, f"{root}/final")

    queries._zipped_fre(spark, sf_dir, f"{root}/zips")
    runs = itertools.count()

    def ingest():
        """Archives to silver, into a new folder each time."""
        out = f"{root}/ingest-{next(runs)}"
        orig, perf, members = lakehouse.read_fre_archives(archives.archive_entries(spark, f"{root}/zips/zip"), f"{out}/bronze")
        lakehouse.write_fre_silver(spark, orig, perf, f"{out}/silver", lakehouse.member_quarters(members))

    lake = lakehouse.Lake(spark, f"{root}/lake")
    lake.update()
    one = raw["fnm"].where(F.col("column001").cast("long") % 8 == 3).withColumn("archive", F.lit("tape3"))

    def load_one_archive():
        """One archive of eight is loaded again: silver, gold, marked, final and the profile of that part."""
        lakehouse.write_fnm_silver(spark, one, f"{root}/lake/silver/fnm")
        lake.update()
        consume(lake.numeric_profile())

    quarters = raw["perf"].select("quarter").distinct()

    def written(df, name, *options):
        return lambda: sinks.write_layer(df, f"{root}/out/{name}", *options)

    return {
        "ingest_archives": ingest,
        "layer_fre_silver": written(lakehouse.fre_silver(raw["orig"], raw["perf"], quarters), "fre", sinks.SNAPPY),
        "layer_gold": written(unify_tapes(raw["fnm"], fre), "gold"),
        "layer_marked": lambda: sinks.write_layer(mark_to_market(gold, index), f"{root}/out/marked"),
        "layer_final": written(polish(marked), "final"),
        "layer_profile_numeric": lambda: consume(numeric_profile(final)),
        "layer_profile_categorical": lambda: consume(categorical_profile(final)),
        "load_one_archive": load_one_archive,
        "profile_of_states": lambda: consume(lake.numeric_profile()),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"))
    steps = layer_steps(spark, sf_dir)
    steps |= {name: lambda name=name: consume(QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    seconds = {}
    for name, step in steps.items():
        seconds[name] = timed(step, runs, warmups=1)
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
