"""Tape -> canonical table, and the union of the two agencies. Map-only: no shuffle."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.casts import code_to_date
from tapelake.operators.contract import COLUMNS, DATE, FNM, FRE, check_contract
from tapelake.operators.rules import finish


@lru_cache(maxsize=8)
def _columns(agency: str, application: str) -> tuple[list[Column], list[Column]]:
    """The two selects of :func:`canonical`. Building some thousand expressions takes seconds, so it is done once."""
    typed = [c.rule(agency)().alias(c.name) for c in COLUMNS]
    finished = [finish(c.name, c.type == DATE, c.placeholders).alias(c.name) for c in COLUMNS]
    return [F.lit(agency).alias("agency"), *typed], [F.col("agency"), *finished]


def prepare(spark: SparkSession) -> None:
    """Build the expressions of both agencies now, for example while tapes are loaded."""
    for agency in (FNM, FRE):
        _columns(agency, spark.sparkContext.applicationId)


def canonical(tape: DataFrame, agency: str, keep: tuple[str, ...] = (), observation: Observation | None = None) -> DataFrame:
    """Read one agency's positional columns into the canonical table: cast and map first, then scrub placeholders.

    Two selects on purpose: the scrub tests each value and returns it, and Catalyst keeps a projection whose result
    is used twice apart, so the cast itself runs once per value and the generated code stays small. ``keep``: columns of the tape that follow the table's as they are.
    ``observation`` counts, in the pass that uses the rows, the rows and the texts that each cast could not read (:func:`cast_failures`).
    """
    typed, finished = _columns(agency, tape.sparkSession.sparkContext.applicationId)
    if observation is None:
        return tape.select(*typed, *keep).select(*finished, *keep)
    read = {c.name: c.rule(agency).source for c in COLUMNS if hasattr(c.rule(agency), "source")}
    raw = {name: f"raw {source}" for name, source in read.items()}
    both = tape.select(*typed, *keep, *[F.col(source).alias(f"raw {source}") for source in sorted(set(read.values()))])
    is_date = {c.name for c in COLUMNS if c.type == DATE}

    def failed(name: str) -> Column:
        value = code_to_date(F.col(name)) if name in is_date else F.col(name)
        return F.count_if(value.isNull() & (F.trim(F.col(f"`{raw[name]}`")) != ""))

    counted = both.observe(observation, F.count(F.lit(1)).alias("rows"), *[failed(name).alias(name) for name in read])
    return counted.select(*finished, *keep)


def cast_failures(observation: Observation) -> dict[str, int]:
    """Column -> non-empty texts that became NULL, once the rows have been used; columns without any are left out."""
    return {name: n for name, n in observation.get.items() if name != "rows" and n}


def unify(fnm: DataFrame, fre: DataFrame) -> DataFrame:
    """All rows of both canonical tables, after checking each against the contract."""
    return check_contract(fnm).unionByName(check_contract(fre))


def unify_tapes(fnm_tape: DataFrame, fre_tape: DataFrame) -> DataFrame:
    return unify(canonical(fnm_tape, FNM), canonical(fre_tape, FRE))
