"""Queries against their SQL at the smallest scale; all of them with ``CATALOG=all``."""

import os

import pytest

from catalog.check import compare, connect
from catalog.oracles import oracle_sql
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
QUICK = (
    "canonical_fnm",
    "canonical_fre",
    "mtm_enrich",
    "profile_numeric",
    "profile_categorical",
    "manifest_orphans",
    "sink_overwrite_partition",
    "round2",
    "net_loss",
    "parse_mmyyyy",
    "try_cast_int",
    "hpi_standardise",
    "src_zip_members",
    "ingest_second_archive",
    "ingest_duplicate_vintage",
    "ingest_status",
    "profile_quantiles_approx",
    "full_refresh",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES if os.environ.get("CATALOG") == "all" else QUICK)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None
