"""Loads that need nothing of each other run at the same time, and none is left running or unheard."""

import threading

import pytest

from tapelake.plans import incremental, lakehouse
from tapelake.session import side_by_side


def test_a_refresh_loads_both_agencies_and_the_index_at_once(spark, monkeypatch, tmp_path):
    met = threading.Barrier(3, timeout=30)

    def load(spark_, *_):
        met.wait()
        return spark_.range(1)

    class Lake:
        update = layer = lambda *_: "final"

    for name in ("load_fre", "load_fnm", "write_index"):
        monkeypatch.setattr(lakehouse, name, load)
    monkeypatch.setattr(lakehouse, "Lake", lambda *_: Lake())
    monkeypatch.setattr(lakehouse.archives, "archive_entries", lambda *_: None)
    monkeypatch.setattr(lakehouse.tapes, "read_index_csv", lambda *_: None)
    final, status = lakehouse.refresh_archives(spark, "fnm", "fre", "index", str(tmp_path))
    assert final == "final" and status.count() == 2


def test_results_keep_their_order_and_a_failure_waits_for_the_others(spark):
    assert side_by_side(spark, lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]
    ended = threading.Event()

    def fails():
        raise ValueError("no index")

    def lasts():
        spark.range(10).count()
        ended.set()

    with pytest.raises(ValueError, match="no index"):
        side_by_side(spark, fails, lasts)
    assert ended.is_set()


def test_small_tables_of_versions_need_no_python_worker(spark, tmp_path):
    assert incremental.versions(spark, str(tmp_path / "nothing")).collect() == []
    rows = incremental._table(spark, [("FNM", "a"), ("FRE", None)], "agency", "part")
    assert [tuple(r) for r in rows.collect()] == [("FNM", "a"), ("FRE", None)]
    assert "LocalTableScan" in rows._jdf.queryExecution().executedPlan().toString()
