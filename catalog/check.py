"""Run queries next to their SQL: ``python -m catalog.check [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

from catalog.oracles import oracle_sql
from catalog.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else value
    if isinstance(value, datetime) and value.time() == datetime.min.time():
        return value.date()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if query and SQL give the same rows, else what differs. Collects both: for small test tables."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.toPandas().astype(object).where(lambda x: x.notna(), None).itertuples(index=False, name=None))
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows, SQL {sum(want.values())}; only Spark {sum(extra.values())}: "
        f"{[*extra][:2]}; only SQL {sum(missing.values())}: {[*missing][:2]} ({sorted(names)})"
    )


if __name__ == "__main__":
    from tapelake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as failure:  # noqa: BLE001 - go on with the next query
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
