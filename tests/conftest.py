import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a Column expression over the rows of a one-column string table."""

    def run(texts, expression, kind="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}").coalesce(1)
        return [r["y"] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return run
