"""Session settings the plans rely on, and the shared folder for data that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# The canonical projection has some 50 columns; as one fused method it is too long for the JIT compiler. At this limit
# Spark compiles such a projection as several methods instead. (8000 bytes of bytecode is HotSpot's own limit.)
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Where each partition of a join's smaller side is known to be small, it is hashed and the wide side is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # A quarter or an archive's name is text, whatever it looks like.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # The archives' data source chooses what it opens by the filters on quarter, agency, kind and archive.
    "spark.sql.python.filterPushdown.enabled": "true",
    # A task that writes few partitions keeps their files open and needs not sort wide rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # A query's shuffle files go when it ends, not when the driver's heap is next collected; a load is many queries.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; static ones stay the deployer's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    threads = 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tapelake")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every expression costs more than planning a 50-column projection.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(threads))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list:
    """The results of steps that need nothing of each other, in order; while one plans or has few tasks, others fill the cores.

    All steps end before the first failure, if there is one, is raised.
    """
    shared_folder(spark, "")  # where it has to be made, it is made once
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, run-unique path in the application's part of the folder the cluster shares (``spark.checkpoint.dir``).

    What is written there lives as long as the application may need it; :func:`discard` removes it. Only where that is unset and the session runs on one machine, as in tests, a temporary folder is set and used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master", ""):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tapelake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{_application_folder(spark, base)}/{purpose}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/tapelake-{spark.sparkContext.applicationId}"


def discard(spark: SparkSession) -> None:
    """Remove the application's scratch data; tables that were made from it cannot be read any more, written ones can."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark, base))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
