"""Helpers that the operators share: reading tables, written intermediate tables, Arrow batches in bounded pieces."""

from __future__ import annotations

import contextlib
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.llm import hashing
from tapelake.session import shared_folder

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the folder that the cluster shares, and read back: its lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no input column has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most_bytes`` of text each, one row at least; every row is in one slice."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The texts of a column as UTF-8 bytes, null as None."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def _trim() -> None:
    """Has the C library give its free memory back, where it can."""
    import ctypes

    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def resting(function: Callable) -> Callable:
    """A function over batches after whose last one the worker gives back what it no longer uses.

    Spark keeps Python workers for later tasks; meanwhile they stand beside the heap and beside workers of other stages.
    """

    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            hashing.forget()
            gc.collect()
            pa.default_memory_pool().release_unused()
            _trim()

    return run


def without_collections(function: Callable) -> Callable:
    """A function over batches that makes no cycles and holds many small objects, which no collection passes over meanwhile."""

    @functools.wraps(function)
    def run(batches):
        collects = gc.isenabled()
        gc.disable()
        try:
            yield from function(batches)
        finally:
            if collects:
                gc.enable()

    return run


def map_batches(df: DataFrame, function: Callable, schema: str, text: str = "text", most_bytes: int = 2_000_000) -> DataFrame:
    """``function`` gets each slice of the table as a batch and returns a dict of column lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, text, most_bytes):
                out = function(part)
                columns = [v.cast(f.type) if isinstance(v := out[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(v, f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(resting(run), schema)


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)
