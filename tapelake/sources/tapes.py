"""Delimited tapes: no header, every field a string, positional names, empty field = NULL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tapelake.operators.lookup import small_side

# Widths of the two tape layouts, separator, and the names of the quarterly files.
FRE_WIDTH = 32
FNM_WIDTH = 110
SEPARATOR = "|"
ORIG_FILES = "historical_data_2*.txt"
PERF_FILES = "historical_data_time_2*.txt"
QUARTER_PATTERN = r"historical_data_(?:time_)?(2[^/]*)\.txt"
# Lines of a block that are split at a time.
_LINES = 10_000

# Columns of the price index master file.
INDEX_SCHEMA = StructType(
    [
        StructField("GEO_Type", StringType()),
        StructField("GEO_Name", StringType()),
        StructField("GEO_Code", LongType()),
        StructField("Year", LongType()),
        StructField("Month", LongType()),
        StructField("Index_NSA", DoubleType()),
        StructField("Index_SA", DoubleType()),
    ]
)


def field_names(width: int) -> list[str]:
    """``column00 .. column31`` for 32 fields, ``column000 .. column109`` for 110."""
    digits = len(str(width - 1))
    return [f"column{i:0{digits}d}" for i in range(width)]


FRE_FIELDS = field_names(FRE_WIDTH)
FNM_FIELDS = field_names(FNM_WIDTH)


def string_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def csv_options(sep: str = SEPARATOR) -> dict[str, str]:
    """No header, and no quoting: a stray quote in a name is part of the name."""
    return {"sep": sep, "header": "false", "quote": ""}


def tape_width(spark: SparkSession, paths: str | list[str], sep: str = SEPARATOR) -> int:
    """The largest number of fields in any line, one more than it has separators: one pass over all lines, combined in the tasks."""
    taken = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(sep), F.lit("")))
    most = spark.read.text(paths).agg(F.max(taken)).head()[0]
    if most is None:
        raise ValueError(f"no lines in {paths}")
    return most // len(sep.encode()) + 1


def read_tape(spark: SparkSession, paths: str | list[str], width: int | None = None, sep: str = SEPARATOR) -> DataFrame:
    """Tape files (a path, a glob or several) with positional string columns.

    Without ``width`` the widest line decides, so no field is lost; shorter lines end in NULLs. With a ``width``, the columns
    are a layout's and ``beyond``, the fields past it (NULL if there are none). Spark makes no inference pass either way.
    """
    if width:
        return layout_fields(spark.read.text(paths), width, sep)
    names = field_names(tape_width(spark, paths, sep))
    return spark.read.schema(string_schema(names)).options(**csv_options(sep)).csv(paths)


def layout_fields(lines: DataFrame, width: int, sep: str = SEPARATOR) -> DataFrame:
    """Lines (``value``), as a table or a stream, -> a layout's columns and ``beyond``, as archives are parsed; no blank lines."""
    return split_fields(lines.where(F.col("value").rlike(r"[^\x00-\x20]")), width, sep)


def split_fields(lines: DataFrame, width: int, sep: str = SEPARATOR, before: tuple[str, ...] = (), after: tuple[str, ...] = ()) -> DataFrame:
    """Every line's fields by position, an empty one as NULL, and ``beyond``, those past the width; other columns around them."""
    split = lines.select(*before, F.split("value", F.lit("\\" + sep), -1).alias("fields"), *after)
    columns = [F.nullif(F.get("fields", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(field_names(width))]
    more = F.transform(F.slice("fields", F.lit(width + 1), F.greatest(F.size("fields") - width, F.lit(0))), lambda x: F.nullif(x, F.lit("")))
    return split.select(*before, *columns, F.when(F.size("fields") > width, more).alias("beyond"), *after)


def split_lines(lines: DataFrame, width: int, sep: str = SEPARATOR, before: tuple[str, ...] = (), after: tuple[str, ...] = ()) -> DataFrame:
    """The rows of :func:`split_fields`, a batch of lines at a time: at 110 fields that takes a fraction of the time of an array per line."""
    return _split_in_batches(lines, _batch_of_lines, width, sep, before, after)


def split_blocks(blocks: DataFrame, width: int, sep: str = SEPARATOR, before: tuple[str, ...] = (), after: tuple[str, ...] = ()) -> DataFrame:
    """The same for a table of :func:`packed` texts of many lines (``value``): a row per line, and one for each NULL."""
    return _split_in_batches(blocks, _lines_of_blocks, width, sep, before, after)


def packed(text: bytes) -> bytes:
    """A text as one value that takes little room and that tasks need not look into."""
    return pa.compress(text, "zstd", asbytes=True)


def _split_in_batches(lines: DataFrame, unpack: Callable, width: int, sep: str, before: tuple[str, ...], after: tuple[str, ...]) -> DataFrame:
    own = {f.name: f for f in lines.schema}
    made = [*string_schema(field_names(width)), StructField("beyond", ArrayType(StringType()))]
    schema = StructType([*[own[n] for n in before], *made, *[own[n] for n in after]])
    return lines.select(*before, "value", *after).mapInArrow(_split_batches(unpack, width, sep, before, after), schema)


def _split_batches(unpack: Callable, width: int, sep: str, before: tuple[str, ...], after: tuple[str, ...]) -> Callable:
    names = [*before, *field_names(width), "beyond", *after]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines, others in unpack(batch, [*before, *after]):
                made = _fields_of(lines, width, sep)
                yield pa.RecordBatch.from_arrays([*others[: len(before)], *made, *others[len(before) :]], names=names)

    return run


def _batch_of_lines(batch: pa.RecordBatch, others: list[str]) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    yield batch.column("value"), [batch.column(n) for n in others]


def _lines_of_blocks(batch: pa.RecordBatch, others: list[str]) -> Iterator[tuple[pa.Array, list[pa.Array]]]:
    """Every block's lines, some at a time, with the block's other columns on each."""
    for i, value in enumerate(batch.column("value")):
        lines = pa.nulls(1, pa.string())
        if value.is_valid:
            with pa.input_stream(pa.BufferReader(value.as_buffer()), compression="zstd") as text:
                lines = pc.split_pattern(pa.array([text.read()], pa.string()), "\n").values
        for at in range(0, len(lines), _LINES):
            some = lines[at : at + _LINES]
            yield some, [pa.repeat(batch.column(n)[i], len(some)) for n in others]


def _fields_of(lines: pa.Array, width: int, sep: str) -> list[pa.Array]:
    """A column for each field of a layout, an empty one as NULL, and ``beyond``."""
    split = pc.split_pattern(lines.cast(pa.string()), sep)
    offsets = split.offsets.to_numpy()
    starts, sizes = offsets[:-1], np.diff(offsets)
    values = pc.if_else(pc.equal(split.values, ""), pa.scalar(None, pa.string()), split.values)
    shortest = sizes.min(initial=width)
    columns = [values.take(pa.array(starts + i, mask=None if i < shortest else sizes <= i)) for i in range(width)]
    more = np.maximum(sizes - width, 0)
    ends = np.concatenate([[0], np.cumsum(more)])
    at = np.repeat(starts + width - ends[:-1], more) + np.arange(ends[-1])
    beyond = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(pa.array(at)), mask=pa.array(more == 0))
    return [*columns, beyond]


def too_wide(spark: SparkSession, paths: str | list[str], width: int, sep: str = SEPARATOR) -> DataFrame:
    """``path, line, fields`` of the lines with more fields than a layout has."""
    fields = F.size(F.split("value", F.lit("\\" + sep), -1))
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), fields.alias("fields"))
    return lines.where(F.col("fields") > width)


def quarter_of_path(path: Column) -> Column:
    """Vintage quarter in a tape's file name, NULL if there is none."""
    return F.nullif(F.regexp_extract(path, QUARTER_PATTERN, 1), F.lit(""))


def with_quarter(tape: DataFrame) -> DataFrame:
    """Add ``quarter`` from the file each row came from (for a file scan, right after reading)."""
    return tape.select(quarter_of_path(F.col("_metadata.file_path")).alias("quarter"), "*")


def read_index_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The price index master file: typed CSV with a header."""
    return spark.read.schema(INDEX_SCHEMA).csv(paths, header=True)


def read_layer(spark: SparkSession, paths: str | list[str], merge: bool = False) -> DataFrame:
    """Parquet of any layer: a directory, a file or a glob. With ``merge``, the columns of all its files, not of one."""
    return spark.read.option("mergeSchema", merge).parquet(*([paths] if isinstance(paths, str) else paths))


def read_parts(spark: SparkSession, path: str, schema: StructType, parts: tuple[str, ...]) -> DataFrame:
    """Parquet in partitions, by a schema that is known: no file's footer is read, and part names are text, whatever they look like.

    A column that an older file lacks is NULL there.
    """
    fields = [f for f in schema if f.name not in parts]
    return spark.read.schema(StructType([*fields, *[StructField(p, StringType()) for p in parts]])).parquet(path)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, bytes`` of the files under a directory or glob; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(pattern).select("path", F.col("length").alias("bytes"))


def footprint(spark: SparkSession, directory: str) -> DataFrame:
    """Number of data files in a directory and their total size."""
    return list_files(spark, directory).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")
    )


def orphan_quarters(orig_quarters: DataFrame, perf_quarters: DataFrame) -> DataFrame:
    """Quarters with an origination file but no performance file; they are not loaded."""
    return orig_quarters.select("quarter").distinct().join(perf_quarters.select("quarter").distinct(), "quarter", "left_anti")


def paired(orig: DataFrame, perf_quarters: DataFrame) -> DataFrame:
    """Origination rows of quarters that have a performance file."""
    return orig.join(small_side(perf_quarters.select("quarter").distinct()), "quarter", "left_semi")
