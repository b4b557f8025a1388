"""Array expressions that the native operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 256


def block_sums(lengths: Column) -> Column:
    """For each 256 elements of a long array, the sum of all elements before them. Keep it in a column of its own."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(lengths) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0).cast("long"), lambda s, x: s + x),
    )
    return F.transform(blocks, lambda _, b: F.aggregate(F.slice(blocks, F.lit(1), b), F.lit(0).cast("long"), lambda s, x: s + x))


def sum_before(lengths: Column, sums: Column, i: Column) -> Column:
    """The sum of the elements before the i-th (from 0); ``sums``: what block_sums() gave. Linear over an array, but for a small part."""
    b = F.floor(i / _BLOCK).cast("int")
    return F.get(sums, b) + F.aggregate(F.slice(lengths, b * _BLOCK + 1, i % _BLOCK), F.lit(0).cast("long"), lambda s, x: s + x)
