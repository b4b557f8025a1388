"""Cleaning rules: placeholders, code maps, flags, null-safe sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.functions.casts import try_double, try_int

PASS = object()
"""Default for :func:`code_map`: an unmapped code stays as it is."""


def sentinel_to_null(value: Column, placeholders: Sequence) -> Column:
    """NULL where ``value`` is one of the placeholder values, else ``value``."""
    if not placeholders:
        return value
    return F.when(~value.isin(*placeholders), value)


def code_map(code: Column, meanings: Mapping[str, Sequence[str]], default=None) -> Column:
    """Translate codes. ``meanings`` maps each result to the codes it stands for.

    Unmapped codes (and NULL) become ``default``: NULL, a constant, or themselves with :data:`PASS`.
    """
    (first, first_codes), *rest = meanings.items()
    mapped = F.when(code.isin(*first_codes), first)
    for meaning, codes in rest:
        mapped = mapped.when(code.isin(*codes), meaning)
    return mapped.otherwise(code if default is PASS else F.lit(default).cast("string"))


def blank_to_no(flag: Column) -> Column:
    """``'N'`` for a flag that is NULL or all spaces."""
    return F.when(F.trim(flag) != "", flag).otherwise("N")


def delinquency_code(status: Column) -> Column:
    """Months past due as two characters (longer codes keep their first two); ``'RA'`` (acquired property) as is."""
    return F.when(status == "RA", status).otherwise(F.lpad(status, 2, "0"))


def one_more(text: Column) -> Column:
    """Whole number in ``text`` plus one, for counts that start at zero in one agency and at one in the other."""
    return F.try_add(try_int(text), F.lit(1))


def zero_if_null(text: Column) -> Column:
    """Text to double, 0.0 for NULL and for text that is no number."""
    return F.coalesce(try_double(text), F.lit(0.0))


def null_safe_sum(texts: Sequence[Column]) -> Column:
    """Sum of amounts in text, left to right; never NULL."""
    return reduce(lambda total, text: total + zero_if_null(text), texts[1:], zero_if_null(texts[0]))


def net_loss(
    balance: Column, proceeds: Column, interest: Column, expenses: Sequence[Column], credits: Sequence[Column]
) -> Column:
    """Balance lost, less proceeds, plus accrued interest, less expenses and credits; missing amounts count as zero."""
    gross = zero_if_null(balance) - zero_if_null(proceeds) + zero_if_null(interest)
    return reduce(lambda loss, text: loss - zero_if_null(text), [*expenses, *credits], gross)
