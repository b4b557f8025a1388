"""Column rules: how one canonical column is read from one agency's tape.

A rule is a function without arguments that builds the ``Column`` when a session exists. It yields the column's final
type, except that a date is still a number YYYYMM: :func:`finish` turns that into the date and scrubs placeholders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.functions import casts, clean

Rule = Callable[[], Column]


def _cols(names: tuple[str, ...]) -> list[Column]:
    return [F.col(name) for name in names]


def finish(name: str, is_date: bool, placeholders: tuple) -> Column:
    value = F.col(name)
    return casts.code_to_date(value) if is_date else clean.sentinel_to_null(value, placeholders)


def _cast(source: str, read: Callable[[Column], Column]) -> Rule:
    """A rule that reads one field as another type; ``rule.source`` is that field."""

    def rule() -> Column:
        return read(F.col(source))

    rule.source = source
    return rule


def text(source: str) -> Rule:
    return lambda: F.col(source).cast("string")


def number(source: str) -> Rule:
    return _cast(source, casts.try_double)


def whole(source: str) -> Rule:
    return _cast(source, casts.try_int)


def whole_plus_one(source: str) -> Rule:
    return _cast(source, clean.one_more)


def yyyymm(source: str) -> Rule:
    return _cast(source, casts.yyyymm_code)


def mmyyyy(source: str) -> Rule:
    return _cast(source, casts.mmyyyy_code)


def coded(source: str, meanings: dict, default=None) -> Rule:
    return lambda: clean.code_map(F.col(source), meanings, default)


def blank_no(source: str) -> Rule:
    return lambda: clean.blank_to_no(F.col(source))


def delinquency(source: str) -> Rule:
    return lambda: clean.delinquency_code(F.col(source))


def total(*sources: str) -> Rule:
    return lambda: clean.null_safe_sum(_cols(sources))


def loss(balance: str, proceeds: str, interest: str, expenses: tuple[str, ...], credits: tuple[str, ...]) -> Rule:
    return lambda: clean.net_loss(F.col(balance), F.col(proceeds), F.col(interest), _cols(expenses), _cols(credits))
