"""Casts of tape text.

Every function takes and returns a ``Column``, gives NULL for text it cannot read (whatever the ANSI setting),
and is cheap on clean values: no regular expression, date formatter, BigDecimal or exception on the common path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this, a double has no fraction left.
_WHOLE_DOUBLES = float(2**52)


# Text that may be a number although it does not end in a digit or point: trailing blanks, infinity, not-a-number.
_NUMBER_IN_DISGUISE = r"(?i)([0-9.]\s+|^\s*[+-]?(inf|infinity|nan)\s*)$"


def try_double(text: Column) -> Column:
    """Text to double. A Java type suffix (``1d``, ``12f``) or hexadecimal digits (``0x1p3``) make no number here.

    A failed cast costs an exception, so text that cannot be a number (a letter code, say) is told by its last
    character before it gets that far.
    """
    ends_plain = F.right(text, F.lit(1)).between(".", "9") & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    return F.when(ends_plain | text.rlike(_NUMBER_IN_DISGUISE), text.try_cast("double"))


def try_int(text: Column) -> Column:
    """Text to int; a fraction is rounded half away from zero (``'2.5'`` -> 3), an exponent is allowed."""
    return F.coalesce(
        F.when(_starts_with_digit(text) & ~F.contains(text, F.lit(".")), text.try_cast("int")),
        F.round(try_double(text)).try_cast("int"),
    )


def _starts_with_digit(text: Column) -> Column:
    return (text >= "0") & (text < ":")


def _six_bytes(text: Column) -> Column:
    """Whole number in a text of six bytes that starts with a digit, else NULL. Blanks may follow the digits."""
    return F.when((F.octet_length(text) == 6) & _starts_with_digit(text), text.try_cast("int"))


def yyyymm_code(text: Column) -> Column:
    """The first six characters as a whole number, NULL if they are none."""
    return F.coalesce(_six_bytes(text), _six_bytes(F.left(text, F.lit(6))))


def mmyyyy_code(text: Column) -> Column:
    """``MMYYYY`` as the number YYYYMM: the last four characters are the year, the first two the month."""
    ends_in_digit = F.right(text, F.lit(1)).between("0", "9")
    number = F.when(ends_in_digit, _six_bytes(text))
    swapped = F.concat(F.right(text, F.lit(4)), F.left(text, F.lit(2)))
    return F.coalesce(number % 10000 * 100 + F.floor(number / 10000).cast("int"), _six_bytes(swapped))


def code_to_date(code: Column) -> Column:
    """Number YYYYMM to the first day of that month; NULL outside the years 1000-9999 and the months 1-12.

    Six characters that make a number of six digits can only be digits, so nothing else needs checking.
    """
    month = code % 100
    return F.when((code >= 100000) & month.between(1, 12), F.make_date(F.floor(code / 100).cast("int"), month, F.lit(1)))


def yyyymm_to_date(text: Column) -> Column:
    return code_to_date(yyyymm_code(text))


def mmyyyy_to_date(text: Column) -> Column:
    return code_to_date(mmyyyy_code(text))


def month_of(date: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(date, "MM")


def round_half_away(value: Column, places: int) -> Column:
    """Round a double half away from zero in binary arithmetic: ``1.005`` to two places is ``1.0``, not ``1.01``.

    ``value`` is used several times: give a computed value a name in a select of its own first.
    """
    scale = F.lit(float(10**places))
    size = F.abs(value * scale)
    whole = F.floor(size)
    nearest = F.when(size - whole >= 0.5, whole + 1).otherwise(whole).cast("double")
    # At and above 2**52 (and for infinity and NaN) there is nothing to round.
    return F.when(size < _WHOLE_DOUBLES, F.signum(value) * nearest / scale).otherwise(value)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL when there is no whole."""
    return round_half_away(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), places)
