"""Null-safe scalar parsers.

Raw leaves are text and ANSI mode is on, so every conversion is a ``try_cast``:
a value that does not parse becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaflow import contracts

Rule = Callable[[Column], Column]


def int_truncating(c: Column) -> Column:
    """``'12.9'`` -> 12; blanks, text, NaN and overflow -> NULL."""
    return c.try_cast("double").try_cast("int")


def int_strict(c: Column) -> Column:
    """``'12'`` -> 12 but ``'12.9'`` -> NULL."""
    return c.try_cast("int")


def int_or_zero(c: Column) -> Column:
    return F.coalesce(int_truncating(c), F.lit(0))


def real(c: Column) -> Column:
    return c.try_cast("float")


def coordinate(c: Column) -> Column:
    """Blank text is a missing coordinate."""
    return F.nullif(F.trim(c), F.lit("")).try_cast("double")


def unless_sentinel(c: Column, sentinel: str, rule: Rule) -> Column:
    return rule(F.nullif(c, F.lit(sentinel)))


def real_unless_sentinel(c: Column) -> Column:
    return unless_sentinel(c, contracts.UNDER_INSPECTION, real)


def ratio(c: Column) -> Column:
    """decimal(5,2), half up; out of range -> NULL."""
    return c.try_cast("decimal(5,2)")


# Of the odd twentieths, the doubles nearest to 3, 7, 17 and 19
# lie below the true fraction, those for 1, 9, 11 and 13 above it; 5 and 15 are
# exact, so they are true ties.
_TWENTIETHS_ABOVE = (1, 9, 11, 13)
_TWENTIETHS_EXACT = (5, 15)


def one_decimal(c: Column) -> Column:
    """Round the binary value to one decimal (ties to even), as decimal(5,2).

    ``round``/``bround`` work on the printed decimal, where 2.35 looks like a
    tie although the stored double is below it.  The fraction of a double is
    exact, so comparing it with the midpoint between two tenths decides.  NaN
    and values beyond the target type become NULL before any arithmetic.
    """
    x = F.abs(c.cast("double"))
    x = F.when(x < 1000, x)
    whole = F.floor(x)
    frac = x - whole
    tenth = F.floor(frac * 10)
    twentieth = 2 * tenth + 1
    midpoint = twentieth / F.lit(20.0)
    up = (frac > midpoint) | (
        (frac == midpoint)
        & (
            twentieth.isin(*_TWENTIETHS_ABOVE)
            | (twentieth.isin(*_TWENTIETHS_EXACT) & (tenth % 2 == 1))
        )
    )
    tenths = whole * 10 + tenth + F.when(up, 1).otherwise(0)
    signed = F.when(c < 0, -tenths).otherwise(tenths)
    return (signed.cast("decimal(20,0)") / F.lit(10).cast("decimal(2,0)")).try_cast("decimal(5,2)")


def yes_no(c: Column) -> Column:
    """Three-valued: Y, N, anything else is unknown."""
    return F.when(c == "Y", True).when(c == "N", False)


def is_yes(c: Column) -> Column:
    """Two-valued: a missing flag counts as no."""
    return c.eqNullSafe(F.lit("Y"))


def bool_text(c: Column) -> Column:
    return F.when(c, "true").otherwise("false")


def text(c: Column) -> Column:
    return c


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def clipped(c: Column, length: int) -> Column:
    """A length-limited text cast; Spark's own varchar cast keeps the tail."""
    return F.substring(c, 1, length)


# Layouts seen in the station basis-month field.
_MONTH_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy-MM", "yyyyMMdd", "yyyyMM")


def basis_month(c: Column) -> Column:
    tries = [F.try_to_timestamp(c, F.lit(layout)) for layout in _MONTH_LAYOUTS]
    return reduce(F.coalesce, tries).cast("timestamp_ntz")


RULES: dict[str, Rule] = {
    f.__name__: f
    for f in (
        text, text_or_empty, int_truncating, int_strict, int_or_zero, real,
        real_unless_sentinel, coordinate, ratio, yes_no, is_yes, basis_month,
    )
}
