"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without(c: Column, characters: str) -> Column:
    """Remove every listed character."""
    return F.translate(c, characters, "")


def last_part(c: Column, separator: str) -> Column:
    return F.element_at(F.split(c, F.lit(separator)), -1)


def part(c: Column, separator: str, index: int) -> Column:
    """Zero-based part, NULL when there are fewer parts."""
    return F.get(F.split(c, F.lit(separator)), F.lit(index))


def trailing_digits(c: Column) -> Column:
    return F.regexp_extract(c, "[0-9]+$", 0)


def area_number(area_code: Column) -> Column:
    """``POI001`` -> 1, so codes and file numbers name the same area."""
    return trailing_digits(area_code).try_cast("int")
