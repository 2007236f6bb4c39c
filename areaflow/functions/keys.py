"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaflow import contracts


def source_id(area_code: Column, observed_at: Column, *more: Column) -> Column:
    """md5 of area code, observation time and any further key texts."""
    stamp = F.date_format(observed_at, contracts.DASHED_SECOND)
    texts = [F.coalesce(c, F.lit("")) for c in (area_code, stamp, *more)]
    return F.md5(F.concat_ws("_", *texts))


def surrogate_key(*columns: Column) -> Column:
    """md5 over the texts of the columns, NULLs replaced by a fixed token."""
    texts = [F.coalesce(c.cast("string"), F.lit(contracts.SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws(contracts.SURROGATE_SEPARATOR, *texts))


def coordinate_text(c: Column) -> Column:
    """Doubles print differently across engines; decimals do not.  One too large for any place on earth is NULL."""
    return c.try_cast("decimal(18,7)").cast("string")


def transit_key(observed_at: Column, area_code: Column, label: Column) -> Column:
    """NULL in any part makes the key NULL, as with ``||``."""
    stamp = F.date_format(observed_at, contracts.TIME_KEY)
    return F.concat(stamp, F.lit("-"), area_code, F.lit("-"), label)
