"""Increment filters and row-level table changes as DataFrame recipes.

Plain Parquet has no MERGE or DELETE.  These functions describe the changed
table; :mod:`areaflow.sources.sinks` applies them to the touched partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.operators import dedupe

# --- watermarks ---------------------------------------------------------------


def high_water(target: DataFrame, column: str) -> DataFrame:
    return target.agg(F.max(column).alias("_mark"))


def mark_of(target: DataFrame | None, column: str):
    """The highest value as a literal, or None when there is nothing to compare with.

    One row comes to the driver, so that the bound is a constant the scan can
    use to skip files and row groups.
    """
    if target is None:
        return None
    found = high_water(target, column).first()[0]
    return clock.wall(found) if isinstance(found, dt.datetime) else found


def since(df: DataFrame, target: DataFrame | None, column: Column, mark: str) -> DataFrame:
    """Rows above the target's highest ``mark``; all rows when it has none."""
    bound = mark_of(target, mark)
    return df if bound is None else df.where(column > bound)


def since_or_unknown(df: DataFrame, target: DataFrame | None, column: Column, mark: str) -> DataFrame:
    """Like :func:`from_mark`, but keeping rows without a time.

    For use in front of :func:`dedupe.latest_wins`, where such a row beats all
    others: ranking what is left and applying the bound gives the same rows as
    ranking everything first.
    """
    bound = mark_of(target, mark)
    return df if bound is None else df.where((column >= bound) | column.isNull())


def from_mark(df: DataFrame, target: DataFrame | None, column: Column, mark: str) -> DataFrame:
    """Rows at or above the target's highest ``mark``, for targets that merge by id.

    A second load may carry the clock of one already built; its rows arrive and
    those of the first merge into themselves.
    """
    bound = mark_of(target, mark)
    return df if bound is None else df.where(column >= bound)


def event_time_bound(target: DataFrame | None, lateness_minutes: int = 0) -> dt.datetime | None:
    """First minute after the target's highest minute key, less the lateness."""
    key = mark_of(target, "time_key")
    if key is None:
        return None
    newest = dt.datetime.strptime(str(key), "%Y%m%d%H%M")
    return newest + dt.timedelta(minutes=1 - lateness_minutes)


def since_event_time(
    df: DataFrame, target: DataFrame | None, observed_at: str = "observed_at", lateness_minutes: int = 0
) -> DataFrame:
    """Minute keys above the target's highest, moved back by an allowed lateness.

    Compared on the observation time itself, which the scan can skip by.
    """
    bound = event_time_bound(target, lateness_minutes)
    return df if bound is None else df.where(F.col(observed_at) >= clock.wall(bound))


# --- merges -------------------------------------------------------------------


def upsert_newest(target: DataFrame, batch: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Of target and batch rows with one key the newest stays, so an older replay changes nothing.

    Equally new rows are settled by value; rows with a NULL in the key all stay.
    """
    both = target.unionByName(batch)
    known = both.dropna(subset=list(keys))
    ties = [F.col(c).desc_nulls_last() for c in both.columns if c not in keys]
    unknown = F.lit(False)
    for key in keys:
        unknown = unknown | F.col(key).isNull()
    return dedupe.latest_wins(known, keys, newest, ties).unionByName(both.where(unknown))


def _without(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(batch.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows with the same key, others are added.

    NULL keys match nothing, so such rows stay on both sides.
    """
    return _without(target, batch, keys).unionByName(batch)


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target lacks."""
    return _without(batch, target, keys)


def insert_only(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds new keys and never changes existing rows; new columns are appended."""
    return target.unionByName(new_rows(target, batch, keys), allowMissingColumns=True)


# --- replacement loads --------------------------------------------------------


def replace_where(target: DataFrame, batch: DataFrame, stale: Column) -> DataFrame:
    """Drop target rows that certainly match ``stale``, then add the batch."""
    keep = ~F.coalesce(stale, F.lit(False))
    return target.where(keep).unionByName(batch)


def replace_range(
    target: DataFrame, batch: DataFrame, column: str, low: dt.datetime, high: dt.datetime, closed: bool = True
) -> DataFrame:
    """Reload a time range; ``closed`` includes the upper bound."""
    c = F.col(column)
    upper = c <= clock.wall(high) if closed else c < clock.wall(high)
    return replace_where(target, batch, (c >= clock.wall(low)) & upper)


def replace_key(target: DataFrame, batch: DataFrame, column: str, value: dt.datetime | dt.date) -> DataFrame:
    """Reload the rows of one key value."""
    return replace_where(target, batch, F.col(column) == clock.wall(value))


def insert_if_absent(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Add only batch rows whose load key has no row in the target yet."""
    return target.unionByName(new_rows(target, batch, [column]))


def update_where(df: DataFrame, column: str, value: Column, condition: Column) -> DataFrame:
    """Conditional update of one column."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def localise_created_at(df: DataFrame, day: dt.date) -> DataFrame:
    """UTC to local for the rows created on ``day``."""
    on_day = F.to_date("created_at") == F.lit(day)
    return update_where(df, "created_at", clock.to_local(F.col("created_at")), on_day)
