"""Timestamps. All wall clocks are ``timestamp_ntz`` in local (KST) time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaflow import contracts


def wall(value: dt.datetime | dt.date | str) -> Column:
    """A wall-clock literal."""
    return F.lit(str(value)).cast("timestamp_ntz")


def parse(c: Column, layout: str) -> Column:
    """NULL when the text does not match the layout."""
    return F.try_to_timestamp(c, F.lit(layout)).cast("timestamp_ntz")


def reformat_compact(c: Column) -> Column:
    """``20250705 2301`` -> ``2025-07-05 23:01:00``; other text is kept."""
    return F.regexp_replace(
        c,
        "^([0-9]{4})([0-9]{2})([0-9]{2}) ([0-9]{2})([0-9]{2})$",
        "$1-$2-$3 $4:$5:00",
    )


def time_key(ts: Column) -> Column:
    """Minute as the bigint ``yyyyMMddHHmm``."""
    # arithmetic, so no text is formatted and parsed for each row
    return (
        F.year(ts).cast("bigint") * 100000000
        + F.month(ts) * 1000000
        + F.dayofmonth(ts) * 10000
        + F.hour(ts) * 100
        + F.minute(ts)
    ).cast("bigint")


def truncated(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def to_local(ts: Column) -> Column:
    """A stored UTC wall clock as the local wall clock."""
    return F.convert_timezone(F.lit(contracts.UTC), F.lit(contracts.LOCAL_ZONE), ts)


def iso_to_local(c: Column) -> Column:
    """ISO text with an offset -> local wall clock, NULL when malformed."""
    wall_clock = F.try_to_timestamp(c).cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(contracts.LOCAL_ZONE), wall_clock)


def now_local() -> Column:
    """Local wall clock; pipelines prefer an explicit run time."""
    return F.convert_timezone(None, F.lit(contracts.LOCAL_ZONE), F.localtimestamp())


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def period_bound(period: Column, part: int) -> Column:
    """Start (1) or end (2) date of ``yyyy-MM-dd~yyyy-MM-dd``."""
    return F.try_to_date(F.trim(F.split_part(period, F.lit("~"), F.lit(part))), "yyyy-MM-dd")


def minute_slot(ts: Column, minutes: int) -> Column:
    """Start of the tumbling batch that a file minute belongs to.

    For slots that divide an hour; several may stand in one projection, which
    ``window`` does not allow.
    """
    return F.timestamp_add("MINUTE", -(F.minute(ts) % minutes), truncated(ts, "minute"))


def night_start(ts: Column) -> Column:
    """Start of the 21:00 -> 09:00 backfill window holding ``ts``, else NULL."""
    evening = F.timestamp_add("HOUR", F.lit(21), F.to_date(ts).cast("timestamp_ntz"))
    return F.when(F.hour(ts) >= 21, evening).when(
        F.hour(ts) < 9, F.timestamp_add("HOUR", F.lit(-24), evening)
    )


# Windows for schedulers: plain datetime arithmetic on the driver.


def previous_minutes(run_ts: dt.datetime, minutes: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open window of the last ``minutes`` whole minutes."""
    end = run_ts.replace(second=0, microsecond=0)
    return end - dt.timedelta(minutes=minutes), end


def previous_night(run_ts: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Half-open 21:00 -> 09:00 window that ends on the run's day."""
    end = run_ts.replace(hour=9, minute=0, second=0, microsecond=0)
    return end - dt.timedelta(hours=12), end


def previous_week(run_ts: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    """Half-open Monday-to-Monday week before the run's week."""
    day = run_ts.replace(hour=0, minute=0, second=0, microsecond=0)
    monday = day - dt.timedelta(days=day.weekday())
    return monday - dt.timedelta(days=7), monday
