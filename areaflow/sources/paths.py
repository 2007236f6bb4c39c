"""Object keys as data: ``<base>/YYYYMMDD/HHMM_<area>.json``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import contracts
from areaflow.functions import clock


def hourly_globs(base: str, start: dt.datetime, end: dt.datetime, inclusive: bool = False) -> list[str]:
    """One glob per hour step from ``start`` up to ``end``."""
    span = (end - start) // dt.timedelta(hours=1)
    on_the_hour = start + span * dt.timedelta(hours=1) == end
    steps = span + (1 if inclusive or not on_the_hour else 0)
    hours = (start + i * dt.timedelta(hours=1) for i in range(steps))
    return [f"{base}/{h:%Y%m%d}/{h:%H}*.json" for h in hours]


def day_folders(base: str, start: dt.datetime, end: dt.datetime) -> list[str]:
    """The folder of each day that a half-open window touches."""
    last = end - dt.timedelta(microseconds=1)
    days = range((last.date() - start.date()).days + 1)
    return [f"{base}/{start.date() + dt.timedelta(days=i):%Y%m%d}" for i in days]


def with_key_parts(df: DataFrame, path: Column) -> DataFrame:
    """Add ``file_ts``, ``file_hhmm`` and ``file_area_id``; NULL on a bad key."""
    ymd, hhmm, area = (F.nullif(F.regexp_extract(path, contracts.RAW_KEY, i), F.lit("")) for i in (1, 2, 3))
    return df.withColumns(
        {
            "file_ts": clock.parse(F.concat(ymd, hhmm), contracts.TIME_KEY),
            "file_hhmm": hhmm,
            "file_area_id": area.try_cast("int"),
        }
    )


def is_document(path: Column) -> Column:
    """Keys of area documents: a JSON suffix and an underscore in the name."""
    return path.endswith(".json") & F.element_at(F.split(path, "/"), -1).contains("_")


def in_window(file_ts: Column, start: dt.datetime, end: dt.datetime) -> Column:
    """Half-open file-minute window."""
    return (file_ts >= clock.wall(start)) & (file_ts < clock.wall(end))


def in_hour_steps(file_ts: Column, start: dt.datetime, end: dt.datetime, inclusive: bool) -> Column:
    """The rows :func:`hourly_globs` would list, as a predicate."""
    offset = int((start - start.replace(minute=0, second=0, microsecond=0)).total_seconds())
    step = F.timestamp_add("SECOND", F.lit(offset), clock.truncated(file_ts, "hour"))
    upper = step <= clock.wall(end) if inclusive else step < clock.wall(end)
    return (step >= clock.wall(start)) & upper


def in_slot(file_hhmm: Column, prefix: str) -> Column:
    """A fixed daily slot such as ``003`` for 00:30-00:39."""
    return file_hhmm.startswith(prefix)


def first_per_location(df: DataFrame, *location: str, path: str = "path") -> DataFrame:
    """Earliest key of each location (and day, when listed)."""
    return df.groupBy(*location).agg(F.min(path).alias(path))
