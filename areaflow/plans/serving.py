"""Tables the dashboards read, kept up to date by the builds, so that no dashboard scans a fact.

``state`` holds the newest row of every area and feed.  A build merges the rows it
stored; where a load ran again and the newest row of an area may have gone with it, the area
is looked up anew, from the newest dates backwards.

``partials`` holds count, sum, least and greatest crowd sizes of every area, date and hour.
A build writes the dates it touched; longer periods merge hours.

``insight`` holds, once asked for, the columns of two facts that are read side by side,
bucketed by area and minute, so that their join moves no row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.functions import clock
from areaflow.operators import dedupe
from areaflow.plans import dashboards
from areaflow.sources import buckets, files, journal, sinks
from areaflow.sources.tables import Warehouse

DATE = sinks.DATE

#: Columns of a feed's fact that the latest state shows.
STATE = {
    "commercial": ["congestion_level", "total_payment_count"],
    "population": ["congestion_id", "population_min", "population_max"],
    "weather": ["temperature", "pm10_value", "air_quality_value"],
}


# --- latest state ---------------------------------------------------------------------


def _newest(rows: DataFrame, feed: str) -> DataFrame:
    """One row per area: the newest minute, of equal ones the smallest id."""
    key = f"fact_{feed}_id"
    order = [F.col("time_key").desc_nulls_last(), F.col(key).asc_nulls_last()]
    narrow = rows.where("area_id is not null").select("area_id", "time_key", key, *STATE[feed], DATE)
    return dedupe.ranked_first(narrow, ["area_id"], order)


def _stored_days(wh: Warehouse, feed: str) -> list[dt.date]:
    names = journal.folders(wh.spark, wh.path("fact", feed), 1)
    return sorted(dt.date.fromisoformat(n.split("=")[1]) for n in names if not n.endswith("__"))


def _looked_up(wh: Warehouse, feed: str, areas: DataFrame) -> DataFrame:
    """The newest rows of some areas, from ever more dates until all are found or none is left."""
    fact = wh.existing("fact", feed)
    days = _stored_days(wh, feed)
    found = _newest(fact, feed).limit(0)
    width = 1
    while days and not areas.isEmpty():
        some, days = days[-width:], days[:-width]
        rows = sinks.on_days(fact, DATE, some).join(areas, "area_id", "left_semi").select(*fact.columns)
        part, _ = session.staged(_newest(rows, feed), "lookup")
        found = found.unionByName(part)
        areas = areas.join(part, "area_id", "left_anti")
        width *= 2
    return found


def refresh_state(wh: Warehouse, feed: str, rows: DataFrame, again: Sequence[dt.date] = (), everything: bool = False) -> None:
    """Merge rows a build stored; ``again`` names dates on which rows may have gone."""
    path = wh.path("state", feed)
    known = None if everything or not files.exists(wh.spark, path) else wh.spark.read.parquet(path)
    if known is None and not everything:
        # a fact from before there was a state
        rows = wh.existing("fact", feed)
    merged = _newest(rows, feed)
    if known is not None:
        key = f"fact_{feed}_id"
        kept = known.join(rows.select(key), key, "left_anti").select(*merged.columns)
        if again:
            doubtful = F.col(DATE).isin(list(again))
            areas, _ = session.staged(known.where(doubtful).select("area_id"), "areas")
            kept = kept.where(~doubtful).unionByName(_looked_up(wh, feed, areas).select(*merged.columns))
        merged = _newest(kept.unionByName(merged), feed)
    sinks.replace_prefix(merged, path)


def latest_state(wh: Warehouse) -> DataFrame:
    """What `dashboards.latest_snapshot` gives, from one stored row per area and feed."""
    sides = []
    for feed, columns in STATE.items():
        stored = wh.existing("state", feed)
        sides.append(stored.select("area_id", F.col("time_key").alias(f"{feed}_time_key"), *columns))
    return sides[0].join(sides[1], "area_id", "full").join(sides[2], "area_id", "full")


# --- partial statistics -----------------------------------------------------------------


def _partials(fact: DataFrame) -> DataFrame:
    hour = F.floor(F.col("time_key") / 100) % 100
    middle = (F.col("population_min").cast("bigint") + F.col("population_max")) / 2
    return (
        fact.where("area_id is not null and time_key is not null")
        .groupBy("area_id", hour.cast("int").alias("hour"), DATE)
        .agg(
            F.count("*").alias("observations"),
            F.min("population_min").alias("population_min"),
            F.max("population_max").alias("population_max"),
            # halves are exact, so sums do not depend on the order or on how hours are merged
            F.sum(middle).alias("middle_sum"),
            F.count(middle).alias("middle_count"),
        )
    )


def refresh_partials(wh: Warehouse, days: Sequence[dt.date | None] | None) -> None:
    """Rewrite the partial statistics of some dates, or of all; a date without rows loses its partition."""
    path = wh.path("partials", "population")
    fact = wh.existing("fact", "population")
    if days is None or not files.exists(wh.spark, path):
        sinks.write_partitions(_partials(fact), path, [DATE], keep_others=False)
    else:
        sinks.replace_days(_partials(sinks.on_days(fact, DATE, list(days))), path, days)


def weekly_stats(wh: Warehouse, run_ts: dt.datetime, area_id: int | None = None) -> DataFrame:
    """What `dashboards.weekly_stats` gives, merged from the hours of seven dates."""
    monday, end = clock.previous_week(run_ts)
    hours = wh.existing("partials", "population").where(
        (F.col(DATE) >= F.lit(monday.date())) & (F.col(DATE) < F.lit(end.date()))
    )
    if area_id is not None:
        hours = hours.where(F.col("area_id") == area_id)
    weekday = (F.weekday(F.col(DATE)) + 1).alias("weekday")
    return hours.groupBy("area_id", weekday, "hour").agg(
        F.sum("observations").alias("observations"),
        F.min("population_min").alias("population_min"),
        F.max("population_max").alias("population_max"),
        (F.sum("middle_sum") / F.sum("middle_count")).alias("population_avg"),
    )


# --- facts side by side -------------------------------------------------------------------

INSIGHT_KEYS = ["area_id", "time_key"]


def _side(fact: DataFrame, feed: str) -> DataFrame:
    """Rows that can find a partner."""
    return fact.dropna(subset=INSIGHT_KEYS).select(*INSIGHT_KEYS, *dashboards.INSIGHT[feed], DATE)


def keep_insight(wh: Warehouse, count: int) -> None:
    """Keep the sides of the insight view from now on, each date in ``count`` buckets.

    A bucket is what one task reads of all dates asked for, so the count follows from the
    size of the longest usual range.
    """
    for feed in dashboards.INSIGHT:
        buckets.create(_side(wh.existing("fact", feed), feed), wh.path("insight", feed), INSIGHT_KEYS, count)


def refresh_insight(wh: Warehouse, feed: str, days: Sequence[dt.date | None] | None) -> None:
    """Rewrite a side on some dates, or on all; nothing where it is not kept."""
    path = wh.path("insight", feed)
    if not buckets.exists(wh.spark, path):
        return
    rows = _side(wh.existing("fact", feed), feed)
    if days is None:
        days = sorted({*_stored_days(wh, feed), *(row[0] for row in buckets.read(wh.spark, path).select(DATE).distinct().collect())})
    buckets.replace_days(sinks.on_days(rows, DATE, list(days)), path, days)


def insight(
    wh: Warehouse, start: dt.date, end: dt.date, conditions: Sequence[Column], order: Sequence[Column]
) -> DataFrame:
    """What `dashboards.insight` gives for the dates of ``[start, end)``, from the sides kept."""
    dates = (F.col(DATE) >= F.lit(start)) & (F.col(DATE) < F.lit(end))
    sides = [buckets.read(wh.spark, wh.path("insight", feed)).where(dates) for feed in dashboards.INSIGHT]
    return dashboards.insight(*sides, conditions, order)


def refresh(wh: Warehouse, fact: str, rows: DataFrame, days: Sequence | None, again: Sequence = ()) -> None:
    """After a build: ``rows`` it stored, the dates it touched or None for all, and those where rows may have gone."""
    if fact in STATE:
        refresh_state(wh, fact, rows, again, everything=days is None)
    if fact == "population":
        refresh_partials(wh, days)
    if fact in dashboards.INSIGHT:
        refresh_insight(wh, fact, days)

