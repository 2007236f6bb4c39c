"""Raw documents to source tables, one function per feed.

Input is a document frame from :mod:`areaflow.sources.raw`; ``run_ts`` is the
load time.  Each function is one lazy plan of projections and generators; only
the named duplicate policies shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock, keys, parsing, text
from areaflow.operators import conform, dedupe, generators, history


def _area(raw: DataFrame) -> dict[str, Column]:
    return {
        "area_code": parsing.text_or_empty(F.col(c.AREA_CODE)),
        "area_name": parsing.text_or_empty(F.col(c.AREA_NAME)),
    }


def _commercial_base(raw: DataFrame) -> DataFrame:
    """Documents with a readable commercial time, and their source id."""
    observed = clock.parse(F.col(f"{c.COMMERCIAL}.{c.COMMERCIAL_TIME}"), c.COMPACT_MINUTE)
    return (
        raw.withColumns({**_area(raw), "observed_at": observed})
        .where("observed_at is not null")
        .withColumn("source_id", keys.source_id(F.col("area_code"), F.col("observed_at")))
    )


def _new_only(df: DataFrame, processed: DataFrame | None, area: str = "file_area_id") -> DataFrame:
    if processed is None:
        return df
    return history.unseen(df, processed, {area: "area_id", "observed_at": "observed_at"})


def commercial(raw: DataFrame, run_ts: dt.datetime, processed: DataFrame | None = None) -> DataFrame:
    """Payment totals and ratios per area."""
    base = _new_only(_commercial_base(raw), processed)
    columns = conform.project(c.COMMERCIAL, c.COMMERCIAL_FIELDS)
    return base.select(
        "source_id", "area_code", "area_name", *columns, "observed_at", clock.wall(run_ts).alias("created_at")
    ).distinct()


def commercial_rsb(
    raw: DataFrame, run_ts: dt.datetime, processed: DataFrame | None = None, outer: bool = False
) -> DataFrame:
    """Payments by category; ``outer`` keeps documents without categories."""
    base = _new_only(_commercial_base(raw), processed)
    items = generators.rows(base, F.col(f"{c.COMMERCIAL}.{c.CATEGORY_ARRAY}"), "item", outer=outer)
    columns = conform.project("item", c.CATEGORY_FIELDS)
    out = items.select("source_id", *columns, "observed_at", clock.wall(run_ts).alias("created_at")).distinct()
    row_id = keys.surrogate_key(F.col("source_id"), F.col("category_large"), F.col("category_medium"))
    return out.select(row_id.alias("commercial_id"), *out.columns)


def population(
    raw: DataFrame, run_ts: dt.datetime, processed: DataFrame | None = None, first_only: bool = False
) -> DataFrame:
    """Crowd sizes and ratios; the first document of an observation wins."""
    items = generators.rows(raw, F.col(c.POPULATION), "item", first_only=first_only)
    typed = items.select(
        *conform.project("item", c.POPULATION_FIELDS),
        clock.parse(F.col(f"item.{c.POPULATION_TIME}"), c.DASHED_MINUTE).alias("observed_at"),
        F.col("file_ts"),
    ).where("observed_at is not null")
    typed = typed.withColumn("area_number", text.area_number(F.col("area_code")))
    fresh = _new_only(typed, processed, "area_number")
    ties = [F.col(f.column).asc_nulls_last() for f in c.POPULATION_FIELDS]
    first = dedupe.first_wins(fresh, ["area_code", "observed_at"], [F.col("file_ts").asc_nulls_last(), *ties])
    return _identified(first.withColumn("created_at", clock.wall(run_ts)), "population")


def _identified(df: DataFrame, table: str) -> DataFrame:
    """Add the source id and take the table's columns in order."""
    schema = c.SOURCE_TABLES[table]
    with_id = df.withColumn("source_id", keys.source_id(F.col("area_code"), F.col("observed_at")))
    return with_id.select(*schema.names)


def event(raw: DataFrame, run_ts: dt.datetime, observed_at: Column | None = None) -> DataFrame:
    """Cultural events, one row per event listed in a document.

    ``observed_at`` defaults to the day of the document's key.
    """
    day = clock.truncated(F.col("file_ts"), "day") if observed_at is None else observed_at
    items = generators.rows(raw, F.col(c.EVENT), "item")
    return items.select(
        F.col(c.AREA_CODE).alias("area_code"),
        F.col(c.AREA_NAME).alias("area_name"),
        *conform.project("item", c.EVENT_FIELDS),
        day.alias("observed_at"),
        clock.wall(run_ts).alias("created_at"),
    )


def transit(raw: DataFrame, feed: c.Transit, run_ts: dt.datetime) -> DataFrame:
    """Boardings and alightings; documents without a station time are not valid."""
    valid = raw.where(F.col(f"{feed.payload}.{feed.prefix}_{c.TRANSIT_TIME_STEM}").isNotNull())
    typed = valid.select(
        F.trim(parsing.text_or_empty(F.col(c.AREA_CODE))).alias("area_code"),
        parsing.text_or_empty(F.col(c.AREA_NAME)).alias("area_name"),
        *conform.project(feed.payload, c.transit_fields(feed)),
        clock.wall(run_ts).alias("created_at"),
        F.col("file_ts").alias("observed_at"),
    )
    return _identified(typed, feed.label)


def weather(raw: DataFrame, run_ts: dt.datetime, first_only: bool = False) -> DataFrame:
    """Weather and air quality; repeated observations keep column maxima."""
    items = generators.rows(raw, F.col(c.WEATHER), "item", first_only=first_only)
    typed = items.select(
        F.col(c.AREA_CODE).alias("area_code"),
        F.col(c.AREA_NAME).alias("area_name"),
        *conform.project("item", c.WEATHER_FIELDS),
        clock.parse(F.col(f"item.{c.WEATHER_TIME}"), c.DASHED_MINUTE).alias("observed_at"),
    )
    best = dedupe.max_wins(typed, ["area_code", "observed_at"])
    return _identified(best.withColumn("created_at", clock.wall(run_ts)), "weather")
