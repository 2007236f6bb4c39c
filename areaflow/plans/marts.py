"""Staging views, the event dimension and the fact tables.

``target`` is the already built table for an incremental build, or None for a
full one.  ``run_ts`` stamps built rows; where a fact's own clock differs from
the source's, the source time is carried as ``source_created_at`` and used as
the watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock, keys, parsing
from areaflow.operators import dedupe, incremental, lookup

# --- staging ------------------------------------------------------------------


def stg_transit(source: DataFrame) -> DataFrame:
    """Newest load of each observation; equal load times are settled by value."""
    ties = [F.col(f.column).desc_nulls_last() for f in c.TRANSIT_STEMS]
    ties = [F.col("area_name").desc_nulls_last(), *ties]
    return dedupe.latest_wins(source, ["observed_at", "area_code"], "created_at", ties).select(
        *c.SOURCE_TABLES["bus"].names
    )


def stg_commercial(source: DataFrame) -> DataFrame:
    return source.select(*c.SOURCE_TABLES["commercial"].names)


def stg_commercial_rsb(categories: DataFrame, commercial: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Categories with the minute key of their parent observation."""
    parents = commercial.select("source_id", clock.time_key(F.col("observed_at")).alias("time_key")).distinct()
    joined = lookup.lookup(categories, parents, {"source_id": "source_id"}, {"time_key": "time_key"})
    fields = [f.column for f in c.CATEGORY_FIELDS]
    return joined.select("commercial_id", "source_id", "time_key", *fields, "created_at", *carry)


def stg_event(source: DataFrame) -> DataFrame:
    renamed = source.withColumnsRenamed({"event_x": "longitude", "event_y": "latitude"})
    return renamed.withColumns(
        {"longitude": F.col("longitude").cast("double"), "latitude": F.col("latitude").cast("double")}
    )


def stg_population(source: DataFrame) -> DataFrame:
    return source.select(*[n for n in c.SOURCE_TABLES["population"].names if n != "congestion_message"])


def stg_weather(source: DataFrame) -> DataFrame:
    return source.select(*c.SOURCE_TABLES["weather"].names)


# --- shared pieces ------------------------------------------------------------

_CARRIED = "_key_"


def carried(name: str) -> str:
    """The column under which a fact carries a column of its staging view for a build."""
    return f"{_CARRIED}{name}"


def is_carried(name: str) -> bool:
    return name.startswith(_CARRIED)


def _carry(names: Sequence[str]) -> list[Column]:
    return [F.col(n).alias(carried(n)) for n in names]


def _with_area(df: DataFrame, areas: DataFrame, how: str = "left") -> DataFrame:
    return lookup.lookup(df, areas, {"area_code": "area_code"}, {"area_id": "area_id"}, how)


def _minute() -> Column:
    return clock.time_key(F.col("observed_at"))


def _clipped(name: str, length: int) -> Column:
    return parsing.clipped(F.col(name), length).alias(name)


def _names(fields: list[c.Field]) -> list[str]:
    return [f.column for f in fields]


# --- event dimension and fact -------------------------------------------------


def _event_attributes(stg: DataFrame) -> DataFrame:
    """Staged events with period bounds and the hash of all attributes."""
    dated = stg.withColumns(
        {
            "event_start_date": clock.period_bound(F.col("event_period"), 1),
            "event_end_date": clock.period_bound(F.col("event_period"), 2),
        }
    )
    event_id = keys.surrogate_key(
        F.col("event_name"),
        F.col("event_start_date"),
        F.col("event_end_date"),
        F.col("event_place"),
        keys.coordinate_text(F.col("longitude")),
        keys.coordinate_text(F.col("latitude")),
        parsing.bool_text(F.col("is_paid")),
        F.col("thumbnail_url"),
        F.col("event_url"),
        F.col("event_extra_detail"),
    )
    return dated.withColumn("event_id", event_id)


# Attribute columns of the event dimension, in table order.
EVENT_ATTRIBUTES = """
event_name event_start_date event_end_date event_place longitude latitude
is_paid thumbnail_url event_url event_extra_detail
""".split()


def dim_event(stg: DataFrame, run_ts: dt.datetime, target: DataFrame | None = None) -> DataFrame:
    """New events, one row per id; loads of the newest clock are read again, as ids are merged.

    A free event and one of unknown price share an id; the known price is kept.
    """
    fresh = incremental.from_mark(stg, target, F.col("created_at"), "source_created_at")
    # The id mostly fixes the texts and dates, so they can be grouping keys; what may
    # vary under one id is fixed-width, which keeps this a hash aggregate.
    varying = ["longitude", "latitude", "is_paid"]
    fixed = [a for a in EVENT_ATTRIBUTES if a not in varying]
    events = (
        _event_attributes(fresh)
        .groupBy("event_id", *fixed)
        .agg(*[F.max(v).alias(v) for v in varying], F.max("created_at").alias("source_created_at"))
    )
    # texts of different events can join to one id; one whole row of such stays
    order = [F.col(a).desc_nulls_last() for a in ["is_paid", *fixed, "longitude", "latitude"]]
    one_each = dedupe.ranked_first(events, ["event_id"], order)
    return one_each.select("event_id", *EVENT_ATTRIBUTES, clock.wall(run_ts).alias("created_at"), "source_created_at")


def fact_event(
    stg: DataFrame,
    events: DataFrame,
    areas: DataFrame,
    run_ts: dt.datetime,
    target: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per event, area and observation; unmatched events are dropped.

    With ``carry`` rows of unknown areas stay, without an area, for a build to note and drop.
    """
    fresh = incremental.from_mark(stg, target, F.col("created_at"), "source_created_at")
    keyed = _event_attributes(fresh).select(
        "event_id", "area_code", "event_period", "observed_at", F.col("created_at").alias("source_created_at")
    )
    known = lookup.lookup(keyed, events, {"event_id": "event_id"}, {"event_id": "_known"}, how="inner")
    placed = _with_area(known, areas, how="left" if carry else "inner").drop("_known")
    grain = ["event_id", "area_id", "observed_at"]
    # an unknown area has no number yet, so its rows are told apart by their code
    unplaced = [F.when(F.col("area_id").isNull(), F.col("area_code")).alias("_unplaced")] if carry else []
    one_each = placed.groupBy(*grain, *unplaced).agg(
        F.max("event_period").alias("event_period"),
        F.max("source_created_at").alias("source_created_at"),
        F.max("area_code").alias("area_code"),
    )
    fact_id = keys.surrogate_key(
        F.col("event_id"), F.col("area_id"), F.date_format("observed_at", c.DASHED_SECOND)
    )
    return one_each.select(
        fact_id.alias("fact_event_id"),
        "event_period",
        clock.wall(run_ts).alias("created_at"),
        *grain,
        "source_created_at",
        *_carry(carry),
    )


# --- other facts --------------------------------------------------------------


def fact_commercial(
    stg: DataFrame, areas: DataFrame, target: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    fresh = incremental.from_mark(stg, target, F.col("created_at"), "created_at")
    payments = [F.col(n).cast("int").alias(n) for n in _names(c.COMMERCIAL_FIELDS) if n.startswith(("total", "payment"))]
    ratios = [F.col(n).cast("decimal(5,2)").alias(n) for n in _names(c.COMMERCIAL_FIELDS) if n.endswith("_ratio")]
    return _with_area(fresh, areas).select(
        F.col("source_id").alias("fact_commercial_id"),
        _minute().alias("time_key"),
        _clipped("congestion_level", 20),
        *payments,
        *ratios,
        F.col("area_id").cast("int").alias("area_id"),
        "created_at",
        *_carry(carry),
    )


def fact_commercial_rsb(
    stg: DataFrame, categories: DataFrame, target: DataFrame | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    fresh = incremental.from_mark(stg, target, F.col("created_at"), "created_at")
    pair = {"category_large": "category_large", "category_medium": "category_medium"}
    placed = lookup.lookup(fresh, categories, pair, {"category_id": "category_id"})
    row_id = keys.surrogate_key(F.col("commercial_id"), F.col("source_id"))
    counts = [n for n in _names(c.CATEGORY_FIELDS) if n.startswith("category_payment") or n == "merchant_count"]
    return placed.select(
        F.col("source_id").alias("fact_commercial_id"),
        parsing.clipped(row_id, 64).alias("fact_commercial_rsb_id"),
        _clipped("category_congestion_level", 20),
        *[F.col(n).cast("int").alias(n) for n in counts],
        _clipped("merchant_basis_month", 6),
        F.col("category_id").cast("int").alias("category_id"),
        "time_key",
        "created_at",
        *_carry(carry),
    )


def fact_population(
    stg: DataFrame,
    areas: DataFrame,
    congestion: DataFrame,
    run_ts: dt.datetime,
    target: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    fresh = incremental.from_mark(stg, target, F.col("created_at"), "source_created_at")
    labelled = lookup.lookup(
        fresh, congestion, {"congestion_label": "congestion_label"}, {"congestion_id": "congestion_id"}
    )
    described = {"area_name", "area_code", "congestion_label", "congestion_message"}
    return _with_area(labelled, areas).select(
        F.col("source_id").alias("fact_population_id"),
        *[n for n in _names(c.POPULATION_FIELDS) if n not in described],
        clock.wall(run_ts).alias("created_at"),
        F.col("area_id").cast("int").alias("area_id"),
        "congestion_id",
        _minute().alias("time_key"),
        F.col("created_at").alias("source_created_at"),
        *_carry(carry),
    )


def fact_transport(
    bus: DataFrame,
    subway: DataFrame,
    areas: DataFrame,
    run_ts: dt.datetime,
    target: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Both staged transit feeds under one key, with the area's number as in the other facts."""
    tagged = [
        incremental.from_mark(stg, target, F.col("created_at"), "source_created_at").withColumn(
            "transport_type", F.lit(feed.label)
        )
        for stg, feed in ((bus, c.BUS), (subway, c.SUBWAY))
    ]
    both = _with_area(tagged[0].unionByName(tagged[1]), areas)
    counts = [n for n in _names(c.TRANSIT_STEMS) if n != "station_count_basis_month"]
    return both.select(
        keys.transit_key(F.col("observed_at"), F.col("area_code"), F.col("transport_type")).alias(
            "fact_transport_id"
        ),
        "transport_type",
        "station_count_basis_month",
        *counts,
        F.col("area_id").cast("int").alias("area_id"),
        "area_code",
        _minute().alias("time_key"),
        clock.wall(run_ts).alias("created_at"),
        F.col("created_at").alias("source_created_at"),
        *_carry(carry),
    )


# Columns the weather fact renames.
WEATHER_RENAMES = {"wind_direction": "wind_direction_code", "precipitation": "precipitation_amount"}


def fact_weather(
    stg: DataFrame,
    areas: DataFrame,
    run_ts: dt.datetime,
    target: DataFrame | None = None,
    lateness_minutes: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Event-time watermark, widened by an allowed lateness for backfills."""
    fresh = incremental.since_event_time(stg, target, lateness_minutes=lateness_minutes)
    measures = [F.col(n).alias(WEATHER_RENAMES.get(n, n)) for n in _names(c.WEATHER_FIELDS)]
    return _with_area(fresh, areas).select(
        F.col("source_id").alias("fact_weather_id"),
        *measures,
        F.col("area_id").cast("int").alias("area_id"),
        clock.wall(run_ts).alias("created_at"),
        _minute().alias("time_key"),
        *_carry(carry),
    )
