"""Staging views, the event dimension and the facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock
from areaflow.operators import incremental
from areaflow.plans import feeds, marts
from areaflow.queries import roles
from areaflow.queries.registry import RUN_TS, query
from areaflow.queries.roles import (
    AREAS, CATEGORIES, CONGESTIONS, RUN, SOURCE_CATEGORY, SOURCE_COMMERCIAL, SOURCE_EVENT, SOURCE_POPULATION,
    SOURCE_WEATHER, TRANSIT_LOADS, E, with_sql,
)


def _names(fields) -> list[str]:
    return [f.column for f in fields]


def source_commercial(spark, sf, docs=None):
    return feeds.commercial(docs or roles.documents(spark, sf), RUN_TS)


def source_category(spark, sf, docs=None):
    return feeds.commercial_rsb(docs or roles.documents(spark, sf), RUN_TS)


def source_population(spark, sf, docs=None):
    return feeds.population(docs or roles.documents(spark, sf), RUN_TS)


def source_weather(spark, sf, docs=None):
    return feeds.weather(docs or roles.documents(spark, sf), RUN_TS)


def staged_events(spark, sf):
    return marts.stg_event(feeds.event(roles.documents(spark, sf), RUN_TS))


def staged_categories(spark, sf):
    docs = roles.documents(spark, sf)
    return marts.stg_commercial_rsb(source_category(spark, sf, docs), source_commercial(spark, sf, docs))


def fact_commercial(spark, sf, docs=None):
    return marts.fact_commercial(marts.stg_commercial(source_commercial(spark, sf, docs)), roles.areas(spark, sf))


def fact_category(spark, sf):
    return marts.fact_commercial_rsb(staged_categories(spark, sf), roles.categories(spark, sf))


def fact_population(spark, sf, docs=None):
    staged = marts.stg_population(source_population(spark, sf, docs))
    return marts.fact_population(staged, roles.areas(spark, sf), roles.congestions(spark, sf), RUN_TS)


def fact_weather(spark, sf, docs=None):
    return marts.fact_weather(marts.stg_weather(source_weather(spark, sf, docs)), roles.areas(spark, sf), RUN_TS)


def fact_transport(spark, sf):
    bus, subway = (marts.stg_transit(roles.transit_loads(spark, sf, feed)) for feed in (c.BUS, c.SUBWAY))
    return marts.fact_transport(bus, subway, roles.areas(spark, sf), RUN_TS)


# --- SQL ----------------------------------------------------------------------------

_KEY = "CAST(strftime({}, '%Y%m%d%H%M') AS BIGINT)"
_TOKEN = "'_dbt_utils_surrogate_key_null_'"

STG_CATEGORY = f"""
stg_rsb AS (
  SELECT s.commercial_id, s.source_id, p.time_key, {", ".join(_names(c.CATEGORY_FIELDS))}, s.created_at
  FROM src_rsb s LEFT JOIN (SELECT DISTINCT source_id, {_KEY.format("observed_at")} AS time_key FROM src_commercial) p
    USING (source_id)
)"""

FACT_COMMERCIAL = f"""
fact_commercial AS (
  SELECT source_id AS fact_commercial_id, {_KEY.format("observed_at")} AS time_key,
    substring(congestion_level, 1, 20) AS congestion_level,
    {", ".join(n for n in _names(c.COMMERCIAL_FIELDS) if n != "congestion_level")}, area_id, created_at
  FROM src_commercial LEFT JOIN dim_area USING (area_code)
)"""

FACT_CATEGORY = """
fact_rsb AS (
  SELECT source_id AS fact_commercial_id, md5(commercial_id || '-' || source_id) AS fact_commercial_rsb_id,
    substring(category_congestion_level, 1, 20) AS category_congestion_level, category_payment_count,
    category_payment_min, category_payment_max, merchant_count, substring(merchant_basis_month, 1, 6) AS
    merchant_basis_month, category_id, time_key, created_at
  FROM stg_rsb LEFT JOIN dim_category USING (category_large, category_medium)
)"""

_POPULATION = [
    n
    for n in _names(c.POPULATION_FIELDS)
    if n not in ("area_name", "area_code", "congestion_label", "congestion_message")
]
FACT_POPULATION = f"""
fact_population AS (
  SELECT source_id AS fact_population_id, {", ".join(_POPULATION)}, {RUN} AS created_at, area_id, congestion_id,
    {_KEY.format("observed_at")} AS time_key, created_at AS source_created_at
  FROM src_population LEFT JOIN dim_congestion USING (congestion_label) LEFT JOIN dim_area USING (area_code)
)"""

_WEATHER = [f"{n} AS {marts.WEATHER_RENAMES.get(n, n)}" for n in _names(c.WEATHER_FIELDS)]
FACT_WEATHER = f"""
fact_weather AS (
  SELECT source_id AS fact_weather_id, {", ".join(_WEATHER)}, area_id, {RUN} AS created_at,
    {_KEY.format("observed_at")} AS time_key
  FROM src_weather LEFT JOIN dim_area USING (area_code)
)"""

EVENT_IDS = f"""
ids AS (
  SELECT *, md5(coalesce(event_name, {_TOKEN}) || '-' || coalesce(CAST(event_start_date AS VARCHAR), {_TOKEN}) || '-'
      || coalesce(CAST(event_end_date AS VARCHAR), {_TOKEN}) || '-' || coalesce(event_place, {_TOKEN}) || '-'
      || coalesce(CAST(CAST(event_x AS DECIMAL(18,7)) AS VARCHAR), {_TOKEN}) || '-'
      || coalesce(CAST(CAST(event_y AS DECIMAL(18,7)) AS VARCHAR), {_TOKEN}) || '-'
      || CASE WHEN is_paid THEN 'true' ELSE 'false' END || '-' || coalesce(thumbnail_url, {_TOKEN}) || '-'
      || coalesce(event_url, {_TOKEN}) || '-' || coalesce(event_extra_detail, {_TOKEN})) AS event_id
  FROM (SELECT *, TRY_CAST(trim(split_part(event_period, '~', 1)) AS DATE) AS event_start_date,
          TRY_CAST(nullif(trim(split_part(event_period, '~', 2)), '') AS DATE) AS event_end_date FROM src_event)
)"""

FACT_TRANSPORT = f"""
fact_transport AS (
  SELECT strftime(observed_at, '%Y%m%d%H%M') || '-' || area_code || '-' || transport_type AS fact_transport_id,
    transport_type, station_count_basis_month,
    {", ".join(n for n in _names(c.TRANSIT_STEMS) if n != "station_count_basis_month")},
    area_id, area_code, {_KEY.format("observed_at")} AS time_key, {RUN} AS created_at,
    created_at AS source_created_at
  FROM stg LEFT JOIN dim_area USING (area_code)
)"""


# --- staging ------------------------------------------------------------------------


@query(
    "d20_stg_bus",
    with_sql(TRANSIT_LOADS, select="SELECT * EXCLUDE (transport_type) FROM stg WHERE transport_type = 'bus'"),
)
def _(spark, sf):
    return marts.stg_transit(roles.transit_loads(spark, sf, c.BUS))


@query(
    "d20_stg_subway",
    with_sql(TRANSIT_LOADS, select="SELECT * EXCLUDE (transport_type) FROM stg WHERE transport_type = 'subway'"),
)
def _(spark, sf):
    return marts.stg_transit(roles.transit_loads(spark, sf, c.SUBWAY))


@query("d21_stg_commercial", with_sql(E, SOURCE_COMMERCIAL, select="SELECT * FROM src_commercial"))
def _(spark, sf):
    return marts.stg_commercial(source_commercial(spark, sf))


@query(
    "d22_stg_commercial_rsb",
    with_sql(E, SOURCE_COMMERCIAL, SOURCE_CATEGORY, STG_CATEGORY, select="SELECT * FROM stg_rsb"),
)
def _(spark, sf):
    return staged_categories(spark, sf)


@query(
    "d23_stg_event",
    with_sql(E, SOURCE_EVENT, select="SELECT * EXCLUDE (event_x, event_y), event_x AS longitude, event_y AS latitude "
             "FROM src_event"),
)
def _(spark, sf):
    return staged_events(spark, sf)


@query(
    "d24_stg_population",
    with_sql(E, SOURCE_POPULATION, select="SELECT * EXCLUDE (congestion_message) FROM src_population"),
)
def _(spark, sf):
    return marts.stg_population(source_population(spark, sf))


@query("d24_stg_weather", with_sql(E, SOURCE_WEATHER, select="SELECT * FROM src_weather"))
def _(spark, sf):
    return marts.stg_weather(source_weather(spark, sf))


# --- dimension and facts --------------------------------------------------------------


_DIM_SELECT = f"""SELECT event_id, any_value(event_name) AS event_name,
    any_value(event_start_date) AS event_start_date, any_value(event_end_date) AS event_end_date,
    any_value(event_place) AS event_place, any_value(event_x) AS longitude, any_value(event_y) AS latitude,
    bool_or(is_paid) AS is_paid, CAST(any_value(thumbnail_url) AS VARCHAR) AS thumbnail_url,
    any_value(event_url) AS event_url, any_value(event_extra_detail) AS event_extra_detail,
    {RUN} AS created_at, max(created_at) AS source_created_at FROM ids"""


@query("d30_dim_event", with_sql(E, SOURCE_EVENT, EVENT_IDS, select=f"{_DIM_SELECT} GROUP BY event_id"))
def _(spark, sf):
    return marts.dim_event(staged_events(spark, sf), RUN_TS)


@query(
    "d33_fact_event",
    with_sql(
        E, AREAS, SOURCE_EVENT, EVENT_IDS,
        select=f"""SELECT md5(event_id || '-' || area_id || '-' || strftime(observed_at, '%Y-%m-%d %H:%M:%S'))
            AS fact_event_id, max(event_period) AS event_period, {RUN} AS created_at, event_id, area_id, observed_at,
            max(created_at) AS source_created_at
            FROM ids JOIN dim_area USING (area_code) GROUP BY event_id, area_id, observed_at""",
    ),
)
def _(spark, sf):
    staged = staged_events(spark, sf)
    return marts.fact_event(staged, marts.dim_event(staged, RUN_TS), roles.areas(spark, sf), RUN_TS)


@query("d31_fact_commercial", with_sql(E, AREAS, SOURCE_COMMERCIAL, FACT_COMMERCIAL, select="SELECT * FROM fact_commercial"))
def _(spark, sf):
    return fact_commercial(spark, sf)


@query(
    "d32_fact_commercial_rsb",
    with_sql(
        E, CATEGORIES, SOURCE_COMMERCIAL, SOURCE_CATEGORY, STG_CATEGORY, FACT_CATEGORY, select="SELECT * FROM fact_rsb"
    ),
)
def _(spark, sf):
    return fact_category(spark, sf)


@query(
    "d34_fact_population",
    with_sql(E, AREAS, CONGESTIONS, SOURCE_POPULATION, FACT_POPULATION, select="SELECT * FROM fact_population"),
)
def _(spark, sf):
    return fact_population(spark, sf)


@query("d35_fact_transport", with_sql(TRANSIT_LOADS, AREAS, FACT_TRANSPORT, select="SELECT * FROM fact_transport"))
def _(spark, sf):
    return fact_transport(spark, sf)


@query("d36_fact_weather", with_sql(E, AREAS, SOURCE_WEATHER, FACT_WEATHER, select="SELECT * FROM fact_weather"))
def _(spark, sf):
    return fact_weather(spark, sf)


# --- incremental builds -----------------------------------------------------------------

_BUILT = dt.datetime(2024, 1, 20)


@query(
    "d36_fact_weather_increment",
    with_sql(
        E, AREAS, SOURCE_WEATHER, FACT_WEATHER,
        select="SELECT * FROM fact_weather WHERE time_key > CAST(strftime((SELECT max(date_trunc('day', ts)) FROM "
        f"events WHERE ts < TIMESTAMP '{_BUILT}') - INTERVAL 2 DAY, '%Y%m%d%H%M') AS BIGINT)",
    ),
)
def _(spark, sf):
    """Rows newer than the built fact, two days of lateness included."""
    staged = marts.stg_weather(source_weather(spark, sf))
    areas = roles.areas(spark, sf)
    built = marts.fact_weather(staged.where(F.col("observed_at") < clock.wall(_BUILT)), areas, RUN_TS)
    return marts.fact_weather(staged, areas, RUN_TS, built, lateness_minutes=2 * 24 * 60)


@query(
    "d35_fact_transport_increment",
    with_sql(
        TRANSIT_LOADS, AREAS, FACT_TRANSPORT,
        select="""SELECT * FROM fact_transport WHERE source_created_at >= (
            SELECT max(source_created_at) FROM fact_transport WHERE source_created_at < TIMESTAMP '2000-01-01')""",
    ),
)
def _(spark, sf):
    built = fact_transport(spark, sf).where(F.col("source_created_at") < clock.wall("2000-01-01"))
    staged = []
    for feed in (c.BUS, c.SUBWAY):
        loads = roles.transit_loads(spark, sf, feed)
        new = incremental.since_or_unknown(loads, built, F.col("created_at"), "source_created_at")
        staged.append(marts.stg_transit(new))
    return marts.fact_transport(*staged, roles.areas(spark, sf), RUN_TS, built)
