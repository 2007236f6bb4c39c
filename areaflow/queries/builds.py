"""Stored facts brought up to date load by load: clocks out of order, keys and parents learned late, loads run again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow import session
from areaflow.functions import clock
from areaflow.plans import batches, serving
from areaflow.queries import dashboards, marts, roles
from areaflow.queries.registry import RUN_TS, query
from areaflow.queries.roles import (
    AREAS, CATEGORIES, CONGESTIONS, RUN, SOURCE_CATEGORY, SOURCE_COMMERCIAL, SOURCE_EVENT, SOURCE_POPULATION,
    SOURCE_WEATHER, E, with_sql,
)
from areaflow.sources import ledger, sinks
from areaflow.sources.tables import Warehouse

_LATER = RUN_TS + dt.timedelta(hours=1)
_SINGLE = "QUALIFY count(*) OVER (PARTITION BY {}) = 1"
_HALF = dt.datetime(2024, 1, 16)


def _warehouse(spark, sf, **dims) -> Warehouse:
    """A new warehouse with the dimensions, or what a query puts in place of one."""
    wh = Warehouse(spark, session.scratch(spark, "warehouse"))
    known = {"area": roles.areas, "category": roles.categories, "congestion": roles.congestions}
    for name, make in known.items():
        sinks.replace_prefix(dims.get(name) or make(spark, sf), wh.path("dim", name))
    return wh


def _stored(wh: Warehouse, fact: str):
    return wh.existing("fact", fact).drop(sinks.DATE)


def _single(rows, key: str):
    """Rows whose key no other row has: loads hold one document of an observation, the events at times two."""
    return rows.join(rows.groupBy(key).count().where("count = 1"), key, "left_semi").select(*rows.columns)


def _halves(rows):
    first = F.col("observed_at") < clock.wall(_HALF)
    return rows.where(first), rows.where(~first)


@query(
    "f7_earlier_clock_second",
    with_sql(
        E, AREAS, SOURCE_COMMERCIAL, marts.FACT_COMMERCIAL,
        select=f"""SELECT * REPLACE (CASE WHEN time_key < 202401160000 THEN TIMESTAMP '{_LATER}' ELSE {RUN} END AS created_at)
            FROM fact_commercial {_SINGLE.format("fact_commercial_id")}""",
    ),
)
def _(spark, sf):
    """The load that is stored and built second carries the earlier clock."""
    wh = _warehouse(spark, sf)
    first, second = _halves(_single(marts.source_commercial(spark, sf), "source_id"))
    batches.store_load(wh, "commercial", first.withColumn("created_at", clock.wall(_LATER)), "later-clock")
    batches.build_marts(wh, _LATER, facts=["commercial"])
    batches.store_load(wh, "commercial", second, "earlier-clock")
    batches.build_marts(wh, _LATER, facts=["commercial"])
    return _stored(wh, "commercial")


@query(
    "m5_load_run_again",
    with_sql(
        E, AREAS, SOURCE_COMMERCIAL, marts.FACT_COMMERCIAL,
        select=f"""SELECT * FROM (SELECT * FROM fact_commercial {_SINGLE.format("fact_commercial_id")})
            WHERE time_key >= 202401160000 OR congestion_level <> 'click'""",
    ),
)
def _(spark, sf):
    """A built load runs again and has lost rows; the fact loses them, and those of other loads on its dates stay."""
    wh = _warehouse(spark, sf)
    first, second = _halves(_single(marts.source_commercial(spark, sf), "source_id"))
    batches.store_load(wh, "commercial", first, "first")
    batches.store_load(wh, "commercial", second, "second")
    batches.build_marts(wh, RUN_TS, facts=["commercial"])
    batches.store_load(wh, "commercial", first.where("congestion_level <> 'click'"), "first")
    batches.build_marts(wh, RUN_TS, facts=["commercial"])
    return _stored(wh, "commercial")


@query(
    "d33_same_clock",
    with_sql(
        E, AREAS, SOURCE_EVENT, marts.EVENT_IDS,
        select=f"""SELECT md5(event_id || '-' || area_id || '-' || strftime(observed_at, '%Y-%m-%d %H:%M:%S'))
            AS fact_event_id, max(event_period) AS event_period, {RUN} AS created_at, event_id, area_id, observed_at,
            max(created_at) AS source_created_at
            FROM ids JOIN dim_area USING (area_code) GROUP BY event_id, area_id, observed_at""",
    ),
)
def _(spark, sf):
    """Two loads of events with one clock, the second after the dimension and the fact were built."""
    wh = _warehouse(spark, sf)
    typed, _ = session.staged(marts.feeds.event(roles.documents(spark, sf), RUN_TS), "events")
    rows = typed.withColumn(sinks.DATE, F.to_date("observed_at"))
    for name, part in zip(("first", "second"), _halves(rows), strict=True):
        sinks.write_partitions(part, wh.path("source", "event"), [sinks.DATE])
        ledger.record(wh, "event", name, [row[0] for row in part.select(sinks.DATE).distinct().collect()])
        batches.build_event_marts(wh, RUN_TS)
    return _stored(wh, "event")


@query(
    "j1_area_learned_later",
    with_sql(
        E, AREAS, CONGESTIONS, SOURCE_POPULATION, marts.FACT_POPULATION, select="SELECT * FROM fact_population",
    ),
)
def _(spark, sf):
    """Most areas and a label are unknown when the fact is built; they are repaired once the dimensions have them."""
    areas, labels = roles.areas(spark, sf), roles.congestions(spark, sf)
    wh = _warehouse(spark, sf, area=areas.where("area_id % 3 = 0"), congestion=labels.where("congestion_label <> 'click'"))
    batches.store_load(wh, "population", marts.source_population(spark, sf), "one")
    batches.build_marts(wh, RUN_TS, facts=["population"])
    sinks.replace_prefix(areas, wh.path("dim", "area"))
    batches.build_marts(wh, RUN_TS, facts=["population"])
    sinks.replace_prefix(labels, wh.path("dim", "congestion"))
    batches.build_marts(wh, RUN_TS, facts=["population"])
    return _stored(wh, "population")


@query(
    "j5_parent_arrives_later",
    with_sql(
        E, CATEGORIES, SOURCE_COMMERCIAL, SOURCE_CATEGORY, marts.STG_CATEGORY, marts.FACT_CATEGORY,
        select=f"SELECT * FROM fact_rsb {_SINGLE.format('fact_commercial_rsb_id')}",
    ),
)
def _(spark, sf):
    """Categories are built before the observations they belong to; these arrive in two loads."""
    wh = _warehouse(spark, sf)
    docs = roles.documents(spark, sf)
    categories, _ = session.staged(marts.source_category(spark, sf, docs), "categories")
    parents, _ = session.staged(marts.source_commercial(spark, sf, docs), "parents")
    batches.store_load(wh, "commercial_rsb", _single(categories, "commercial_id"), "categories")
    batches.build_marts(wh, RUN_TS, facts=["commercial_rsb"])
    for name, part in zip(("first", "second"), _halves(parents), strict=True):
        batches.store_load(wh, "commercial", part, name)
        batches.build_marts(wh, RUN_TS, facts=["commercial_rsb"])
    return _stored(wh, "commercial_rsb")


def _latest(feed: str, columns: str) -> str:
    single = f"(SELECT * FROM fact_{feed} {_SINGLE.format(f'fact_{feed}_id')})"
    return dashboards._latest(single, f"fact_{feed}_id", f"time_key AS {feed}_time_key, {columns}")


@query(
    "d50_latest_state",
    with_sql(
        E, AREAS, CONGESTIONS, SOURCE_COMMERCIAL, marts.FACT_COMMERCIAL, SOURCE_POPULATION, marts.FACT_POPULATION,
        SOURCE_WEATHER, marts.FACT_WEATHER,
        select=f"""SELECT * FROM {_latest("commercial", "congestion_level, total_payment_count")}
            FULL JOIN {_latest("population", "congestion_id, population_min, population_max")} USING (area_id)
            FULL JOIN {_latest("weather", "temperature, pm10_value, air_quality_value")} USING (area_id)""",
    ),
)
def _(spark, sf):
    """The newest row of every area from the state that two loads' builds kept, the newer load built first."""
    wh = _warehouse(spark, sf)
    docs = roles.documents(spark, sf)
    feeds = {"commercial": marts.source_commercial, "population": marts.source_population, "weather": marts.source_weather}
    kept = {name: session.staged(_single(make(spark, sf, docs), "source_id"), name)[0] for name, make in feeds.items()}
    halves = {name: _halves(rows) for name, rows in kept.items()}
    for load in (1, 0):
        for name, parts in halves.items():
            if name == "weather":
                days = sinks.upsert(parts[load].withColumn(sinks.DATE, F.to_date("observed_at")), wh.path("source", name), ["source_id"])
                ledger.record(wh, name, f"load {load}", days)
            else:
                batches.store_load(wh, name, parts[load], f"load {load}")
        batches.build_marts(wh, RUN_TS, facts=list(feeds))
    return serving.latest_state(wh)


@query("d51_weekly_partials", dashboards._WEEKLY_SQL)
def _(spark, sf):
    """A week merged from the hours that two loads' builds kept."""
    wh = _warehouse(spark, sf)
    for name, part in zip(("first", "second"), _halves(marts.source_population(spark, sf)), strict=True):
        batches.store_load(wh, "population", part, name)
        batches.build_marts(wh, RUN_TS, facts=["population"])
    return serving.weekly_stats(wh, dashboards._WEEK)


def _of_one(feed: str) -> str:
    return f"(SELECT * FROM fact_{feed} {_SINGLE.format(f'fact_{feed}_id')})"


@query(
    "d52_bucketed_facts",
    dashboards._insight_sql(
        _of_one("commercial"), _of_one("population"), "time_key >= 202401080000 AND time_key < 202401290000"
    ),
)
def _(spark, sf):
    """Three weeks of both facts side by side from their buckets; the second load's dates were added by its build."""
    wh = _warehouse(spark, sf)
    docs = roles.documents(spark, sf)
    feeds = {"commercial": marts.source_commercial, "population": marts.source_population}
    kept = {name: session.staged(_single(make(spark, sf, docs), "source_id"), name)[0] for name, make in feeds.items()}
    for load in (0, 1):
        for name, rows in kept.items():
            batches.store_load(wh, name, _halves(rows)[load], f"load {load}")
        batches.build_marts(wh, RUN_TS, facts=list(feeds))
        if load == 0:
            serving.keep_insight(wh, 8)
    return serving.insight(wh, dt.date(2024, 1, 8), dt.date(2024, 1, 29), *dashboards._insight_view())
