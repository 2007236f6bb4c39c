"""Dashboard reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow.operators import conform
from areaflow.plans import dashboards
from areaflow.queries import marts
from areaflow.queries.registry import query, table
from areaflow.queries.roles import (
    AREAS, CATEGORIES, CONGESTIONS, SOURCE_CATEGORY, SOURCE_COMMERCIAL, SOURCE_POPULATION, SOURCE_WEATHER, E, documents,
    with_sql,
)

_COMMERCIAL = (E, AREAS, SOURCE_COMMERCIAL, marts.FACT_COMMERCIAL)
_CATEGORY = (E, CATEGORIES, SOURCE_COMMERCIAL, SOURCE_CATEGORY, marts.STG_CATEGORY, marts.FACT_CATEGORY)


def _shown(names: dict[str, str]) -> str:
    return ", ".join(f'{k} AS "{v}"' for k, v in names.items())


@query("o1_topk_one_key", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 10")
def _(spark, sf):
    return dashboards.top_k(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], ["o_orderkey"])


@query(
    "o2_topk_two_keys",
    "SELECT p_partkey, p_brand, p_size FROM part ORDER BY p_brand, p_size, p_partkey LIMIT 10",
)
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return dashboards.top_k(parts, ["p_brand", "p_size"], ["p_partkey"])


@query(
    "o3_sorted_keys",
    """SELECT strftime(ts, '%Y%m%d/%H%M') || '_' || CAST(user_id AS VARCHAR) AS path FROM events ORDER BY path""",
)
def _(spark, sf):
    path = F.concat(F.date_format("ts", "yyyyMMdd/HHmm"), F.lit("_"), F.col("user_id").cast("string"))
    return table(spark, sf, "events").select(path.alias("path")).orderBy("path")


@query(
    "d40_fact_commercial_view",
    with_sql(
        *_COMMERCIAL,
        select=f"""SELECT {_shown(dashboards.FACT_COMMERCIAL_NAMES)} FROM (SELECT * FROM fact_commercial
            ORDER BY area_id NULLS LAST, time_key, fact_commercial_id LIMIT 10)""",
    ),
)
def _(spark, sf):
    return dashboards.fact_commercial_view(marts.fact_commercial(spark, sf))


@query(
    "d41_fact_category_view",
    with_sql(
        *_CATEGORY,
        select=f"""SELECT {_shown(dashboards.FACT_CATEGORY_NAMES)} FROM (SELECT * FROM fact_rsb
            ORDER BY category_id NULLS LAST, time_key, fact_commercial_id, fact_commercial_rsb_id LIMIT 10)""",
    ),
)
def _(spark, sf):
    return dashboards.fact_category_view(marts.fact_category(spark, sf))


@query(
    "d42_source_commercial_view",
    with_sql(
        E, SOURCE_COMMERCIAL,
        select=f"""SELECT {_shown(dashboards.SOURCE_COMMERCIAL_NAMES)} FROM (SELECT * FROM src_commercial
            ORDER BY area_name, observed_at, source_id LIMIT 10)""",
    ),
)
def _(spark, sf):
    return dashboards.source_commercial_view(marts.source_commercial(spark, sf))


@query(
    "d43_source_category_view",
    with_sql(
        E, SOURCE_CATEGORY,
        select=f"""SELECT {_shown(dashboards.SOURCE_CATEGORY_NAMES)} FROM (SELECT * FROM src_rsb
            ORDER BY category_large, observed_at, category_medium, commercial_id LIMIT 10)""",
    ),
)
def _(spark, sf):
    return dashboards.source_category_view(marts.source_category(spark, sf))


_WEEK = dt.datetime(2024, 1, 24)


def _latest(fact: str, key: str, columns: str) -> str:
    return f"""(SELECT area_id, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY area_id
      ORDER BY time_key DESC, {key}) AS rn FROM {fact} WHERE area_id IS NOT NULL) WHERE rn = 1)"""


@query(
    "d50_latest_snapshot",
    with_sql(
        *_COMMERCIAL, CONGESTIONS, SOURCE_POPULATION, marts.FACT_POPULATION, SOURCE_WEATHER, marts.FACT_WEATHER,
        select=f"""SELECT * FROM
          {_latest("fact_commercial", "fact_commercial_id", '''time_key AS commercial_time_key, congestion_level,
            total_payment_count''')}
          FULL JOIN {_latest("fact_population", "fact_population_id", '''time_key AS population_time_key,
            congestion_id, population_min, population_max''')} USING (area_id)
          FULL JOIN {_latest("fact_weather", "fact_weather_id", '''time_key AS weather_time_key, temperature,
            pm10_value, air_quality_value''')} USING (area_id)""",
    ),
)
def _(spark, sf):
    docs = documents(spark, sf)
    facts = (build(spark, sf, docs) for build in (marts.fact_commercial, marts.fact_population, marts.fact_weather))
    return dashboards.latest_snapshot(*facts)


_WEEKLY_SQL = with_sql(
    E, AREAS, CONGESTIONS, SOURCE_POPULATION, marts.FACT_POPULATION,
    select="""SELECT area_id, CAST(isodow(minute_at) AS INTEGER) AS weekday, CAST(hour(minute_at) AS INTEGER) AS hour,
        count(*) AS observations, min(population_min) AS population_min, max(population_max) AS population_max,
        CAST(sum(population_min + population_max) AS DOUBLE) / 2 / count(*) AS population_avg
        FROM (SELECT *, strptime(CAST(time_key AS VARCHAR), '%Y%m%d%H%M') AS minute_at FROM fact_population)
        WHERE minute_at >= TIMESTAMP '2024-01-15' AND minute_at < TIMESTAMP '2024-01-22' AND area_id IS NOT NULL
        GROUP BY ALL""",
)


@query("d51_weekly_stats", _WEEKLY_SQL)
def _(spark, sf):
    return dashboards.weekly_stats(marts.fact_population(spark, sf), _WEEK)


_INSIGHT = {**dashboards._PAYMENT_NAMES, **dashboards._RATIO_NAMES}


def _insight_sql(commercial: str = "fact_commercial", population: str = "fact_population", also: str = "TRUE") -> str:
    return with_sql(
        *_COMMERCIAL, CONGESTIONS, SOURCE_POPULATION, marts.FACT_POPULATION,
        select=f"""SELECT area_id, time_key, {", ".join(f"c.{n}" for n in _INSIGHT)}, congestion_id, population_min,
            population_max, resident_ratio, non_resident_ratio
            FROM {commercial} c JOIN {population} p USING (area_id, time_key)
            WHERE c.male_ratio >= 20 AND p.population_max > 300 AND p.resident_ratio < 90 AND {also}
            ORDER BY population_max DESC, area_id, time_key""",
    )


def _insight_view():
    """Conditions and order, as a user of the view may set them."""
    conditions = [F.col("male_ratio") >= 20, F.col("population_max") > 300, F.col("resident_ratio") < 90]
    return conditions, [F.col("population_max").desc(), F.col("area_id").asc(), F.col("time_key").asc()]


@query("d52_insight", _insight_sql())
def _(spark, sf):
    conditions, order = _insight_view()
    docs = documents(spark, sf)
    facts = (build(spark, sf, docs) for build in (marts.fact_commercial, marts.fact_population))
    return dashboards.insight(*facts, conditions, order)


@query(
    "p16_category_display",
    with_sql(E, SOURCE_CATEGORY, select=f"SELECT {_shown(dashboards.SOURCE_CATEGORY_NAMES)} FROM src_rsb"),
)
def _(spark, sf):
    return conform.display(marts.source_category(spark, sf), dashboards.SOURCE_CATEGORY_NAMES)
