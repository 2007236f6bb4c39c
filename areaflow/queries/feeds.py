"""The feeds from JSON documents to source tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock
from areaflow.plans import feeds
from areaflow.queries import roles
from areaflow.queries.registry import RUN_TS, query


def _columns(table: str) -> str:
    return ", ".join(c.SOURCE_TABLES[table].names)


def _select(table: str, cte: str) -> str:
    return f"SELECT {_columns(table)} FROM {cte}"


_SEEN = """SELECT DISTINCT user_id AS area_id, date_trunc('minute', ts) AS observed_at
  FROM events WHERE event_type = 'purchase'"""


def _purchases(spark, sf):
    """Purchases as the processed history."""
    docs = roles.table(spark, sf, "events").where("event_type = 'purchase'")
    return docs.select(
        F.col("user_id").cast("int").alias("area_id"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("observed_at"),
    )


@query("d10_source_commercial", roles.with_sql(roles.E, roles.SOURCE_COMMERCIAL, select=_select("commercial", "src_commercial")))
def _(spark, sf):
    return feeds.commercial(roles.parsed_documents(spark, sf, c.COMMERCIAL), RUN_TS)


@query(
    "p1_commercial_unseen",
    roles.with_sql(
        roles.E,
        roles.SOURCE_COMMERCIAL,
        select=f"""SELECT source_id, total_payment_count, observed_at FROM src_commercial s WHERE NOT EXISTS (
            SELECT 1 FROM ({_SEEN}) h WHERE printf('POI%03d', h.area_id) = s.area_code
              AND h.observed_at = s.observed_at)""",
    ),
)
def _(spark, sf):
    fresh = feeds.commercial(roles.parsed_documents(spark, sf, c.COMMERCIAL), RUN_TS, _purchases(spark, sf))
    return fresh.select("source_id", "total_payment_count", "observed_at")


@query(
    "d11_source_commercial_rsb",
    roles.with_sql(roles.E, roles.SOURCE_CATEGORY, select=_select("commercial_rsb", "src_rsb")),
)
def _(spark, sf):
    return feeds.commercial_rsb(roles.parsed_documents(spark, sf, c.COMMERCIAL), RUN_TS)


@query(
    "p2_categories_outer",
    roles.with_sql(
        roles.E,
        roles.SOURCE_CATEGORY,
        select="""SELECT source_id, category_large, merchant_count FROM src_rsb UNION ALL
            SELECT DISTINCT md5(area_code || '_' || strftime(m, '%Y-%m-%d %H:%M:%S')), '', NULL FROM e
            WHERE event_type <> 'error' AND k % 4 = 0""",
    ),
)
def _(spark, sf):
    rows = feeds.commercial_rsb(roles.parsed_documents(spark, sf, c.COMMERCIAL), RUN_TS, outer=True)
    return rows.select("source_id", "category_large", "merchant_count")


@query("d12_source_population", roles.with_sql(roles.E, roles.SOURCE_POPULATION, select=_select("population", "src_population")))
def _(spark, sf):
    return feeds.population(roles.parsed_documents(spark, sf, c.POPULATION), RUN_TS)


@query(
    "p3_population_first_element",
    roles.with_sql(
        roles.E,
        select="""SELECT DISTINCT area_code, m AS observed_at FROM e WHERE event_type <> 'error'
            AND NOT EXISTS (SELECT 1 FROM e h WHERE h.event_type = 'purchase' AND h.area_code = e.area_code
              AND h.m = e.m)""",
    ),
)
def _(spark, sf):
    rows = feeds.population(roles.parsed_documents(spark, sf, c.POPULATION), RUN_TS, _purchases(spark, sf), first_only=True)
    return rows.select("area_code", "observed_at")


@query("d13_source_event", roles.with_sql(roles.E, roles.SOURCE_EVENT, select=_select("event", "src_event")))
def _(spark, sf):
    return feeds.event(roles.parsed_documents(spark, sf, c.EVENT), RUN_TS)


@query(
    "p4_event_fixed_date",
    roles.with_sql(
        roles.E,
        roles.SOURCE_EVENT,
        select="""SELECT area_code, event_name, event_x, is_paid, DATE '2024-02-01' AS day, count(*) AS n
            FROM src_event GROUP BY ALL""",
    ),
)
def _(spark, sf):
    rows = feeds.event(roles.parsed_documents(spark, sf, c.EVENT), RUN_TS, clock.wall(RUN_TS))
    keyed = rows.withColumn("day", F.to_date("observed_at"))
    return keyed.groupBy("area_code", "event_name", "event_x", "is_paid", "day").agg(F.count("*").alias("n"))


@query("d14_source_bus", roles.with_sql(roles.E, roles.SOURCE_BUS, select=_select("bus", "src_bus")))
def _(spark, sf):
    return feeds.transit(roles.parsed_documents(spark, sf, c.BUS.payload), c.BUS, RUN_TS)


@query("d14_source_subway", roles.with_sql(roles.E, roles.SOURCE_SUBWAY, select=_select("subway", "src_subway")))
def _(spark, sf):
    return feeds.transit(roles.parsed_documents(spark, sf, c.SUBWAY.payload), c.SUBWAY, RUN_TS)


@query("d15_source_weather", roles.with_sql(roles.E, roles.SOURCE_WEATHER, select=_select("weather", "src_weather")))
def _(spark, sf):
    return feeds.weather(roles.parsed_documents(spark, sf, c.WEATHER), RUN_TS)


@query(
    "p5_weather_first_element",
    roles.with_sql(
        roles.E, roles.SOURCE_WEATHER, select="SELECT source_id, humidity, air_quality_value FROM src_weather"
    ),
)
def _(spark, sf):
    rows = feeds.weather(roles.parsed_documents(spark, sf, c.WEATHER), RUN_TS, first_only=True)
    return rows.select("source_id", "humidity", "air_quality_value")
