"""Loads through real tables: each query writes to scratch and reads back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow import session
from areaflow.functions import clock
from areaflow.operators import conform, history
from areaflow.plans import feeds, marts
from areaflow.queries import roles
from areaflow.queries.registry import RUN_TS, query, table
from areaflow.sources import sinks


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


def _dated(df, ts):
    return df.withColumn(sinks.DATE, F.to_date(ts))


_ALL = "SELECT event_id, ts, user_id, event_type FROM events"


@query("k1_stamped_batch_file", _ALL)
def _(spark, sf):
    path = sinks.write_batch(_events(spark, sf), session.scratch(spark, "batches"), RUN_TS)
    return spark.read.parquet(path)


@query("k2_directory_overwrite", _ALL)
def _(spark, sf):
    path = session.scratch(spark, "overwrite")
    sinks.replace_prefix(_events(spark, sf).where("event_type = 'view'"), path)
    sinks.replace_prefix(_events(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "k3_partitioned_overwrite",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' THEN 2 ELSE 1 END AS load,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         CAST(hour(ts) AS INTEGER) AS hour FROM events""",
)
def _(spark, sf):
    """A second load replaces only the hours it holds."""
    path = session.scratch(spark, "partitioned")
    by = ["year", "month", "day", "hour"]
    rows = conform.with_date_parts(_events(spark, sf), "ts").select("event_id", "ts", *by)
    sinks.write_partitions(rows.drop("ts").withColumn("load", F.lit(1)), path, by)
    again = (F.col("ts") >= clock.wall("2024-01-10")) & (F.col("ts") < clock.wall("2024-01-12"))
    sinks.write_partitions(rows.where(again).drop("ts").withColumn("load", F.lit(2)), path, by)
    return spark.read.parquet(path)


@query("k4_idempotent_prefix", _ALL)
def _(spark, sf):
    """Loading the same window twice leaves it once."""
    path = session.scratch(spark, "prefix")
    for _run in range(2):
        sinks.replace_prefix(_events(spark, sf), f"{path}/window")
    return spark.read.parquet(f"{path}/window")


@query("k5_append_columns", "SELECT event_id, user_id FROM events UNION ALL SELECT o_orderkey, o_custkey FROM orders")
def _(spark, sf):
    path = session.scratch(spark, "append")
    orders = table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "event_id", "o_custkey": "user_id"})
    sinks.append(_events(spark, sf), path, ["event_id", "user_id"])
    sinks.append(orders, path, ["event_id", "user_id"])
    return spark.read.parquet(path)


@query("k6_append_positional", "SELECT event_id, user_id FROM events UNION ALL SELECT o_orderkey, o_custkey FROM orders")
def _(spark, sf):
    """Columns meet by place, not by name."""
    path = session.scratch(spark, "positional")
    events = _events(spark, sf).select("event_id", "user_id")
    sinks.append_positional(events, path, events.schema)
    sinks.append_positional(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), path, events.schema)
    return spark.read.parquet(path)


@query(
    "k7_replace_range_table",
    """SELECT event_id, event_type, 'first' AS load FROM events
         WHERE NOT (ts >= TIMESTAMP '2024-01-05 12:00:00' AND ts < TIMESTAMP '2024-01-09 12:00:00')
       UNION ALL SELECT event_id, event_type, 'second' FROM events
         WHERE ts >= TIMESTAMP '2024-01-05 12:00:00' AND ts < TIMESTAMP '2024-01-09 12:00:00'
           AND CAST(ts AS DATE) <> DATE '2024-01-07'""",
)
def _(spark, sf):
    """The reload has nothing for one whole day, whose partition has to go."""
    path = session.scratch(spark, "range")
    low, high = dt.datetime(2024, 1, 5, 12), dt.datetime(2024, 1, 9, 12)
    rows = _dated(_events(spark, sf), "ts")
    sinks.write_partitions(rows.withColumn("load", F.lit("first")), path, [sinks.DATE])
    in_range = (F.col("ts") >= clock.wall(low)) & (F.col("ts") < clock.wall(high))
    reload = rows.where(in_range & (F.col(sinks.DATE) != F.lit(dt.date(2024, 1, 7))))
    sinks.replace_range(reload.withColumn("load", F.lit("second")), path, "ts", low, high, closed=False)
    return spark.read.parquet(path).select("event_id", "event_type", "load")


@query(
    "k8_replace_day_table",
    """SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-08' THEN 'second' ELSE 'first' END AS load
       FROM events""",
)
def _(spark, sf):
    path = session.scratch(spark, "day")
    day = clock.truncated(F.col("ts"), "day")
    rows = _dated(_events(spark, sf), "ts").withColumn("observed_at", day)
    sinks.write_partitions(rows.withColumn("load", F.lit("first")), path, [sinks.DATE])
    value = dt.datetime(2024, 1, 8)
    reload = rows.where(F.col("observed_at") == clock.wall(value)).withColumn("load", F.lit("second"))
    sinks.replace_key(reload, path, "observed_at", value)
    return spark.read.parquet(path).select("event_id", "load")


@query("k9_insert_once_table", "SELECT event_id, 'first' AS load FROM events")
def _(spark, sf):
    """The second load of a loaded day is skipped."""
    path = session.scratch(spark, "once")
    rows = _dated(_events(spark, sf), "ts").withColumn("observed_at", clock.truncated(F.col("ts"), "day"))
    sinks.append(rows.withColumn("load", F.lit("first")), path, by=[sinks.DATE])
    value = dt.datetime(2024, 1, 8)
    day = rows.where(F.col("observed_at") == clock.wall(value)).withColumn("load", F.lit("second"))
    sinks.insert_if_absent(day, path, "observed_at", value)
    return spark.read.parquet(path).select("event_id", "load")


@query("k11_empty_batch_guard", "SELECT event_id, TRUE AS first_load, FALSE AS empty_load FROM events")
def _(spark, sf):
    path = session.scratch(spark, "guard")
    rows = _events(spark, sf).select("event_id")
    first = sinks.append_unless_empty(rows, path)
    empty = sinks.append_unless_empty(rows.where("event_id is null"), path)
    return spark.read.parquet(path).withColumns({"first_load": F.lit(first), "empty_load": F.lit(empty)})


@query("k12_empty_with_schema", "SELECT event_id, ts, user_id, event_type FROM events")
def _(spark, sf):
    """A feed without valid rows still leaves a readable batch."""
    root = session.scratch(spark, "empty")
    rows = _events(spark, sf)
    empty = sinks.write_batch(rows.where("event_id is null"), root, RUN_TS)
    full = sinks.write_batch(rows, root, RUN_TS + dt.timedelta(minutes=5))
    return spark.read.parquet(empty).unionByName(spark.read.parquet(full))


@query(
    "k13_history_export",
    """SELECT DISTINCT CAST(user_id AS INTEGER) AS area_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS observed_at
       FROM events""",
)
def _(spark, sf):
    """History exported as JSON maps and read back."""
    path = session.scratch(spark, "history")
    seen = _dated(_events(spark, sf), "ts").select(
        F.col("user_id").cast("int").alias("area_id"), F.col("ts").alias("observed_at"),
        clock.wall(RUN_TS).alias("processed_at"), sinks.DATE,
    )
    sinks.write_history_documents(seen, path)
    return history.read_documents(spark, path).select("area_id", "observed_at")


@query(
    "k14_type_routed_output",
    roles.with_sql(
        roles.E, roles.SOURCE_BUS, roles.SOURCE_SUBWAY,
        select="""SELECT source_id, station_count, 'bus' AS transport_type, CAST(observed_at AS DATE) AS ymd FROM src_bus
            UNION ALL SELECT source_id, station_count, 'subway', CAST(observed_at AS DATE) FROM src_subway""",
    ),
)
def _(spark, sf):
    path = session.scratch(spark, "transport")
    docs = roles.documents(spark, sf)
    for feed in (c.BUS, c.SUBWAY):
        rows = feeds.transit(docs, feed, RUN_TS).withColumn("transport_type", F.lit(feed.label))
        sinks.append(rows.withColumn("ymd", F.to_date("observed_at")), path, by=["transport_type", "ymd"])
    return spark.read.parquet(path).select("source_id", "station_count", "transport_type", "ymd")


@query(
    "m1_upsert_table",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'clicked' ELSE event_type END AS event_type,
         CAST(ts AS DATE) AS observed_date FROM events""",
)
def _(spark, sf):
    """A table of early events, then two overlapping batches merged by key."""
    path = session.scratch(spark, "upsert")
    rows = _dated(_events(spark, sf), "ts").select("event_id", "event_type", "ts", sinks.DATE)
    early = rows.where(F.col("ts") < clock.wall("2024-01-20")).drop("ts")
    sinks.write_partitions(early, path, [sinks.DATE])
    late = rows.where(F.col("ts") >= clock.wall("2024-01-10")).drop("ts")
    sinks.upsert(late, path, ["event_id"])
    clicks = rows.where("event_type = 'click'").drop("ts").withColumn("event_type", F.lit("clicked"))
    sinks.upsert(clicks, path, ["event_id"])
    return spark.read.parquet(path)


@query(
    "m3_insert_only_table",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'first' ELSE 'second' END AS load,
         CASE WHEN event_type <> 'view' THEN user_id END AS user_id FROM events""",
)
def _(spark, sf):
    """The second load brings a new column and leaves loaded rows alone."""
    path = session.scratch(spark, "insert")
    rows = _events(spark, sf)
    first = rows.where("event_type = 'view'").select("event_id", F.lit("first").alias("load"))
    sinks.insert_only(first, path, ["event_id"])
    sinks.insert_only(rows.select("event_id", F.lit("second").alias("load"), "user_id"), path, ["event_id"])
    return spark.read.option("mergeSchema", True).parquet(path)


@query(
    "d35_fact_transport_table",
    roles.with_sql(
        roles.TRANSIT_LOADS,
        select="""SELECT strftime(observed_at, '%Y%m%d%H%M') || '-' || area_code || '-' || transport_type
            AS fact_transport_id, station_count, created_at AS source_created_at FROM stg""",
    ),
)
def _(spark, sf):
    """The fact built from old loads and then merged with the newer ones."""
    path = session.scratch(spark, "fact-transport")
    staged = [marts.stg_transit(roles.transit_loads(spark, sf, feed)) for feed in (c.BUS, c.SUBWAY)]
    # one calendar quarter per partition keeps the folders few for minutes over decades
    quarter = F.to_date(F.date_trunc("quarter", F.try_to_timestamp(F.col("time_key").cast("string"), F.lit("yyyyMMddHHmm"))))
    areas = roles.areas(spark, sf)
    fact = marts.fact_transport(*staged, areas, RUN_TS).withColumn(sinks.DATE, quarter)
    sinks.write_partitions(fact.where("source_created_at < timestamp_ntz'1999-01-01 00:00:00'"), path, [sinks.DATE])
    built = spark.read.parquet(path)
    increment = marts.fact_transport(*staged, areas, RUN_TS, built).withColumn(sinks.DATE, quarter)
    sinks.upsert(increment, path, ["fact_transport_id"])
    return spark.read.parquet(path).select("fact_transport_id", "station_count", "source_created_at")
