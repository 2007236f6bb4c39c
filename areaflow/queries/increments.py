"""Increment filters, merges and replacement loads described as frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.operators import incremental, lookup
from areaflow.queries.registry import query, table

# Orders before the cut are the built table, the whole table is the batch.
_CUT = dt.datetime(1999, 1, 1)
_OLD = f"o_orderdate < TIMESTAMP '{_CUT}'"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


def _split(spark, sf):
    orders = _orders(spark, sf)
    old = F.col("o_orderdate") < clock.wall(_CUT)
    return orders.where(old), orders


def _corrected(orders):
    """Orders reloaded with another status: high priorities and everything new."""
    changed = (F.col("o_orderpriority") == "2-HIGH") | (F.col("o_orderdate") >= clock.wall(_CUT))
    return orders.where(changed).withColumn("o_orderstatus", F.lit("X"))


_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority"
_CHANGED = f"(o_orderpriority = '2-HIGH' OR NOT {_OLD})"


@query("f7_since_ingest_time", f"SELECT {_COLUMNS} FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE {_OLD})")
def _(spark, sf):
    target, batch = _split(spark, sf)
    return incremental.since(batch, target, F.col("o_orderdate"), "o_orderdate")


@query("f7_same_clock", f"SELECT {_COLUMNS} FROM orders WHERE {_OLD}")
def _(spark, sf):
    """Two loads share the newest clock; the second, built after the first, still arrives."""
    target, _batch = _split(spark, sf)
    newest = F.col("o_orderdate") == clock.wall(_CUT - dt.timedelta(days=1))
    second = newest & (F.col("o_orderstatus") == "F")
    built = target.where(~second)
    return incremental.upsert(built, incremental.from_mark(target, built, F.col("o_orderdate"), "o_orderdate"), ["o_orderkey"])


@query(
    "m1_newest_version_stays",
    f"""SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '2-HIGH' THEN 3 ELSE 2 END AS version
        FROM orders""",
)
def _(spark, sf):
    """A batch with a newer version of some rows and an older one of all."""
    stored = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.lit(2).alias("version"))
    newer = stored.where("o_orderpriority = '2-HIGH'").withColumn("version", F.lit(3))
    batch = newer.unionByName(stored.withColumn("version", F.lit(1)))
    return incremental.upsert_newest(stored, batch, ["o_orderkey"], "version")


@query(
    "f8_since_event_time",
    f"""SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d%H%M') AS BIGINT) >
        (SELECT max(CAST(strftime(o_orderdate, '%Y%m%d%H%M') AS BIGINT)) FROM orders WHERE {_OLD})""",
)
def _(spark, sf):
    target, batch = _split(spark, sf)
    built = target.select(clock.time_key(F.col("o_orderdate")).alias("time_key"))
    return incremental.since_event_time(batch.select("o_orderkey", "o_orderdate"), built, "o_orderdate")


@query(
    "b6_late_rows_within_a_day",
    f"""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate + INTERVAL 3 DAY >
        (SELECT max(o_orderdate) FROM orders WHERE {_OLD})""",
)
def _(spark, sf):
    target, batch = _split(spark, sf)
    built = target.select(clock.time_key(F.col("o_orderdate")).alias("time_key"))
    rows = batch.select("o_orderkey", "o_orderdate")
    return incremental.since_event_time(rows, built, "o_orderdate", lateness_minutes=3 * 24 * 60)


@query("f13_empty_target_has_no_bound", f"SELECT {_COLUMNS} FROM orders")
def _(spark, sf):
    orders = _orders(spark, sf)
    return incremental.since(orders, orders.where(F.col("o_orderkey") < 0), F.col("o_orderdate"), "o_orderdate")


@query(
    "m1_upsert",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
          o_orderdate, o_orderpriority FROM orders""",
)
def _(spark, sf):
    target, batch = _split(spark, sf)
    return incremental.upsert(target, _corrected(batch), ["o_orderkey"])


@query(
    "m2_upsert_composite",
    """SELECT o_custkey, o_orderdate, max(source) AS source, count(*) AS n FROM (
         SELECT o_custkey, o_orderdate, 'batch' AS source FROM orders WHERE o_orderstatus = 'F'
         UNION ALL
         SELECT o_custkey, o_orderdate, 'target' FROM orders o WHERE o_orderstatus <> 'F' AND NOT EXISTS (
           SELECT 1 FROM orders b WHERE b.o_orderstatus = 'F' AND b.o_custkey = o.o_custkey
             AND b.o_orderdate = o.o_orderdate))
       GROUP BY o_custkey, o_orderdate""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    target = orders.where(~finished).withColumn("source", F.lit("target"))
    batch = orders.where(finished).withColumn("source", F.lit("batch"))
    merged = incremental.upsert(target, batch, ["o_custkey", "o_orderdate"])
    return merged.groupBy("o_custkey", "o_orderdate").agg(F.max("source").alias("source"), F.count("*").alias("n"))


@query(
    "m1_null_keys_stay",
    """SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS row_id,
         count(*) AS n FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P')
       GROUP BY 1""",
)
def _(spark, sf):
    """Pending orders have no key: both sides keep them, all others are replaced."""
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    rows = table(spark, sf, "orders").select(key.alias("row_id"), "o_orderdate")
    merged = incremental.upsert(rows, rows, ["row_id"])
    return merged.groupBy("row_id").agg(F.count("*").alias("n"))


@query("m3_insert_only", f"SELECT {_COLUMNS.replace('o_orderstatus', f'CASE WHEN {_OLD} THEN o_orderstatus ELSE {chr(39)}X{chr(39)} END AS o_orderstatus')} FROM orders")
def _(spark, sf):
    target, batch = _split(spark, sf)
    return incremental.insert_only(target, _corrected(batch), ["o_orderkey"])


@query(
    "m4_append_new_columns",
    f"""SELECT {_COLUMNS}, CASE WHEN NOT {_OLD} THEN o_totalprice END AS o_totalprice FROM orders""",
)
def _(spark, sf):
    target, _ = _split(spark, sf)
    return incremental.insert_only(target, table(spark, sf, "orders"), ["o_orderkey"])


@query(
    "m5_full_or_incremental",
    f"""SELECT 'full' AS build, count(*) AS n FROM orders
        UNION ALL SELECT 'incremental', count(*) FROM orders WHERE NOT {_OLD}""",
)
def _(spark, sf):
    target, batch = _split(spark, sf)
    builds = [
        incremental.since(batch, built, F.col("o_orderdate"), "o_orderdate").select(F.lit(name).alias("build"))
        for name, built in (("full", None), ("incremental", target))
    ]
    return builds[0].unionByName(builds[1]).groupBy("build").agg(F.count("*").alias("n"))


@query(
    "m6_duplicate_source_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf):
    return lookup.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


_LOW, _HIGH = dt.datetime(1997, 3, 1), dt.datetime(1998, 6, 30)
_BETWEEN = f"o_orderdate BETWEEN TIMESTAMP '{_LOW}' AND TIMESTAMP '{_HIGH}'"


@query(
    "k7_replace_range",
    f"""SELECT o_orderkey, 'target' AS source FROM orders WHERE NOT {_BETWEEN}
        UNION ALL SELECT o_orderkey, 'batch' FROM orders WHERE {_BETWEEN} AND o_orderstatus <> 'P'""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    in_range = F.col("o_orderdate").between(clock.wall(_LOW), clock.wall(_HIGH))
    batch = orders.where(in_range & (F.col("o_orderstatus") != "P")).withColumn("source", F.lit("batch"))
    target = orders.withColumn("source", F.lit("target"))
    return incremental.replace_range(target, batch, "o_orderdate", _LOW, _HIGH).select("o_orderkey", "source")


@query(
    "b7_replace_late_half_open",
    f"""SELECT o_orderkey, 'target' AS source FROM orders
          WHERE NOT (o_orderdate >= TIMESTAMP '{_LOW}' AND o_orderdate < TIMESTAMP '{_HIGH}')
        UNION ALL SELECT o_orderkey, 'batch' FROM orders
          WHERE o_orderdate >= TIMESTAMP '{_LOW}' AND o_orderdate < TIMESTAMP '{_HIGH}'""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    in_range = (F.col("o_orderdate") >= clock.wall(_LOW)) & (F.col("o_orderdate") < clock.wall(_HIGH))
    batch = orders.where(in_range).withColumn("source", F.lit("batch"))
    target = orders.withColumn("source", F.lit("target"))
    changed = incremental.replace_range(target, batch, "o_orderdate", _LOW, _HIGH, closed=False)
    return changed.select("o_orderkey", "source")


@query(
    "k8_replace_key",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS loaded, 'target' AS source
         FROM orders WHERE o_orderstatus = 'P' OR o_orderdate <> TIMESTAMP '1995-06-19'
       UNION ALL SELECT o_orderkey, o_orderdate, 'batch' FROM orders WHERE o_orderdate = TIMESTAMP '1995-06-19'""",
)
def _(spark, sf):
    """Rows without a load time never match and stay."""
    day = dt.datetime(1995, 6, 19)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    loaded = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    target = orders.select("o_orderkey", loaded.alias("loaded"), F.lit("target").alias("source"))
    batch = orders.where(F.col("o_orderdate") == clock.wall(day)).select(
        "o_orderkey", F.col("o_orderdate").alias("loaded"), F.lit("batch").alias("source")
    )
    return incremental.replace_key(target, batch, "loaded", day)


@query(
    "k9_insert_if_absent",
    f"""SELECT o_orderkey, o_orderdate FROM orders WHERE {_OLD} AND o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_orderdate FROM orders o WHERE NOT EXISTS (
          SELECT 1 FROM orders t WHERE t.o_orderdate < TIMESTAMP '{_CUT}' AND t.o_orderstatus = 'F'
            AND t.o_orderdate = o.o_orderdate)""",
)
def _(spark, sf):
    target, batch = _split(spark, sf)
    rows = batch.select("o_orderkey", "o_orderdate")
    loaded = target.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    return incremental.insert_if_absent(loaded, rows, "o_orderdate")


@query(
    "k10_update_where",
    """SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN ts + INTERVAL 9 HOUR ELSE ts END
         AS created_at FROM events""",
)
def _(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias("created_at"))
    return incremental.localise_created_at(rows, dt.date(2024, 1, 15))
