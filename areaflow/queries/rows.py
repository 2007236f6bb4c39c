"""Filters, duplicate policies, joins, generators and projections over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts as c
from areaflow import session
from areaflow.functions import clock, keys, parsing, text
from areaflow.operators import conform, dedupe, generators, history, incremental, lookup, minutes
from areaflow.queries.registry import RUN_TS, query, table
from areaflow.queries.roles import (
    AREAS, CATEGORIES, CONGESTIONS, E, TRANSIT_LOADS, areas, categories, congestions, documents, observations,
    transit_loads, with_sql,
)
from areaflow.sources import paths

_LINE = ["l_orderkey", "l_linenumber"]
_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]

# --- duplicate policies ---------------------------------------------------------


@query(
    "w1_latest_wins",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY newest DESC NULLS FIRST, {", ".join(f"{n} DESC" for n in _LINE_REST)}, l_shipdate DESC) AS rn
        FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS newest FROM lineitem)) WHERE rn = 1""",
)
def _(spark, sf):
    newest = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate"))
    items = table(spark, sf, "lineitem").withColumn("newest", newest)
    ties = [F.col(n).desc() for n in [*_LINE_REST, "l_shipdate"]]
    return dedupe.latest_wins(items, _LINE, "newest", ties)


@query(
    "w2_first_wins",
    """SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
       FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return dedupe.first_wins(events, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()])


@query(
    "f12_rank_filter",
    with_sql(TRANSIT_LOADS, select="SELECT source_id, created_at, station_count FROM stg WHERE transport_type = 'bus'"),
)
def _(spark, sf):
    ties = [F.col("area_name").desc(), *[F.col(f.column).desc() for f in c.TRANSIT_STEMS]]
    loads = transit_loads(spark, sf, c.BUS)
    kept = dedupe.ranked_first(loads, ["observed_at", "area_code"], [F.col("created_at").desc_nulls_first(), *ties])
    return kept.select("source_id", "created_at", "station_count")


@query(
    "a1_max_wins",
    f"""SELECT nullif(l_orderkey, 0) AS l_orderkey, l_linenumber,
          {", ".join(f"max({n}) AS {n}" for n in [*_LINE_REST, "l_shipdate"])}
        FROM lineitem GROUP BY nullif(l_orderkey, 0), l_linenumber""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("l_orderkey", F.nullif("l_orderkey", F.lit(0)))
    return dedupe.max_wins(items, _LINE)


@query("a2_distinct_rows", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day")).distinct()


@query("a3_any_one_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _(spark, sf):
    return dedupe.any_one(table(spark, sf, "lineitem"), _LINE).select(*_LINE)


@query("a4_high_water_mark", "SELECT max(o_orderdate) AS newest FROM orders")
def _(spark, sf):
    return incremental.high_water(table(spark, sf, "orders"), "o_orderdate").withColumnRenamed("_mark", "newest")


@query("a5_row_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


# --- history ----------------------------------------------------------------------


def _finished(spark, sf):
    """Finished orders as the processed history."""
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return orders.select(
        F.col("o_custkey").alias("area_id"),
        F.col("o_orderdate").alias("observed_at"),
        F.col("o_orderdate").alias("processed_at"),
        F.to_date("o_orderdate").alias("observed_date"),
    )


def _second_history(spark, sf):
    """Every event as a processed observation, to the second."""
    events = table(spark, sf, "events")
    at = clock.truncated(F.col("ts"), "second")
    return events.select(
        F.col("user_id").cast("int").alias("area_id"),
        at.alias("observed_at"),
        clock.wall("2024-02-01 00:00:00").alias("processed_at"),
        F.to_date("ts").alias("observed_date"),
    )


@query(
    "j6_history_anti",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders h
       WHERE h.o_orderstatus = 'F' AND h.o_custkey = o.o_custkey AND h.o_orderdate = o.o_orderdate)""",
)
def _(spark, sf):
    batch = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return history.unseen(batch, _finished(spark, sf), {"o_custkey": "area_id", "o_orderdate": "observed_at"})


# History of purchases, some of them off the whole minute; the batch is every event.
_MINUTE_SQL = """CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) ELSE date_trunc('minute', ts) END"""


def _observed(spark, sf):
    at = F.when(F.col("event_id") % 3 == 0, clock.truncated(F.col("ts"), "second")).otherwise(clock.truncated(F.col("ts"), "minute"))
    return table(spark, sf, "events").select("event_id", F.col("user_id").cast("int").alias("area_id"), at.alias("observed_at"), "event_type")


@query(
    "j6_history_minutes",
    f"""WITH o AS (SELECT event_id, CAST(user_id AS INTEGER) AS area_id, CAST({_MINUTE_SQL} AS TIMESTAMP) AS observed_at, event_type FROM events)
        SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM o h WHERE h.event_type = 'purchase'
          AND h.area_id = o.area_id AND h.observed_at = o.observed_at)""",
)
def _(spark, sf):
    """The anti-join against bitmaps of two loads."""
    rows = _observed(spark, sf)
    loads = minutes.pack(rows.where("event_type = 'purchase'").withColumn("load", F.col("event_id") % 2), by=["load"])
    return history.unseen(rows, minutes.merged(loads))


@query(
    "k13_history_minutes",
    f"""SELECT DISTINCT CAST(user_id AS INTEGER) AS area_id, CAST({_MINUTE_SQL} AS TIMESTAMP) AS observed_at,
        CAST(ts AS DATE) AS observed_date FROM events""",
)
def _(spark, sf):
    """Every observation packed, merged and read back as rows."""
    return minutes.unpack(minutes.merged(minutes.pack(_observed(spark, sf), by=["event_type"])))


@query(
    "j7_history_anti_using",
    """SELECT area_id, observed_at, count(*) AS n FROM (
         SELECT o_custkey AS area_id, o_orderdate AS observed_at FROM orders) o
       WHERE NOT EXISTS (SELECT 1 FROM orders h WHERE h.o_orderstatus = 'F' AND h.o_custkey = o.area_id
         AND h.o_orderdate = o.observed_at) GROUP BY area_id, observed_at""",
)
def _(spark, sf):
    batch = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("area_id"), F.col("o_orderdate").alias("observed_at")
    )
    seen = history.for_batch(_finished(spark, sf), batch)
    return history.unseen(batch, seen).groupBy("area_id", "observed_at").agg(F.count("*").alias("n"))


@query(
    "j8_unseen_first_in_batch",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey) AS rn
         FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F'))
       WHERE rn = 1""",
)
def _(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    batch = table(spark, sf, "lineitem").select(*_LINE, "l_shipdate", "l_partkey")
    fresh = history.unseen(batch, done, {"l_orderkey": "o_orderkey"})
    return dedupe.first_wins(fresh, _LINE, [F.col("l_shipdate").asc(), F.col("l_partkey").asc()])


@query(
    "a7_nested_history",
    """SELECT CAST(user_id AS INTEGER) AS area_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS observed_hour,
         '{"' || CAST(user_id AS VARCHAR) || '":[' || string_agg(entry, ',' ORDER BY entry) || ']}' AS document
       FROM (SELECT DISTINCT user_id, date_trunc('hour', ts) AS ts, '{"observed_at":"'
               || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","processed_at":"2024-02-01 00:00:00"}' AS entry FROM events)
       GROUP BY user_id, date_trunc('hour', ts)""",
)
def _(spark, sf):
    return history.to_documents(_second_history(spark, sf)).drop("entries")


@query(
    "a6_history_totals",
    "SELECT count(*) AS entries FROM (SELECT DISTINCT user_id, date_trunc('second', ts) FROM events)",
)
def _(spark, sf):
    return history.entry_total(history.to_documents(_second_history(spark, sf)))


@query(
    "a8_known_before_append",
    """SELECT o_orderkey, EXISTS (SELECT 1 FROM orders h WHERE h.o_orderstatus = 'F' AND h.o_custkey = o.o_custkey
         AND h.o_orderdate = o.o_orderdate) AS known FROM orders o""",
)
def _(spark, sf):
    seen = _finished(spark, sf).select("area_id", "observed_at").distinct().withColumn("known", F.lit(True))
    batch = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    found = lookup.lookup(batch, seen, {"o_custkey": "area_id", "o_orderdate": "observed_at"}, {"known": "known"})
    return found.select("o_orderkey", F.coalesce("known", F.lit(False)).alias("known"))


@query(
    "g3_history_map_rows",
    """SELECT DISTINCT CAST(user_id AS INTEGER) AS area_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS observed_at,
         TIMESTAMP '2024-02-01' AS processed_at, CAST(ts AS DATE) AS observed_date FROM events""",
)
def _(spark, sf):
    nested = history.to_documents(_second_history(spark, sf))
    return history.from_documents(nested, F.col("document"))


@query(
    "s12_history_scan",
    """SELECT CAST(l_suppkey AS INTEGER) AS area_id, CAST(l_shipdate AS TIMESTAMP) AS observed_at,
         CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 DAY AS processed_at, CAST(l_shipdate AS DATE) AS observed_date
       FROM lineitem""",
)
def _(spark, sf):
    stamp, done = F.date_format("l_shipdate", c.DASHED_SECOND), F.date_add(F.to_date("l_shipdate"), 1)
    entry = F.struct(stamp.alias("observed_at"), F.date_format(done, c.DASHED_SECOND).alias("processed_at"))
    area = F.concat(F.lit("POI0"), F.col("l_suppkey").cast("string"))
    items = session.spread(table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate"))
    documents = items.select(F.to_json(F.create_map(area, F.array(entry))).alias("document"))
    return history.from_documents(documents, F.col("document"))


@query(
    "k13_history_append",
    """SELECT o_custkey AS area_id, o_orderdate AS observed_at,
         CASE WHEN bool_or(o_orderstatus = 'F') THEN o_orderdate ELSE TIMESTAMP '2024-02-01' END AS processed_at
       FROM orders GROUP BY o_custkey, o_orderdate""",
)
def _(spark, sf):
    batch = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("area_id"), F.col("o_orderdate").alias("observed_at")
    )
    known = _finished(spark, sf).dropDuplicates(["area_id", "observed_at"])
    return history.merged(known, history.entries_of(batch, RUN_TS)).drop("observed_date")


@query(
    "u2_union_then_dedupe",
    """SELECT o_custkey AS area, o_orderdate AS at FROM orders
       UNION SELECT l_suppkey, l_shipdate FROM lineitem""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("area"), F.col("o_orderdate").alias("at"))
    items = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("area"), F.col("l_shipdate").alias("at"))
    return orders.unionByName(items).distinct()


@query(
    "u1_tagged_union",
    "SELECT 'order' AS feed, o_orderkey AS row_id, o_orderdate AS at FROM orders "
    "UNION ALL SELECT 'event', event_id, ts FROM events",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderdate").alias("at"))
    events = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("ts").alias("at"))
    both = orders.withColumn("feed", F.lit("order")).unionByName(events.withColumn("feed", F.lit("event")))
    return both.select("feed", "row_id", "at")


# --- lookups -------------------------------------------------------------------------


@query(
    "j1_lookup_area",
    with_sql(E, AREAS, select="SELECT event_id, e.area_code, area_id FROM e LEFT JOIN dim_area USING (area_code)"),
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.format_string("POI%03d", "user_id").alias("area_code"))
    return lookup.lookup(events, areas(spark, sf), {"area_code": "area_code"}, {"area_id": "area_id"})


@query(
    "j2_lookup_composite",
    with_sql(
        CATEGORIES,
        select="""SELECT p_partkey, category_id FROM (SELECT p_partkey, p_brand, nullif(p_type, 'SMALL') AS p_type
            FROM part) LEFT JOIN dim_category ON p_brand = category_large AND p_type = category_medium""",
    ),
)
def _(spark, sf):
    parts = table(spark, sf, "part").withColumn("p_type", F.nullif("p_type", F.lit("SMALL")))
    on = {"p_brand": "category_large", "p_type": "category_medium"}
    found = lookup.lookup(parts, categories(spark, sf), on, {"category_id": "category_id"})
    return found.select("p_partkey", "category_id")


@query(
    "j3_lookup_label",
    with_sql(
        CONGESTIONS,
        select="""SELECT event_id, congestion_id FROM events LEFT JOIN dim_congestion
            ON event_type = congestion_label""",
    ),
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    found = lookup.lookup(
        events, congestions(spark, sf), {"event_type": "congestion_label"}, {"congestion_id": "congestion_id"}
    )
    return found.drop("event_type")


@query(
    "j4_lookup_hash",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_size FROM lineitem
       LEFT JOIN (SELECT md5(p_brand || '-' || p_name) AS h, max(p_size) AS p_size FROM part
         WHERE p_type <> 'SMALL' GROUP BY 1) ON h = (SELECT md5(p_brand || '-' || p_name) FROM part
         WHERE p_partkey = l_partkey)""",
)
def _(spark, sf):
    key = keys.surrogate_key(F.col("p_brand"), F.col("p_name"))
    parts = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", key.alias("h"))
    named = parts.where("p_type <> 'SMALL'").groupBy("h").agg(F.max("p_size").alias("p_size"))
    items = table(spark, sf, "lineitem").select(*_LINE, "l_partkey")
    keyed = lookup.lookup(items, parts, {"l_partkey": "p_partkey"}, {"h": "h"})
    return lookup.lookup(keyed, named, {"h": "h"}, {"p_size": "p_size"}).drop("h")


@query(
    "j5_lookup_projection",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CAST(strftime(o_orderdate, '%Y%m%d%H%M') AS BIGINT) AS
         time_key FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", clock.time_key(F.col("o_orderdate")).alias("time_key"))
    items = table(spark, sf, "lineitem").select(*_LINE, "l_partkey", "l_shipdate")
    return lookup.lookup(items, orders, {"l_orderkey": "o_orderkey"}, {"time_key": "time_key"})


@query(
    "j9_lookup_inner",
    with_sql(E, AREAS, select="SELECT event_id, area_id FROM e JOIN dim_area USING (area_code)"),
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.format_string("POI%03d", "user_id").alias("area_code"))
    found = lookup.lookup(events, areas(spark, sf), {"area_code": "area_code"}, {"area_id": "area_id"}, how="inner")
    return found.drop("area_code")


@query(
    "f9_keys_found",
    with_sql(
        E, AREAS, CONGESTIONS,
        select="""SELECT event_id, area_id, congestion_id FROM e LEFT JOIN dim_area USING (area_code)
            LEFT JOIN dim_congestion ON event_type = congestion_label
            WHERE area_id IS NOT NULL AND congestion_id IS NOT NULL""",
    ),
)
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("area_code", F.format_string("POI%03d", "user_id"))
    found = lookup.lookup(events, areas(spark, sf), {"area_code": "area_code"}, {"area_id": "area_id"})
    found = lookup.lookup(
        found, congestions(spark, sf), {"event_type": "congestion_label"}, {"congestion_id": "congestion_id"}
    )
    return found.dropna(subset=["area_id", "congestion_id"]).select("event_id", "area_id", "congestion_id")


# --- generators and nested fields ------------------------------------------------------


@query(
    "f1_non_empty_arrays",
    with_sql(E, select="SELECT area_code, m AS file_ts FROM e WHERE k % 3 > 0"),
)
def _(spark, sf):
    docs = documents(spark, sf).where(F.size(c.EVENT) > 0)
    return docs.select(F.col(c.AREA_CODE).alias("area_code"), "file_ts")


@query("f2_field_present", "SELECT event_id, nullif(event_type, 'view') AS label FROM events WHERE event_type <> 'view'")
def _(spark, sf):
    labelled = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("label"))
    return labelled.where(F.col("label").isNotNull())


@query(
    "f3_valid_feed_only",
    with_sql(E, select="SELECT area_code, m AS file_ts FROM e WHERE event_type IN ('click', 'view', 'error')"),
)
def _(spark, sf):
    docs = documents(spark, sf).where(F.col("LIVE_BUS_PPLTN.BUS_STN_TIME").isNotNull())
    return docs.select(F.col(c.AREA_CODE).alias("area_code"), "file_ts")


@query(
    "g1_explode",
    with_sql(E, select="SELECT area_code, m AS file_ts, 'event ' || k AS event_name, i AS nth FROM "
             "(SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM e)"),
)
def _(spark, sf):
    docs = documents(spark, sf).select(F.col(c.AREA_CODE).alias("area_code"), "file_ts", c.EVENT)
    numbered = F.transform(F.col(c.EVENT), lambda x, i: F.struct(x["EVENT_NM"].alias("name"), (i + 1).alias("nth")))
    rows = generators.rows(docs, numbered, "item")
    return rows.select("area_code", "file_ts", F.col("item.name").alias("event_name"), F.col("item.nth").cast("bigint").alias("nth"))


@query(
    "g2_explode_outer",
    with_sql(E, select="SELECT event_id, i FROM (SELECT *, unnest(CASE WHEN k % 4 > 0 THEN range(1, k % 4 + 1) "
             "ELSE [NULL] END) AS i FROM e)"),
)
def _(spark, sf):
    count = F.col("k") % 4
    items = F.when(count > 0, F.sequence(F.lit(1), count))
    rows = generators.rows(observations(spark, sf), items, "i", outer=True)
    return rows.select("event_id", F.col("i").cast("bigint").alias("i"))


@query(
    "p7_star_expansion",
    with_sql(
        E,
        select="""SELECT area_code, m AS file_ts, k AS "SUB_STN_CNT", k || '.0' AS "SUB_ACML_GTON_PPLTN_MIN" FROM e""",
    ),
)
def _(spark, sf):
    wide = documents(spark, sf).select(F.col(c.AREA_CODE).alias("area_code"), "file_ts", "LIVE_SUB_PPLTN.*")
    return wide.select(
        "area_code", "file_ts", F.col("SUB_STN_CNT").try_cast("int").alias("SUB_STN_CNT"), "SUB_ACML_GTON_PPLTN_MIN"
    )


@query(
    "p8_nested_fields",
    with_sql(E, select="SELECT area_code, m AS file_ts, CASE WHEN event_type = 'error' THEN 'n/a' "
             "ELSE strftime(ts, '%Y%m%d %H%M') END AS observed, event_type AS crowd FROM e"),
)
def _(spark, sf):
    return documents(spark, sf).select(
        F.col(c.AREA_CODE).alias("area_code"),
        "file_ts",
        F.col("LIVE_CMRCL_STTS.CMRCL_TIME").alias("observed"),
        F.get(F.col("LIVE_PPLTN_STTS.AREA_CONGEST_LVL"), F.lit(0)).alias("crowd"),
    )


@query(
    "j1_duplicate_dimension_keys",
    """SELECT nullif(n_regionkey, 0) AS n_regionkey, count(*) AS copies FROM nation
       WHERE n_regionkey <> 0 GROUP BY n_regionkey HAVING count(*) > 1""",
)
def _(spark, sf):
    """What a build refuses a dimension for; NULL keys match nothing and may repeat."""
    keyed = table(spark, sf, "nation").withColumn("n_regionkey", F.nullif("n_regionkey", F.lit(0)))
    return lookup.duplicate_keys(keyed, "n_regionkey")


@query(
    "d30_extreme_coordinates",
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN CAST(CAST(value AS DECIMAL(18,7)) AS VARCHAR) END AS shown
       FROM events""",
)
def _(spark, sf):
    """A coordinate that fits no place on earth becomes NULL in the key instead of stopping the build."""
    value = F.when(F.col("event_type") == "click", F.lit(1e300)).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", keys.coordinate_text(value).alias("shown"))


# --- projections -----------------------------------------------------------------------


def _renamed(spark, sf, prefix):
    """Quantities, and the ship month, as prefixed text fields, selected back by template."""
    fields = [f._replace(raw=f"{prefix}_{f.raw}") for f in c.TRANSIT_STEMS]
    items = table(spark, sf, "lineitem")
    numbers = [(F.col("l_quantity").cast("int") + i).cast("string").alias(f.raw) for i, f in enumerate(fields[:-1])]
    payload = F.struct(*numbers, F.date_format("l_shipdate", "yyyyMM").alias(fields[-1].raw))
    return items.withColumn("payload", payload).select(*_LINE, "l_partkey", *conform.project("payload", fields))


_TEMPLATED = ", ".join(
    [f"CAST(l_quantity AS INTEGER) + {i} AS {f.column}" for i, f in enumerate(c.TRANSIT_STEMS[:-1])]
    + [f"CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS {c.TRANSIT_STEMS[-1].column}"]
)


@query("p6_templated_rename", f"SELECT l_orderkey, l_linenumber, l_partkey, {_TEMPLATED} FROM lineitem")
def _(spark, sf):
    return _renamed(spark, sf, "SUB")


@query("p9_constant_tag", "SELECT event_id, 'events' AS feed, 1 AS version FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.lit("events").alias("feed"), F.lit(1).alias("version"))


@query(
    "p10_column_order",
    "SELECT event_type, ts, user_id, event_id FROM events",
)
def _(spark, sf):
    schema = T.StructType().add("event_type", "string").add("ts", "timestamp_ntz").add("user_id", "long").add(
        "event_id", "long"
    )
    return conform.conform(table(spark, sf, "events"), schema)


@query("p11_drop_helpers", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    return table(spark, sf, "events").withColumn("_helper", F.lit(1)).drop(
        "_helper", "ts", "event_type", "value", "props"
    )


@query(
    "p12_schema_conformance",
    """SELECT event_id, CAST(user_id AS INTEGER) AS user_id, TRY_CAST(event_type AS INTEGER) AS event_type,
         CAST(CAST(value AS VARCHAR) AS DECIMAL(5,2)) AS value, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def _(spark, sf):
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.IntegerType()),
            T.StructField("event_type", T.IntegerType()),
            T.StructField("value", T.DecimalType(5, 2)),
            T.StructField("absent", T.StringType()),
        ]
    )
    return conform.conform(table(spark, sf, "events"), schema)


@query(
    "p14_typed_fill",
    with_sql(E, select="SELECT event_id, coalesce(nullif(k, 5), 0) AS k, coalesce(nullif(event_type, 'view'), '') AS "
             "event_type, CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS ts FROM e"),
)
def _(spark, sf):
    holes = observations(spark, sf).select(
        "event_id",
        F.nullif("k", F.lit(5)).alias("k"),
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("ts")).alias("ts"),
    )
    return conform.fill_typed(holes, holes.schema)


@query(
    "p16_display_names",
    'SELECT c_custkey AS "장소명(ID)", c_name AS "장소명", c_mktsegment AS "상권 현황" FROM customer',
)
def _(spark, sf):
    names = {"c_custkey": "장소명(ID)", "c_name": "장소명", "c_mktsegment": "상권 현황"}
    return conform.display(table(spark, sf, "customer"), names)


@query("p17_star_plus_key", "SELECT *, md5(p_brand || '-' || p_type) AS row_key FROM part")
def _(spark, sf):
    return table(spark, sf, "part").withColumn("row_key", keys.surrogate_key(F.col("p_brand"), F.col("p_type")))


@query(
    "p18_layered_views",
    """WITH renamed AS (SELECT event_id AS row_id, user_id AS area, CAST(ts AS DATE) AS day FROM events)
       SELECT area, day, count(*) AS n FROM renamed GROUP BY area, day""",
)
def _(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("p18_events")
    return spark.sql(
        """WITH renamed AS (SELECT event_id AS row_id, user_id AS area, CAST(ts AS DATE) AS day FROM p18_events)
           SELECT area, day, count(*) AS n FROM renamed GROUP BY area, day"""
    )


# --- time filters --------------------------------------------------------------------


@query(
    "f4_half_open_range",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20 12:00:00'",
)
def _(spark, sf):
    window = paths.in_window(F.col("ts"), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 20, 12))
    return table(spark, sf, "events").select("event_id", "ts").where(window)


@query(
    "f5_closed_range",
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'",
)
def _(spark, sf):
    dates = F.col("o_orderdate").between(clock.wall("1996-01-01"), clock.wall("1998-12-31"))
    return table(spark, sf, "orders").where(dates).select("o_orderkey")


@query(
    "f6_readable_times_only",
    "SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS observed_at FROM events WHERE event_type <> 'error'",
)
def _(spark, sf):
    shown = F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("ts", c.COMPACT_MINUTE))
    parsed = table(spark, sf, "events").select("event_id", clock.parse(shown, c.COMPACT_MINUTE).alias("observed_at"))
    return parsed.where("observed_at is not null")


@query("f10_date_key", "SELECT o_orderkey FROM orders WHERE o_orderdate = TIMESTAMP '1995-06-19'")
def _(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") == clock.wall("1995-06-19")).select("o_orderkey")


@query("f11_day_of_timestamp", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(spark, sf):
    # a range on the raw column, so the bound reaches the scan
    in_day = (F.col("ts") >= clock.wall("2024-01-15")) & (F.col("ts") < clock.wall("2024-01-16"))
    return table(spark, sf, "events").where(in_day).select("event_id")


# --- helpers kept out of Python -------------------------------------------------------


@query(
    "d1_source_id_built_in",
    with_sql(E, select="SELECT area_code, m AS observed_at, md5(area_code || '_' || "
             "strftime(m, '%Y-%m-%d %H:%M:%S')) AS source_id FROM e"),
)
def _(spark, sf):
    docs = documents(spark, sf).select(F.col(c.AREA_CODE).alias("area_code"), F.col("file_ts").alias("observed_at"))
    return docs.withColumn("source_id", keys.source_id(F.col("area_code"), F.col("observed_at")))


def _broken_keys(spark, sf):
    """Keys with a missing underscore, a word for the area or another suffix by type."""
    stamp = F.date_format("ts", "yyyyMMdd/HHmm")
    area = F.col("user_id").cast("string")
    kind = F.col("event_type")
    path = (
        F.when(kind == "error", F.concat(F.lit("raw/"), stamp, area, F.lit(".json")))
        .when(kind == "view", F.concat(F.lit("raw/"), stamp, F.lit("_x"), area, F.lit(".json")))
        .when(kind == "signup", F.concat(F.lit("raw/"), stamp, F.lit("_"), area, F.lit(".txt")))
        .otherwise(F.concat(F.lit("raw/"), stamp, F.lit("_"), area, F.lit(".json")))
    )
    return table(spark, sf, "events").select("event_id", path.alias("path"))


@query(
    "d2_area_from_key",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN CAST(user_id AS INTEGER) END AS file_area_id
       FROM events""",
)
def _(spark, sf):
    keyed = paths.with_key_parts(_broken_keys(spark, sf), F.col("path"))
    return keyed.select("event_id", "file_area_id")


@query(
    "s11_document_keys",
    """SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup')""",
)
def _(spark, sf):
    keyed = _broken_keys(spark, sf)
    return keyed.where(paths.is_document(F.col("path"))).select("event_id")


@query(
    "d3_row_parsers",
    with_sql(E, select="SELECT event_id, k AS whole, CAST(value AS FLOAT) AS measure, "
             "CASE WHEN k = 0 THEN NULL ELSE k END AS positive FROM e"),
)
def _(spark, sf):
    shown = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id",
        parsing.int_truncating(F.concat(shown, F.lit(".4"))).alias("whole"),
        parsing.real(F.col("value").cast("string")).alias("measure"),
        parsing.int_strict(F.nullif(shown, F.lit("0"))).alias("positive"),
    )


@query(
    "d4_frame_helpers",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {_TEMPLATED}, 'BUS' AS feed FROM lineitem",
)
def _(spark, sf):
    return _renamed(spark, sf, "BUS").transform(lambda df: df.withColumn("feed", F.lit("BUS")))


@query(
    "j10_area_number_normalised",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate FROM lineitem WHERE NOT EXISTS (
         SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal < 5000)""",
)
def _(spark, sf):
    """Codes with a prefix and plain numbers name the same area in the history."""
    done = table(spark, sf, "supplier").where("s_acctbal < 5000")
    seen = done.select(text.area_number(F.col("s_name")).alias("area_id"))
    batch = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    return history.unseen(batch, seen, {"l_suppkey": "area_id"})
