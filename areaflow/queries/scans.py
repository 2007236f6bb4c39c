"""Scans, key windows and partitioned reads over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow import session
from areaflow.functions import clock
from areaflow.operators import conform
from areaflow.queries.registry import query, table
from areaflow.queries.roles import E, areas, json_documents, landed_documents, observations, raw_key, with_sql
from areaflow.sources import files, manifest, paths, raw, sinks, tables

_START, _END = dt.datetime(2024, 1, 10, 21), dt.datetime(2024, 1, 20, 9)


def _keyed(spark, sf):
    """Events with the parts of the object key they would be stored under."""
    events = table(spark, sf, "events").withColumn("path", raw_key())
    return paths.with_key_parts(events, F.col("path"))


_CROWD = with_sql(
    E,
    select="""SELECT area_code, area_name, event_type AS crowd, k % 3 AS events, m AS file_ts,
        strftime(m, '%Y%m%d') AS ymd FROM e""",
)


@query("s1_raw_json_scan", _CROWD)
def _(spark, sf):
    """Documents written as JSON files by day and scanned with the declared schema."""
    keyed = landed_documents(spark, sf)
    return keyed.select(
        F.col(c.AREA_CODE).alias("area_code"),
        F.col(c.AREA_NAME).alias("area_name"),
        F.get(F.col("LIVE_PPLTN_STTS.AREA_CONGEST_LVL"), F.lit(0)).alias("crowd"),
        F.coalesce(F.size(c.EVENT), F.lit(0)).alias("events"),
        "file_ts",
        F.col("ymd").cast("string").alias("ymd"),
    )


@query("s2_json_text_scan", _CROWD)
def _(spark, sf):
    """The same documents from a text column."""
    bodies = json_documents(spark, sf)
    docs = paths.with_key_parts(raw.from_json_text(bodies, F.col("body"), "path"), F.col("path"))
    return docs.select(
        F.col(c.AREA_CODE).alias("area_code"),
        F.col(c.AREA_NAME).alias("area_name"),
        F.get(F.col("LIVE_PPLTN_STTS.AREA_CONGEST_LVL"), F.lit(0)).alias("crowd"),
        F.coalesce(F.size(c.EVENT), F.lit(0)).alias("events"),
        "file_ts",
        F.date_format("file_ts", "yyyyMMdd").alias("ymd"),
    )


_HOURS_SQL = "SELECT event_id, date_trunc('minute', ts) AS file_ts FROM events WHERE "


@query(
    "s3_hour_steps_inclusive",
    _HOURS_SQL + f"date_trunc('hour', ts) BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'",
)
def _(spark, sf):
    keyed = _keyed(spark, sf)
    return keyed.where(paths.in_hour_steps(F.col("file_ts"), _START, _END, inclusive=True)).select("event_id", "file_ts")


@query(
    "s4_hour_steps_exclusive",
    _HOURS_SQL + f"date_trunc('hour', ts) >= TIMESTAMP '{_START}' AND date_trunc('hour', ts) < TIMESTAMP '{_END}'",
)
def _(spark, sf):
    keyed = _keyed(spark, sf)
    return keyed.where(paths.in_hour_steps(F.col("file_ts"), _START, _END, inclusive=False)).select("event_id", "file_ts")


@query(
    "s5_minute_window",
    """SELECT event_id, date_trunc('minute', ts) AS file_ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-04 23:58:00' AND ts < TIMESTAMP '2024-01-05 00:03:00'""",
)
def _(spark, sf):
    window = clock.previous_minutes(dt.datetime(2024, 1, 5, 0, 3, 30), 5)
    return _keyed(spark, sf).where(paths.in_window(F.col("file_ts"), *window)).select("event_id", "file_ts")


@query(
    "s6_ten_minute_window",
    """SELECT event_id, date_trunc('minute', ts) AS file_ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-04 23:53:00' AND ts < TIMESTAMP '2024-01-05 00:03:00'""",
)
def _(spark, sf):
    window = clock.previous_minutes(dt.datetime(2024, 1, 5, 0, 3, 30), 10)
    return _keyed(spark, sf).where(paths.in_window(F.col("file_ts"), *window)).select("event_id", "file_ts")


@query(
    "s7_fixed_slot",
    "SELECT event_id, strftime(ts, '%H%M') AS file_hhmm FROM events WHERE strftime(ts, '%H%M') LIKE '003%'",
)
def _(spark, sf):
    return _keyed(spark, sf).where(paths.in_slot(F.col("file_hhmm"), "003")).select("event_id", "file_hhmm")


@query(
    "s8_first_per_location",
    """SELECT CAST(user_id AS INTEGER) AS file_area_id, CAST(ts AS DATE) AS day, min('raw-json/'
         || strftime(ts, '%Y%m%d/%H%M') || '_' || CAST(user_id AS VARCHAR) || '.json') AS path
       FROM events GROUP BY user_id, CAST(ts AS DATE)""",
)
def _(spark, sf):
    keyed = _keyed(spark, sf).withColumn("day", F.to_date("file_ts"))
    return paths.first_per_location(keyed, "file_area_id", "day")


@query(
    "s9_key_parts",
    """SELECT event_id, date_trunc('minute', ts) AS file_ts, strftime(ts, '%H%M') AS file_hhmm,
         CAST(user_id AS INTEGER) AS file_area_id FROM events""",
)
def _(spark, sf):
    return _keyed(spark, sf).select("event_id", "file_ts", "file_hhmm", "file_area_id")


@query(
    "s10_input_file_name",
    """SELECT event_id, 'events.parquet' AS file_name FROM events""",
)
def _(spark, sf):
    # the table's own name, whether it is one file or a folder of files
    name = F.regexp_extract(F.col("_metadata.file_path"), "/([a-z]+[.]parquet)(/|$)", 1)
    return table(spark, sf, "events").select("event_id", name.alias("file_name"))


@query("s13_missing_source_is_empty", "SELECT event_id, FALSE AS seen FROM events")
def _(spark, sf):
    """On a first run nothing is in the history, so nothing is filtered."""
    absent = files.read_or_empty(spark, session.scratch(spark, "absent"), c.HISTORY_TABLE)
    events = table(spark, sf, "events").withColumn("area_id", F.col("user_id").cast("int"))
    seen = absent.select("area_id", F.lit(True).alias("seen")).distinct()
    return events.join(seen, "area_id", "left").select("event_id", F.coalesce("seen", F.lit(False)).alias("seen"))


@query("s14_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    schema = "o_orderkey bigint, o_totalprice double"
    return spark.read.schema(schema).parquet(f"{sf}/orders.parquet")


def _hour_table(spark, sf):
    """Events as a year/month/day/hour table in scratch."""
    path = session.scratch(spark, "hourly")
    dated = conform.with_date_parts(table(spark, sf, "events"), "ts")
    sinks.write_partitions(dated, path, ["year", "month", "day", "hour"])
    return spark.read.parquet(path)


@query(
    "s15_hour_partition_scan",
    f"""SELECT event_id, ts FROM events
        WHERE date_trunc('hour', ts) >= TIMESTAMP '{_START}' AND date_trunc('hour', ts) < TIMESTAMP '{_END}'""",
)
def _(spark, sf):
    return tables.hour_partitions(_hour_table(spark, sf), _START, _END).select("event_id", "ts")


@query(
    "s15_manifest_scan",
    f"""SELECT event_id, ts, CAST(hour(ts) AS INTEGER) AS hour FROM events
        WHERE date_trunc('hour', ts) >= TIMESTAMP '{_START}' AND date_trunc('hour', ts) < TIMESTAMP '{_END}'""",
)
def _(spark, sf):
    """A window's files as listed, each of them; what lands in the hours afterwards is another load's."""
    root, path = session.scratch(spark, "hourly"), session.scratch(spark, "manifest")
    dated = conform.with_date_parts(table(spark, sf, "events"), "ts")
    by = ["year", "month", "day", "hour"]
    sinks.write_partitions(dated, root, by)
    if not manifest.write(spark, root, _START, _END, path):
        return dated.select("event_id", "ts", "hour").limit(0)
    sinks.append(dated.where("event_type = 'click'"), root, by=by)
    return manifest.scan(spark, path).select("event_id", "ts", "hour")


@query(
    "s16_staged_json",
    with_sql(E, select="SELECT event_id, user_id, k, ts FROM e"),
)
def _(spark, sf):
    """Records handed over as JSON and read back with their schema."""
    path = session.scratch(spark, "records")
    records = observations(spark, sf).select("event_id", "user_id", "k", "ts")
    records.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    reader = spark.read.schema(records.schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return reader.json(path)


@query("s17_table_by_name", "SELECT area_id, area_code FROM (SELECT CAST(s_suppkey AS INTEGER) AS area_id, "
       "printf('POI%03d', s_suppkey) AS area_code FROM supplier)")  # fmt: skip
def _(spark, sf):
    wh = tables.Warehouse(spark, session.scratch(spark, "warehouse"))
    sinks.replace_prefix(areas(spark, sf), wh.path("dim", "area"))
    return spark.table(wh.register("dim", "area"))


# --- micro-batch windows as columns ---------------------------------------------------


@query(
    "b1_five_minute_batches",
    "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    slotted = table(spark, sf, "events").withColumn("slot", clock.minute_slot(F.col("ts"), 5))
    return slotted.groupBy("slot", "event_type").agg(F.count("*").alias("n"))


@query(
    "b2_ten_minute_batches",
    "SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS slot, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    slotted = table(spark, sf, "events").withColumn("slot", clock.minute_slot(F.col("ts"), 10))
    return slotted.groupBy("slot", "event_type").agg(F.count("*").alias("n"))


@query(
    "b3_night_batches",
    """SELECT CASE WHEN hour(ts) >= 21 THEN date_trunc('day', ts) + INTERVAL 21 HOUR
         ELSE date_trunc('day', ts) - INTERVAL 3 HOUR END AS night, user_id, count(*) AS n
       FROM events WHERE hour(ts) >= 21 OR hour(ts) < 9 GROUP BY ALL""",
)
def _(spark, sf):
    nights = table(spark, sf, "events").withColumn("night", clock.night_start(F.col("ts")))
    return nights.where("night is not null").groupBy("night", "user_id").agg(F.count("*").alias("n"))


@query(
    "b4_daily_slot_batch",
    """SELECT CAST(ts AS DATE) AS day, CAST(user_id AS INTEGER) AS file_area_id, count(*) AS documents
       FROM events WHERE strftime(ts, '%H%M') LIKE '00%' GROUP BY ALL""",
)
def _(spark, sf):
    slot = _keyed(spark, sf).where(paths.in_slot(F.col("file_hhmm"), "00"))
    by_day = slot.groupBy(F.to_date("file_ts").alias("day"), "file_area_id")
    return by_day.agg(F.count("*").alias("documents"))
