"""Scalar parsers, clocks and keys over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock, keys, parsing, text
from areaflow.queries.registry import query, table
from areaflow.queries.roles import E, observations, raw_key, with_sql

# A text that is a number, a fraction, blank, a word or NaN by event type.
_DIRTY_SQL = """CASE event_type WHEN 'click' THEN CAST(k AS VARCHAR) || '.7' WHEN 'view' THEN CAST(k AS VARCHAR)
  WHEN 'signup' THEN '' WHEN 'purchase' THEN 'abc' ELSE 'nan' END"""


def _dirty():
    k = F.col("k").cast("string")
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.concat(k, F.lit(".7")))
        .when(kind == "view", k)
        .when(kind == "signup", "")
        .when(kind == "purchase", "abc")
        .otherwise("nan")
    )


@query(
    "x1_source_id",
    with_sql(
        E, select="SELECT event_id, md5(area_code || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS source_id FROM e"
    ),
)
def _(spark, sf):
    code = F.format_string("POI%03d", "user_id")
    return table(spark, sf, "events").select("event_id", keys.source_id(code, F.col("ts")).alias("source_id"))


@query(
    "x2_surrogate_key",
    """SELECT p_partkey, md5(p_brand || '-' || coalesce(nullif(p_type, 'SMALL'), '_dbt_utils_surrogate_key_null_')
       || '-' || CAST(p_size AS VARCHAR)) AS row_key FROM part""",
)
def _(spark, sf):
    key = keys.surrogate_key(F.col("p_brand"), F.nullif("p_type", F.lit("SMALL")), F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", key.alias("row_key"))


@query("x3_time_key", "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS time_key FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", clock.time_key(F.col("ts")).alias("time_key"))


@query(
    "x4_composite_key",
    """SELECT event_id, strftime(ts, '%Y%m%d%H%M') || '-' || CAST(user_id AS VARCHAR) || '-'
       || nullif(event_type, 'view') AS row_key FROM events""",
)
def _(spark, sf):
    label = F.nullif("event_type", F.lit("view"))
    key = keys.transit_key(F.col("ts"), F.col("user_id").cast("string"), label)
    return table(spark, sf, "events").select("event_id", key.alias("row_key"))


@query(
    "x5_period_bounds",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS starts,
         CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE) + 7 END AS ends
       FROM orders""",
)
def _(spark, sf):
    start = F.date_format("o_orderdate", "yyyy-MM-dd")
    end = F.date_format(F.date_add(F.to_date("o_orderdate"), 7), "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    period = F.when(status == "F", F.concat(start, F.lit(" ~ "), end)).when(
        status == "O", F.concat(start, F.lit("~"))
    )
    period = F.coalesce(period, F.concat(start, F.lit("~later")))
    return (
        table(spark, sf, "orders")
        .withColumn("period", period)
        .select(
            "o_orderkey",
            clock.period_bound(F.col("period"), 1).alias("starts"),
            clock.period_bound(F.col("period"), 2).alias("ends"),
        )
    )


def _flag():
    kind = F.col("event_type")
    return F.when(kind == "click", "Y").when(kind == "view", "N").when(kind == "signup", "maybe")


@query(
    "x6_yes_no",
    "SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE END AS flag FROM events",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", parsing.yes_no(_flag()).alias("flag"))


@query("x7_is_yes", "SELECT event_id, event_type = 'click' AS flag FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", parsing.is_yes(_flag()).alias("flag"))


@query(
    "x8_bool_text", "SELECT event_id, CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS flag FROM events"
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", parsing.bool_text(parsing.yes_no(_flag())).alias("flag"))


@query(
    "x9_sentinel_null",
    "SELECT event_id, CAST(CASE WHEN event_type <> 'error' THEN value END AS FLOAT) AS measure FROM events",
)
def _(spark, sf):
    shown = F.when(F.col("event_type") == "error", c.UNDER_INSPECTION).otherwise(F.col("value").cast("string"))
    return table(spark, sf, "events").select("event_id", parsing.real_unless_sentinel(shown).alias("measure"))


@query(
    "x10_int_truncating",
    with_sql(
        E,
        select=f"""SELECT event_id, CASE WHEN regexp_full_match(t, '[0-9]+([.][0-9]+)?')
            THEN CAST(floor(CAST(t AS DOUBLE)) AS INTEGER) END AS number FROM (SELECT *, {_DIRTY_SQL} AS t FROM e)""",
    ),
)
def _(spark, sf):
    return observations(spark, sf).select("event_id", parsing.int_truncating(_dirty()).alias("number"))


@query(
    "x11_int_strict",
    with_sql(
        E,
        select=f"""SELECT event_id, CASE WHEN regexp_full_match(t, '[0-9]+') THEN CAST(t AS INTEGER) END AS number
            FROM (SELECT *, {_DIRTY_SQL} AS t FROM e)""",
    ),
)
def _(spark, sf):
    return observations(spark, sf).select("event_id", parsing.int_strict(_dirty()).alias("number"))


@query(
    "x12_real",
    with_sql(
        E,
        select=f"""SELECT event_id, CASE WHEN regexp_full_match(t, '[0-9]+([.][0-9]+)?')
            THEN CAST(t AS FLOAT) END AS number, t = 'nan' AS not_a_number
            FROM (SELECT *, {_DIRTY_SQL} AS t FROM e)""",
    ),
)
def _(spark, sf):
    number = parsing.real(_dirty())
    nan = F.coalesce(F.isnan(number), F.lit(False))
    return observations(spark, sf).select(
        "event_id", F.when(~nan, number).alias("number"), nan.alias("not_a_number")
    )


@query(
    "x13_coordinate",
    with_sql(
        E,
        select="""SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN NULL
            ELSE CAST('126.' || CAST(k AS VARCHAR) AS DOUBLE) END AS longitude FROM e""",
    ),
)
def _(spark, sf):
    kind = F.col("event_type")
    shown = F.when(kind == "view", " ").when(kind == "error", "?").otherwise(
        F.concat(F.lit("126."), F.col("k").cast("string"))
    )
    return observations(spark, sf).select("event_id", parsing.coordinate(shown).alias("longitude"))


@query(
    "x14_one_decimal",
    """SELECT event_id, CAST(printf('%.1f', value) AS DECIMAL(5,2)) AS rounded,
         CAST(printf('%.1f', value / 8) AS DECIMAL(5,2)) AS eighth, CAST(printf('%.1f', -value) AS DECIMAL(5,2)) AS
         negative FROM events""",
)
def _(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id",
        parsing.one_decimal(value).alias("rounded"),
        parsing.one_decimal(value / 8).alias("eighth"),
        parsing.one_decimal(-value).alias("negative"),
    )


@query(
    "x15_ratio",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_extendedprice,
         TRY_CAST(CAST(l_suppkey * 20 AS VARCHAR) || '.12' || CAST(l_linenumber AS VARCHAR) AS DECIMAL(5,2)) AS ratio
       FROM lineitem""",
)
def _(spark, sf):
    shown = F.concat(
        (F.col("l_suppkey") * 20).cast("string"), F.lit(".12"), F.col("l_linenumber").cast("string")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_extendedprice", parsing.ratio(shown).alias("ratio")
    )


@query(
    "x16_narrowing",
    """SELECT p_partkey, CAST(p_size AS SMALLINT) AS size_small, CAST(trunc(p_retailprice) AS INTEGER) AS price_int,
         CAST(p_retailprice AS FLOAT) AS price_real, CAST(p_size AS DOUBLE) AS size_double FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_size").cast("smallint").alias("size_small"),
        F.col("p_retailprice").cast("int").alias("price_int"),
        F.col("p_retailprice").cast("float").alias("price_real"),
        F.col("p_size").cast("double").alias("size_double"),
    )


@query(
    "x17_clipped_text",
    "SELECT p_partkey, substring(p_name, 1, 6) AS short_name, substring(p_brand, 1, 20) AS brand FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        parsing.clipped(F.col("p_name"), 6).alias("short_name"),
        parsing.clipped(F.col("p_brand"), 20).alias("brand"),
    )


@query(
    "x18_reformat_time",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:00') END AS observed
       FROM events""",
)
def _(spark, sf):
    shown = F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("ts", c.COMPACT_MINUTE))
    return table(spark, sf, "events").select("event_id", clock.reformat_compact(shown).alias("observed"))


@query(
    "x19_parse_time",
    """SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS dashed,
         CASE WHEN event_type <> 'error' THEN CAST(date_trunc('minute', ts) AS TIMESTAMP) END AS compact FROM events""",
)
def _(spark, sf):
    compact = F.when(F.col("event_type") == "error", "20240101").otherwise(F.date_format("ts", c.COMPACT_MINUTE))
    return table(spark, sf, "events").select(
        "event_id",
        clock.parse(F.date_format("ts", c.DASHED_MINUTE), c.DASHED_MINUTE).alias("dashed"),
        clock.parse(compact, c.COMPACT_MINUTE).alias("compact"),
    )


@query("x20_key_time", "SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS file_ts FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("path", raw_key())
    parts = F.concat(text.part(F.col("path"), "/", 1), F.substring(text.last_part(F.col("path"), "/"), 1, 4))
    return df.select("event_id", clock.parse(parts, c.TIME_KEY).alias("file_ts"))


@query(
    "x21_format_time",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dashed, strftime(ts, '%Y%m%d %H%M') AS compact
       FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", c.DASHED_SECOND).alias("dashed"),
        F.date_format("ts", c.COMPACT_MINUTE).alias("compact"),
    )


@query(
    "x22_bad_date_null",
    """SELECT event_id, CASE event_type WHEN 'click' THEN CAST(date_trunc('month', ts) AS TIMESTAMP)
         WHEN 'view' THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
         WHEN 'signup' THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS basis FROM events""",
)
def _(spark, sf):
    kind = F.col("event_type")
    shown = (
        F.when(kind == "click", F.date_format("ts", "yyyyMM"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "signup", F.date_format("ts", c.DASHED_SECOND))
        .when(kind == "purchase", "2024-13-45")
    )
    return table(spark, sf, "events").select("event_id", parsing.basis_month(shown).alias("basis"))


@query("x23_local_clock", "SELECT event_id, ts + INTERVAL 9 HOUR AS local_ts FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", clock.to_local(F.col("ts")).alias("local_ts"))


@query(
    "x24_zone_conversion",
    "SELECT o_orderkey, o_orderdate + INTERVAL 9 HOUR AS local_date, o_orderdate AS utc_date FROM orders",
)
def _(spark, sf):
    local = clock.to_local(F.col("o_orderdate"))
    back = F.convert_timezone(F.lit(c.LOCAL_ZONE), F.lit(c.UTC), local)
    return table(spark, sf, "orders").select("o_orderkey", local.alias("local_date"), back.alias("utc_date"))


@query(
    "x25_strip_characters",
    """SELECT event_id, strftime(ts, '%Y-%m-%d%H%M') AS digits, strftime(ts, '%Y%m%d_%H%M') AS joined,
         event_type AS trimmed FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        text.without(F.date_format("ts", c.DASHED_MINUTE), ": ").alias("digits"),
        F.replace(F.date_format("ts", c.COMPACT_MINUTE), F.lit(" "), F.lit("_")).alias("joined"),
        F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
    )


@query(
    "x26_split_parts",
    """SELECT event_id, strftime(ts, '%H%M') || '_' || CAST(user_id AS VARCHAR) || '.json' AS file_name,
         CAST(user_id AS VARCHAR) || '.json' AS after_underscore, CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def _(spark, sf):
    df = table(spark, sf, "events").withColumn("path", raw_key())
    return df.select(
        "event_id",
        text.last_part(F.col("path"), "/").alias("file_name"),
        text.part(F.col("path"), "_", 1).alias("after_underscore"),
        text.part(F.col("path"), "_", 5).alias("missing"),
    )


@query(
    "x27_trailing_digits",
    """SELECT s_suppkey, regexp_extract(s_name, '[0-9]+$') AS digits, CAST(s_suppkey AS INTEGER) AS number,
         '' AS no_digits FROM supplier""",
)
def _(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        text.trailing_digits(F.col("s_name")).alias("digits"),
        text.area_number(F.col("s_name")).alias("number"),
        text.trailing_digits(F.concat("s_name", F.lit(" "))).alias("no_digits"),
    )


@query(
    "x28_first_element",
    with_sql(E, select="SELECT event_id, CASE WHEN k % 4 > 0 THEN 1 * k END AS first_item FROM e"),
)
def _(spark, sf):
    items = F.when(F.col("k") % 4 > 0, F.transform(F.sequence(F.lit(1), F.col("k") % 4), lambda i: i * F.col("k")))
    return observations(spark, sf).select("event_id", F.get(items, F.lit(0)).alias("first_item"))


@query("x29_array_size", with_sql(E, select="SELECT event_id, k % 4 AS items FROM e"))
def _(spark, sf):
    items = F.filter(F.sequence(F.lit(0), F.col("k") % 4), lambda i: i > 0)
    return observations(spark, sf).select("event_id", F.size(items).alias("items"))


@query(
    "x30_json_round_trip",
    with_sql(
        E,
        select="""SELECT event_id, k, '{"area":' || CAST(user_id AS VARCHAR) || ',"kind":"' || event_type || '"}'
            AS encoded, user_id AS area FROM e""",
    ),
)
def _(spark, sf):
    encoded = F.to_json(F.struct(F.col("user_id").alias("area"), F.col("event_type").alias("kind")))
    return table(spark, sf, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        encoded.alias("encoded"),
        F.from_json(encoded, "area bigint, kind string")["area"].alias("area"),
    )


@query(
    "x31_batch_windows",
    """SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS slot_5m, time_bucket(INTERVAL 10 MINUTE, ts) AS slot_10m,
         CASE WHEN hour(ts) >= 21 THEN date_trunc('day', ts) + INTERVAL 21 HOUR
              WHEN hour(ts) < 9 THEN date_trunc('day', ts) - INTERVAL 3 HOUR END AS night FROM events""",
)
def _(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        clock.minute_slot(ts, 5).alias("slot_5m"),
        clock.minute_slot(ts, 10).alias("slot_10m"),
        clock.night_start(ts).alias("night"),
    )


@query(
    "x32_second_precision",
    """SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS seconds,
         CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS millis FROM events""",
)
def _(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        clock.truncated(ts, "second").alias("seconds"),
        clock.truncated(ts, "millisecond").alias("millis"),
    )


@query(
    "x33_iso_to_local",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('second', ts)
         ELSE date_trunc('second', ts) + INTERVAL 9 HOUR END AS local_ts FROM events""",
)
def _(spark, sf):
    kind = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    iso = (
        F.when(kind == "error", "not a time")
        .when(kind == "view", F.concat(stamp, F.lit("+09:00")))
        .otherwise(F.concat(stamp, F.lit("+00:00")))
    )
    return table(spark, sf, "events").select("event_id", clock.iso_to_local(iso).alias("local_ts"))


@query(
    "p13_missing_text_default",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS label FROM events",
)
def _(spark, sf):
    label = parsing.text_or_empty(F.nullif("event_type", F.lit("view")))
    return table(spark, sf, "events").select("event_id", label.alias("label"))


@query(
    "p15_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
)
def _(spark, sf):
    parts = [column.alias(name) for name, column in clock.date_parts(F.col("ts")).items()]
    return table(spark, sf, "events").select("event_id", *parts)
