"""Given tables in the roles of area documents, transit loads and dimensions.

Each event is read as one area document: the user is the area and the event time
is the file minute.  Payload texts are derived from the row's own columns, with
blanks, sentinels and malformed values by event type.  Each Spark frame has its
SQL counterpart next to it, written directly against the typed results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts as c
from areaflow import session
from areaflow.functions import keys
from areaflow.queries.registry import RUN_TS, table
from areaflow.sources import paths, raw, sinks

RUN = f"TIMESTAMP '{RUN_TS}'"
#: Documents of a landed file at most: a compressed file is read by one task.
FILE_DOCUMENTS = 250_000


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their properties as ``k``."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


# SQL: events with k, area code and file minute.
E = """
e AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         printf('POI%03d', user_id) AS area_code, 'area ' || CAST(user_id AS VARCHAR) AS area_name,
         date_trunc('minute', ts) AS m
  FROM events
)"""


# Payload texts as SQL expressions over an observation, by payload field; fields
# that are not listed are NULL.
_MONEY = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"

_CATEGORY_TEXTS = {
    "RSB_LRG_CTGR": "'Brand#' || CAST(i + k % 20 AS STRING)",
    "RSB_MID_CTGR": "CASE event_type WHEN 'click' THEN 'ECONOMY' WHEN 'view' THEN 'SMALL' "
    "WHEN 'signup' THEN 'STANDARD' END",
    "RSB_PAYMENT_LVL": "event_type || ' payments in this category'",
    "RSB_SH_PAYMENT_CNT": "CAST(k * i AS STRING) || '.9'",
    "RSB_SH_PAYMENT_AMT_MIN": _MONEY,
    "RSB_SH_PAYMENT_AMT_MAX": "''",
    "RSB_MCT_CNT": "CAST(i AS STRING)",
    "RSB_MCT_TIME": "date_format(ts, 'yyyyMMdd')",
}
_COMMERCIAL_TEXTS = {
    c.COMMERCIAL_TIME: f"CASE WHEN event_type = 'error' THEN 'n/a' ELSE date_format(ts, '{c.COMPACT_MINUTE}') END",
    "AREA_CMRCL_LVL": "nullif(event_type, 'view')",
    "AREA_SH_PAYMENT_CNT": "CAST(k AS STRING) || '.7'",
    "AREA_SH_PAYMENT_AMT_MIN": _MONEY,
    "AREA_SH_PAYMENT_AMT_MAX": "CASE WHEN event_type = 'click' THEN 'abc' ELSE CAST(k * 1000 AS STRING) END",
    "CMRCL_MALE_RATE": "CAST(k AS STRING) || '.125'",
    "CMRCL_FEMALE_RATE": "CAST(99 - k AS STRING) || '.874'",
    "CMRCL_10_RATE": _MONEY,
    "CMRCL_20_RATE": "''",
    "CMRCL_30_RATE": "'nan'",
    "CMRCL_40_RATE": "CAST(k AS STRING) || '000'",
    "CMRCL_50_RATE": "CAST(k AS STRING)",
    "CMRCL_PERSONAL_RATE": "CAST(k AS STRING) || '.5'",
    "CMRCL_CORPORATION_RATE": "'-' || CAST(k AS STRING) || '.005'",
}


def _population_texts(minutes: int, factor: int) -> dict[str, str]:
    return {
        "AREA_NM": "area_name",
        "AREA_CD": "area_code",
        "AREA_CONGEST_LVL": "event_type",
        "AREA_CONGEST_MSG": "nullif(event_type, 'view')",
        "AREA_PPLTN_MIN": f"CAST(k * 10 * {factor} AS STRING) || '.9'",
        "AREA_PPLTN_MAX": f"CAST(k * 10 * {factor} + 100 AS STRING)",
        "MALE_PPLTN_RATE": _MONEY,
        "FEMALE_PPLTN_RATE": "'?'",
        "PPLTN_RATE_0": "CAST(k AS STRING) || '.5'",
        "PPLTN_RATE_10": "CAST(k AS STRING)",
        "RESNT_PPLTN_RATE": "CAST(k AS STRING) || '.25'",
        "NON_RESNT_PPLTN_RATE": "CAST(99 - k AS STRING) || '.75'",
        "REPLACE_YN": "CASE event_type WHEN 'click' THEN 'Y' WHEN 'view' THEN 'N' END",
        c.POPULATION_TIME: "CASE WHEN event_type = 'error' THEN 'soon' ELSE "
        f"date_format(ts + INTERVAL {minutes} MINUTE, '{c.DASHED_MINUTE}') END",
    }


_EVENT_TEXTS = {
    "EVENT_NM": "'event ' || CAST(k AS STRING)",
    "EVENT_PERIOD": "date_format(ts, 'yyyy-MM-') || IF(i = 1, '01 ~ ' || date_format(ts, 'yyyy-MM-') || '28', '02~')",
    "EVENT_PLACE": "event_type",
    "EVENT_X": "CASE WHEN event_type = 'view' THEN '' ELSE '126.0' || CAST(k AS STRING) END",
    "EVENT_Y": "'37.5'",
    "PAY_YN": "CASE event_type WHEN 'click' THEN 'Y' WHEN 'view' THEN 'N' WHEN 'signup' THEN 'maybe' END",
    "URL": "'https://example.org/' || CAST(k AS STRING)",
    "EVENT_ETC_DETAIL": "''",
}
_WEATHER_TEXTS = {
    "TEMP": _MONEY,
    "SENSIBLE_TEMP": "'-'",
    "MAX_TEMP": "CAST(k AS STRING) || '.5'",
    "HUMIDITY": "CASE WHEN event_type = 'click' THEN '12.5' ELSE CAST(k AS STRING) END",
    "WIND_DIRCT": "CASE event_type WHEN 'click' THEN 'N' WHEN 'view' THEN 'SW' WHEN 'signup' THEN 'E' END",
    "PRECIPITATION": "'-'",
    "PRECPT_TYPE": "nullif(event_type, 'view')",
    "UV_INDEX_LVL": "CAST(k % 11 AS STRING)",
    "PM25": "'n/a'",
    "PM10": "CAST(100 - k AS STRING)",
    "AIR_IDX_MVL": f"CASE WHEN event_type = 'error' THEN '{c.UNDER_INSPECTION}' ELSE {_MONEY} END",
    # the day as the observation time, so that observations repeat
    c.WEATHER_TIME: "date_format(ts, 'yyyy-MM-dd') || ' 00:00'",
}


def _transit_texts(feed: c.Transit, months: str) -> dict[str, str]:
    texts = {
        f.raw: f"CAST(k + {i} AS STRING) || '.0'"
        for i, f in enumerate(c.transit_fields(feed)[:-2])
        if i % 5 != 4
    }
    texts[f"{feed.prefix}_STN_CNT"] = "CAST(k AS STRING)"
    texts[f"{feed.prefix}_{c.TRANSIT_TIME_STEM}"] = f"CASE event_type {months} END"
    return texts


def _struct(kind: T.StructType, texts: dict[str, str]) -> str:
    """A struct expression of the schema's fields."""
    parts = (f"'{f.name}', {texts.get(f.name, f'CAST(NULL AS {f.dataType.simpleString()})')}" for f in kind.fields)
    return f"named_struct({', '.join(parts)})"


def _copies(count: str, element: str) -> str:
    """``count`` elements numbered from 1; no array at all when zero."""
    return f"CASE WHEN {count} > 0 THEN transform(sequence(1, {count}), i -> {element}) END"


def _payloads() -> dict[str, str]:
    def kind(name: str) -> T.StructType:
        found = c.RAW_DOCUMENT[name].dataType
        return found.elementType if isinstance(found, T.ArrayType) else found

    categories = kind(c.COMMERCIAL)[c.CATEGORY_ARRAY].dataType.elementType
    items = _copies("k % 4", _struct(categories, _CATEGORY_TEXTS))
    crowd, later = (_struct(kind(c.POPULATION), _population_texts(*p)) for p in ((0, 1), (1, 2)))
    return {
        c.AREA_CODE: "area_code",
        c.AREA_NAME: "area_name",
        c.COMMERCIAL: _struct(kind(c.COMMERCIAL), {**_COMMERCIAL_TEXTS, c.CATEGORY_ARRAY: items}),
        c.POPULATION: f"CASE WHEN event_type = 'purchase' THEN array({crowd}, {later}) ELSE array({crowd}) END",
        c.EVENT: _copies("k % 3", _struct(kind(c.EVENT), _EVENT_TEXTS)),
        c.WEATHER: f"array({_struct(kind(c.WEATHER), _WEATHER_TEXTS)})",
        c.SUBWAY.payload: _struct(
            kind(c.SUBWAY.payload),
            _transit_texts(
                c.SUBWAY,
                "WHEN 'click' THEN '2024-05' WHEN 'view' THEN '202406' WHEN 'signup' THEN 'bad' "
                "WHEN 'purchase' THEN '2024-07-01'",
            ),
        ),
        c.BUS.payload: _struct(
            kind(c.BUS.payload),
            _transit_texts(
                c.BUS, "WHEN 'click' THEN '2024-05-02' WHEN 'view' THEN '20240603' WHEN 'error' THEN '2024-08-01 10:30'"
            ),
        ),
    }


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area document per event, with its key parts."""
    return paths.with_key_parts(_written(session.spread(observations(spark, sf_dir)), "path"), F.col("path"))


def _written(observed: DataFrame, *keep: str) -> DataFrame:
    """Observations as documents, beside the columns kept; the key is their ``path``."""
    named = observed.withColumns(
        {
            "area_code": F.format_string("POI%03d", "user_id"),
            "area_name": F.concat(F.lit("area "), F.col("user_id").cast("string")),
            "path": raw_key(),
        }
    )
    payloads = [f"{expression} AS {name}" for name, expression in _payloads().items()]
    return named.selectExpr(*payloads, *keep)


def raw_key() -> Column:
    return F.concat(
        F.lit("raw-json/"), F.date_format("ts", "yyyyMMdd/HHmm"), F.lit("_"), F.col("user_id").cast("string"), F.lit(".json")
    )


def json_documents(spark: SparkSession, sf_dir: str, *payloads: str) -> DataFrame:
    """The documents as one JSON text each, next to their key; by default whole."""
    payload = F.struct(*(payloads or c.RAW_DOCUMENT.names))
    return documents(spark, sf_dir).select(F.to_json(payload).alias("body"), "path")


def parsed_documents(spark: SparkSession, sf_dir: str, *payloads: str) -> DataFrame:
    """Documents read back from JSON texts that hold the named payloads."""
    kept = [c.AREA_CODE, c.AREA_NAME, *payloads]
    docs = raw.from_json_text(json_documents(spark, sf_dir, *kept), F.col("body"), "path", payloads=kept)
    return paths.with_key_parts(docs, F.col("path"))


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as JSON files by day, as a collector would leave them.

    The key of a document stands in the file, because one file holds many.  The
    files are compressed: as plain text they take over a hundred times the room of
    the observations.
    """
    path = session.scratch(spark, "raw-json")
    landing = by_day(spark, sf_dir).write.partitionBy("ymd").option("compression", "gzip")
    landing.option("maxRecordsPerFile", FILE_DOCUMENTS).json(path)
    schema = T.StructType([*c.RAW_DOCUMENT.fields, T.StructField("key", T.StringType())])
    return paths.with_key_parts(spark.read.schema(schema).json(path), F.col("key"))


def by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with their ``key``, in the order of their day, ``ymd``, like ones together."""
    observed = observations(spark, sf_dir)
    keyed = paths.with_key_parts(observed.withColumn("path", raw_key()), F.col("path"))
    # a number, as the order of a text is not taken for that of the folders
    dated = keyed.select(*observed.columns, F.date_format("file_ts", "yyyyMMdd").cast("int").alias("ymd"))
    # moved and sorted as the narrow rows they come from; a document is made where it is written.
    # Most texts follow from the number and the type, and a compressor sees a few documents at a time.
    sorted_ = sinks.balanced(dated, ["ymd"]).sortWithinPartitions("ymd", "k", "event_type", "ts")
    return _written(sorted_, "path", "ymd").withColumnRenamed("path", "key")


# SQL: the source tables that follow from the documents.

SOURCE_COMMERCIAL = f"""
src_commercial AS (
  SELECT DISTINCT md5(area_code || '_' || strftime(m, '%Y-%m-%d %H:%M:%S')) AS source_id, area_code, area_name,
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS congestion_level,
    k AS total_payment_count,
    CAST(floor(value) AS INTEGER) AS payment_amount_min,
    CASE WHEN event_type <> 'click' THEN k * 1000 END AS payment_amount_max,
    CAST(k + 0.13 AS DECIMAL(5,2)) AS male_ratio,
    CAST(99 - k + 0.87 AS DECIMAL(5,2)) AS female_ratio,
    CAST(value AS DECIMAL(5,2)) AS age_10s_ratio,
    CAST(NULL AS DECIMAL(5,2)) AS age_20s_ratio,
    CAST(NULL AS DECIMAL(5,2)) AS age_30s_ratio,
    CASE WHEN k = 0 THEN CAST(0 AS DECIMAL(5,2)) END AS age_40s_ratio,
    CAST(k AS DECIMAL(5,2)) AS age_50s_ratio,
    CAST(NULL AS DECIMAL(5,2)) AS age_60s_ratio,
    CAST(k + 0.5 AS DECIMAL(5,2)) AS individual_consumer_ratio,
    CAST(-k - 0.01 AS DECIMAL(5,2)) AS corporate_consumer_ratio,
    m AS observed_at, {RUN} AS created_at
  FROM e WHERE event_type <> 'error'
)"""

SOURCE_CATEGORY = f"""
src_rsb AS (
  SELECT DISTINCT
    md5(md5(area_code || '_' || strftime(m, '%Y-%m-%d %H:%M:%S')) || '-' || 'Brand#' || CAST(i + k % 20 AS VARCHAR)
        || '-' || mid) AS commercial_id,
    md5(area_code || '_' || strftime(m, '%Y-%m-%d %H:%M:%S')) AS source_id,
    'Brand#' || CAST(i + k % 20 AS VARCHAR) AS category_large,
    mid AS category_medium,
    event_type || ' payments in this category' AS category_congestion_level,
    CAST(k * i AS INTEGER) AS category_payment_count,
    CAST(floor(value) AS INTEGER) AS category_payment_min,
    CAST(NULL AS INTEGER) AS category_payment_max,
    CAST(i AS INTEGER) AS merchant_count,
    strftime(m, '%Y%m%d') AS merchant_basis_month,
    m AS observed_at, {RUN} AS created_at
  FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i,
          CASE event_type WHEN 'click' THEN 'ECONOMY' WHEN 'view' THEN 'SMALL' WHEN 'signup' THEN 'STANDARD'
            ELSE '' END AS mid
        FROM e WHERE event_type <> 'error')
)"""

_POPULATION_COLUMNS = [f.column for f in c.POPULATION_FIELDS]

SOURCE_POPULATION = f"""
pop AS (
  SELECT area_name, area_code, event_type AS congestion_label,
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS congestion_message,
    k * 10 * f AS population_min, k * 10 * f + 100 AS population_max,
    CAST(value AS FLOAT) AS male_population_ratio, CAST(NULL AS FLOAT) AS female_population_ratio,
    CAST(k + 0.5 AS FLOAT) AS age_0s_ratio, CAST(k AS FLOAT) AS age_10s_ratio,
    CAST(NULL AS FLOAT) AS age_20s_ratio, CAST(NULL AS FLOAT) AS age_30s_ratio, CAST(NULL AS FLOAT) AS age_40s_ratio,
    CAST(NULL AS FLOAT) AS age_50s_ratio, CAST(NULL AS FLOAT) AS age_60s_ratio, CAST(NULL AS FLOAT) AS age_70s_ratio,
    CAST(k + 0.25 AS FLOAT) AS resident_ratio, CAST(99 - k + 0.75 AS FLOAT) AS non_resident_ratio,
    event_type = 'click' AS is_replaced,
    m + to_minutes(f - 1) AS observed_at, m AS file_ts
  FROM (SELECT *, unnest(CASE WHEN event_type = 'purchase' THEN [1, 2] ELSE [1] END) AS f
        FROM e WHERE event_type <> 'error')
),
src_population AS (
  SELECT md5(area_code || '_' || strftime(observed_at, '%Y-%m-%d %H:%M:%S')) AS source_id,
    {", ".join(_POPULATION_COLUMNS)}, observed_at, {RUN} AS created_at
  FROM (SELECT *, row_number() OVER (PARTITION BY area_code, observed_at
          ORDER BY file_ts, {", ".join(f"{n} NULLS LAST" for n in _POPULATION_COLUMNS)}) AS rn FROM pop)
  WHERE rn = 1
)"""

SOURCE_EVENT = f"""
src_event AS (
  SELECT area_code, area_name, 'event ' || CAST(k AS VARCHAR) AS event_name,
    CASE WHEN i = 1 THEN strftime(ts, '%Y-%m-01 ~ %Y-%m-28') ELSE strftime(ts, '%Y-%m-02~') END AS event_period,
    event_type AS event_place,
    CASE WHEN event_type <> 'view' THEN CAST('126.0' || CAST(k AS VARCHAR) AS DOUBLE) END AS event_x,
    CAST(37.5 AS DOUBLE) AS event_y,
    CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE END AS is_paid,
    CAST(NULL AS VARCHAR) AS thumbnail_url, 'https://example.org/' || CAST(k AS VARCHAR) AS event_url,
    '' AS event_extra_detail, CAST(date_trunc('day', ts) AS TIMESTAMP) AS observed_at, {RUN} AS created_at
  FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM e)
)"""

_WEATHER_NULLS = {
    "min_temperature": "FLOAT", "wind_speed": "FLOAT", "precipitation_message": "VARCHAR", "sunrise": "VARCHAR",
    "sunset": "VARCHAR", "uv_index_desc": "VARCHAR", "uv_message": "VARCHAR", "pm25_index": "VARCHAR",
    "pm10_index": "VARCHAR", "air_quality_index": "VARCHAR", "air_quality_main": "VARCHAR",
    "air_quality_message": "VARCHAR", "sensible_temperature": "FLOAT", "pm25_value": "INTEGER",
}

SOURCE_WEATHER = f"""
src_weather AS (
  SELECT md5(area_code || '_' || strftime(min(ts), '%Y-%m-%d 00:00:00')) AS source_id,
    area_code, max(area_name) AS area_name,
    CAST(max(value) AS FLOAT) AS temperature, CAST(max(k) + 0.5 AS FLOAT) AS max_temperature,
    max(CASE WHEN event_type <> 'click' THEN k END) AS humidity,
    max(CASE event_type WHEN 'click' THEN 'N' WHEN 'view' THEN 'SW' WHEN 'signup' THEN 'E' END) AS wind_direction,
    '-' AS precipitation, max(CASE WHEN event_type <> 'view' THEN event_type END) AS precipitation_type,
    max(k % 11) AS uv_index_level, max(100 - k) AS pm10_value,
    CAST(max(CASE WHEN event_type <> 'error' THEN value END) AS FLOAT) AS air_quality_value,
    {", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in _WEATHER_NULLS.items())},
    CAST(date_trunc('day', ts) AS TIMESTAMP) AS observed_at, {RUN} AS created_at
  FROM e GROUP BY area_code, date_trunc('day', ts)
)"""


def source_transit_sql(feed: c.Transit, months: str, valid: str) -> str:
    counts = ", ".join(
        f"{'0' if i % 5 == 4 else f'k + {i}'} AS {f.column}" for i, f in enumerate(c.TRANSIT_STEMS[:-2])
    )
    return f"""
src_{feed.label} AS (
  SELECT md5(area_code || '_' || strftime(m, '%Y-%m-%d %H:%M:%S')) AS source_id, area_code, area_name, {counts},
    k AS station_count, CASE event_type {months} END AS station_count_basis_month,
    {RUN} AS created_at, m AS observed_at
  FROM e WHERE event_type IN ({valid})
)"""


SOURCE_SUBWAY = source_transit_sql(
    c.SUBWAY,
    "WHEN 'click' THEN TIMESTAMP '2024-05-01' WHEN 'view' THEN TIMESTAMP '2024-06-01' "
    "WHEN 'purchase' THEN TIMESTAMP '2024-07-01'",
    "'click', 'view', 'signup', 'purchase'",
)
SOURCE_BUS = source_transit_sql(
    c.BUS,
    "WHEN 'click' THEN TIMESTAMP '2024-05-02' WHEN 'view' THEN TIMESTAMP '2024-06-03' "
    "WHEN 'error' THEN TIMESTAMP '2024-08-01 10:30:00'",
    "'click', 'view', 'error'",
)

# --- dimensions ----------------------------------------------------------------


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("area_id"), F.format_string("POI%03d", "s_suppkey").alias("area_code")
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("category_large"), F.col("p_type").alias("category_medium"))
        .agg(F.min("p_partkey").cast("int").alias("category_id"))
    )


def congestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the events that carry a payload; the error label is unknown."""
    return (
        table(spark, sf_dir, "events")
        .where("event_type <> 'signup'")
        .groupBy(F.col("event_type").alias("congestion_label"))
        .agg(F.min("event_id").cast("int").alias("congestion_id"))
    )


AREAS = """
dim_area AS (
  SELECT CAST(s_suppkey AS INTEGER) AS area_id, printf('POI%03d', s_suppkey) AS area_code FROM supplier
)"""
CATEGORIES = """
dim_category AS (
  SELECT p_brand AS category_large, p_type AS category_medium, CAST(min(p_partkey) AS INTEGER) AS category_id
  FROM part GROUP BY p_brand, p_type
)"""
CONGESTIONS = """
dim_congestion AS (
  SELECT event_type AS congestion_label, CAST(min(event_id) AS INTEGER) AS congestion_id
  FROM events WHERE event_type <> 'signup' GROUP BY event_type
)"""

# --- transit loads with repeated observations -----------------------------------

# Twenty years of minutes; an order key beyond them counts on in other areas, so
# that different orders never share an observation.
_MINUTES = 10512000
_AREA = f"(l_linenumber + 10 * CAST(floor(l_orderkey / {_MINUTES}) AS INT))"
_AREA_CODE = f"format_string('POI%03d', CAST({_AREA} AS INT))"
_AREA_CODE_SQL = f"printf('POI%03d', l_linenumber + 10 * (l_orderkey // {_MINUTES}))"


def transit_loads(spark: SparkSession, sf_dir: str, feed: c.Transit) -> DataFrame:
    """Line items as transit loads: open ones by bus, the others by subway."""
    status = F.col("l_linestatus")
    own = table(spark, sf_dir, "lineitem").where(status == "O" if feed == c.BUS else status != "O")
    counts = [f"CAST(l_quantity AS INT) + {i} AS {f.column}" for i, f in enumerate(c.TRANSIT_STEMS[:-2])]
    loads = own.selectExpr(
        f"{_AREA_CODE} AS area_code",
        "'line ' || CAST(l_linenumber AS STRING) AS area_name",
        *counts,
        "CAST(l_suppkey AS INT) AS station_count",
        "CAST(trunc(l_shipdate, 'month') AS TIMESTAMP_NTZ) AS station_count_basis_month",
        "l_shipdate AS created_at",
        f"timestampadd(MINUTE, CAST(l_orderkey % {_MINUTES} AS INT), timestamp_ntz'2000-01-01 00:00:00') AS observed_at",
    )
    return loads.withColumn("source_id", keys.source_id(F.col("area_code"), F.col("observed_at"))).select(
        *c.SOURCE_TABLES[feed.label].names
    )


_COUNTS = ", ".join(f"CAST(l_quantity AS INTEGER) + {i} AS {f.column}" for i, f in enumerate(c.TRANSIT_STEMS[:-2]))
_TIES = ", ".join(f"{f.column} DESC" for f in c.TRANSIT_STEMS)

TRANSIT_LOADS = f"""
loads AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'bus' ELSE 'subway' END AS transport_type,
    md5({_AREA_CODE_SQL} || '_' || strftime(
      TIMESTAMP '2000-01-01' + to_minutes(CAST(l_orderkey % {_MINUTES} AS INTEGER)), '%Y-%m-%d %H:%M:%S')) AS source_id,
    {_AREA_CODE_SQL} AS area_code, 'line ' || CAST(l_linenumber AS VARCHAR) AS area_name,
    {_COUNTS},
    CAST(l_suppkey AS INTEGER) AS station_count,
    CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS station_count_basis_month, l_shipdate AS created_at,
    TIMESTAMP '2000-01-01' + to_minutes(CAST(l_orderkey % {_MINUTES} AS INTEGER)) AS observed_at
  FROM lineitem
),
stg AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transport_type, observed_at, area_code
      ORDER BY created_at DESC NULLS FIRST, area_name DESC, {_TIES}) AS rn FROM loads)
  WHERE rn = 1
)"""


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select
