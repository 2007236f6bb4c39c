"""Field names, column names and types shared by every feed.

Everything in the text tables below is a fixed value: the payload field names
belong to the public city-data API, the column names and types to the warehouse
tables that existing queries read.  Each table row is

    column  payload-field  rule

where the rule names a parser in :mod:`areaflow.functions.parsing`.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Field(NamedTuple):
    column: str
    raw: str
    rule: str


class Transit(NamedTuple):
    payload: str
    prefix: str
    label: str


def _fields(table: str) -> list[Field]:
    return [Field(*line.split()) for line in table.strip().splitlines()]


RULE_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "text_or_empty": T.StringType(),
    "int_truncating": T.IntegerType(),
    "int_strict": T.IntegerType(),
    "int_or_zero": T.IntegerType(),
    "real": T.FloatType(),
    "real_unless_sentinel": T.FloatType(),
    "coordinate": T.DoubleType(),
    "ratio": T.DecimalType(5, 2),
    "yes_no": T.BooleanType(),
    "is_yes": T.BooleanType(),
    "basis_month": T.TimestampNTZType(),
}

# --- fixed values: payload fields and column contracts -----------------------

AREA_CODE = "AREA_CD"
AREA_NAME = "AREA_NM"

COMMERCIAL = "LIVE_CMRCL_STTS"
COMMERCIAL_TIME = "CMRCL_TIME"
COMMERCIAL_FIELDS = _fields("""
congestion_level           AREA_CMRCL_LVL           text_or_empty
total_payment_count        AREA_SH_PAYMENT_CNT      int_truncating
payment_amount_min         AREA_SH_PAYMENT_AMT_MIN  int_truncating
payment_amount_max         AREA_SH_PAYMENT_AMT_MAX  int_truncating
male_ratio                 CMRCL_MALE_RATE          ratio
female_ratio               CMRCL_FEMALE_RATE        ratio
age_10s_ratio              CMRCL_10_RATE            ratio
age_20s_ratio              CMRCL_20_RATE            ratio
age_30s_ratio              CMRCL_30_RATE            ratio
age_40s_ratio              CMRCL_40_RATE            ratio
age_50s_ratio              CMRCL_50_RATE            ratio
age_60s_ratio              CMRCL_60_RATE            ratio
individual_consumer_ratio  CMRCL_PERSONAL_RATE      ratio
corporate_consumer_ratio   CMRCL_CORPORATION_RATE   ratio
""")

CATEGORY_ARRAY = "CMRCL_RSB"
CATEGORY_FIELDS = _fields("""
category_large             RSB_LRG_CTGR             text_or_empty
category_medium            RSB_MID_CTGR             text_or_empty
category_congestion_level  RSB_PAYMENT_LVL          text_or_empty
category_payment_count     RSB_SH_PAYMENT_CNT       int_truncating
category_payment_min       RSB_SH_PAYMENT_AMT_MIN   int_truncating
category_payment_max       RSB_SH_PAYMENT_AMT_MAX   int_truncating
merchant_count             RSB_MCT_CNT              int_truncating
merchant_basis_month       RSB_MCT_TIME             text_or_empty
""")

POPULATION = "LIVE_PPLTN_STTS"
POPULATION_TIME = "PPLTN_TIME"
POPULATION_FIELDS = _fields("""
area_name                AREA_NM               text_or_empty
area_code                AREA_CD               text_or_empty
congestion_label         AREA_CONGEST_LVL      text_or_empty
congestion_message       AREA_CONGEST_MSG      text_or_empty
population_min           AREA_PPLTN_MIN        int_truncating
population_max           AREA_PPLTN_MAX        int_truncating
male_population_ratio    MALE_PPLTN_RATE       real
female_population_ratio  FEMALE_PPLTN_RATE     real
age_0s_ratio             PPLTN_RATE_0          real
age_10s_ratio            PPLTN_RATE_10         real
age_20s_ratio            PPLTN_RATE_20         real
age_30s_ratio            PPLTN_RATE_30         real
age_40s_ratio            PPLTN_RATE_40         real
age_50s_ratio            PPLTN_RATE_50         real
age_60s_ratio            PPLTN_RATE_60         real
age_70s_ratio            PPLTN_RATE_70         real
resident_ratio           RESNT_PPLTN_RATE      real
non_resident_ratio       NON_RESNT_PPLTN_RATE  real
is_replaced              REPLACE_YN            is_yes
""")

EVENT = "EVENT_STTS"
EVENT_FIELDS = _fields("""
event_name          EVENT_NM          text
event_period        EVENT_PERIOD      text
event_place         EVENT_PLACE       text
event_x             EVENT_X           coordinate
event_y             EVENT_Y           coordinate
is_paid             PAY_YN            yes_no
thumbnail_url       THUMBNAIL         text
event_url           URL               text
event_extra_detail  EVENT_ETC_DETAIL  text
""")

WEATHER = "WEATHER_STTS"
WEATHER_TIME = "WEATHER_TIME"
WEATHER_FIELDS = _fields("""
temperature            TEMP           real
sensible_temperature   SENSIBLE_TEMP  real
max_temperature        MAX_TEMP       real
min_temperature        MIN_TEMP       real
humidity               HUMIDITY       int_strict
wind_direction         WIND_DIRCT     text
wind_speed             WIND_SPD       real
precipitation          PRECIPITATION  text
precipitation_type     PRECPT_TYPE    text
precipitation_message  PCP_MSG        text
sunrise                SUNRISE        text
sunset                 SUNSET         text
uv_index_level         UV_INDEX_LVL   int_strict
uv_index_desc          UV_INDEX       text
uv_message             UV_MSG         text
pm25_index             PM25_INDEX     text
pm25_value             PM25           int_strict
pm10_index             PM10_INDEX     text
pm10_value             PM10           int_strict
air_quality_index      AIR_IDX        text
air_quality_value      AIR_IDX_MVL    real_unless_sentinel
air_quality_main       AIR_IDX_MAIN   text
air_quality_message    AIR_MSG        text
""")
UNDER_INSPECTION = "점검중"

BUS = Transit("LIVE_BUS_PPLTN", "BUS", "bus")
SUBWAY = Transit("LIVE_SUB_PPLTN", "SUB", "subway")
TRANSIT_TIME_STEM = "STN_TIME"
TRANSIT_STEMS = _fields("""
total_geton_population_min    ACML_GTON_PPLTN_MIN     int_or_zero
total_geton_population_max    ACML_GTON_PPLTN_MAX     int_or_zero
total_getoff_population_min   ACML_GTOFF_PPLTN_MIN    int_or_zero
total_getoff_population_max   ACML_GTOFF_PPLTN_MAX    int_or_zero
geton_30min_population_min    30WTHN_GTON_PPLTN_MIN   int_or_zero
geton_30min_population_max    30WTHN_GTON_PPLTN_MAX   int_or_zero
getoff_30min_population_min   30WTHN_GTOFF_PPLTN_MIN  int_or_zero
getoff_30min_population_max   30WTHN_GTOFF_PPLTN_MAX  int_or_zero
geton_10min_population_min    10WTHN_GTON_PPLTN_MIN   int_or_zero
geton_10min_population_max    10WTHN_GTON_PPLTN_MAX   int_or_zero
getoff_10min_population_min   10WTHN_GTOFF_PPLTN_MIN  int_or_zero
getoff_10min_population_max   10WTHN_GTOFF_PPLTN_MAX  int_or_zero
geton_5min_population_min     5WTHN_GTON_PPLTN_MIN    int_or_zero
geton_5min_population_max     5WTHN_GTON_PPLTN_MAX    int_or_zero
getoff_5min_population_min    5WTHN_GTOFF_PPLTN_MIN   int_or_zero
getoff_5min_population_max    5WTHN_GTOFF_PPLTN_MAX   int_or_zero
station_count                 STN_CNT                 int_or_zero
station_count_basis_month     STN_TIME                basis_month
""")

COMPACT_MINUTE = "yyyyMMdd HHmm"
DASHED_MINUTE = "yyyy-MM-dd HH:mm"
DASHED_SECOND = "yyyy-MM-dd HH:mm:ss"
TIME_KEY = "yyyyMMddHHmm"
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
UTC = "UTC"
LOCAL_ZONE = "Asia/Seoul"
RAW_KEY = r"([0-9]{8})/([0-9]{4})_([0-9]+)[.]json$"

# --- schemas derived from the tables above -----------------------------------

_NTZ = T.TimestampNTZType()


def _raw_struct(fields: list[Field], *extra: str) -> T.StructType:
    """Leaves are read as text: the API mixes numbers, blanks and sentinels."""
    names = [f.raw for f in fields] + list(extra)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def transit_fields(feed: Transit) -> list[Field]:
    return [f._replace(raw=f"{feed.prefix}_{f.raw}") for f in TRANSIT_STEMS]


RAW_DOCUMENT = T.StructType(
    [
        T.StructField(AREA_CODE, T.StringType()),
        T.StructField(AREA_NAME, T.StringType()),
        T.StructField(
            COMMERCIAL,
            _raw_struct(COMMERCIAL_FIELDS, COMMERCIAL_TIME).add(
                CATEGORY_ARRAY, T.ArrayType(_raw_struct(CATEGORY_FIELDS))
            ),
        ),
        T.StructField(POPULATION, T.ArrayType(_raw_struct(POPULATION_FIELDS, POPULATION_TIME))),
        T.StructField(EVENT, T.ArrayType(_raw_struct(EVENT_FIELDS))),
        T.StructField(WEATHER, T.ArrayType(_raw_struct(WEATHER_FIELDS, WEATHER_TIME))),
        T.StructField(SUBWAY.payload, _raw_struct(transit_fields(SUBWAY))),
        T.StructField(BUS.payload, _raw_struct(transit_fields(BUS))),
    ]
)

HISTORY_DOCUMENT = "map<string,array<struct<observed_at:string,processed_at:string>>>"


def _table(*parts) -> T.StructType:
    out = T.StructType()
    for part in parts:
        if isinstance(part, list):
            for f in part:
                out.add(f.column, RULE_TYPES[f.rule])
        else:
            out.add(*part)
    return out


_SOURCE_ID = ("source_id", T.StringType())
_AREA = ("area_code", T.StringType()), ("area_name", T.StringType())
_OBSERVED = ("observed_at", _NTZ)
_CREATED = ("created_at", _NTZ)

SOURCE_TABLES: dict[str, T.StructType] = {
    "commercial": _table(_SOURCE_ID, *_AREA, COMMERCIAL_FIELDS, _OBSERVED, _CREATED),
    "commercial_rsb": _table(
        ("commercial_id", T.StringType()), _SOURCE_ID, CATEGORY_FIELDS, _OBSERVED, _CREATED
    ),
    "population": _table(_SOURCE_ID, POPULATION_FIELDS, _OBSERVED, _CREATED),
    "event": _table(*_AREA, EVENT_FIELDS, _OBSERVED, _CREATED),
    "bus": _table(_SOURCE_ID, *_AREA, TRANSIT_STEMS, _CREATED, _OBSERVED),
    "subway": _table(_SOURCE_ID, *_AREA, TRANSIT_STEMS, _CREATED, _OBSERVED),
    "weather": _table(_SOURCE_ID, *_AREA, WEATHER_FIELDS, _OBSERVED, _CREATED),
}

HISTORY_TABLE = _table(
    ("area_id", T.IntegerType()),
    _OBSERVED,
    ("processed_at", _NTZ),
    ("observed_date", T.DateType()),
    ("load_batch", T.StringType()),
)

HISTORY_MINUTES = _table(
    ("area_id", T.IntegerType()),
    ("bits", T.BinaryType()),
    ("rest", T.ArrayType(_NTZ)),
    ("processed_at", _NTZ),
    ("observed_date", T.DateType()),
    ("load_batch", T.StringType()),
)

DIMENSIONS: dict[str, T.StructType] = {
    "area": _table(("area_id", T.IntegerType()), ("area_code", T.StringType())),
    "category": _table(
        ("category_id", T.IntegerType()),
        ("category_large", T.StringType()),
        ("category_medium", T.StringType()),
    ),
    "congestion": _table(("congestion_id", T.IntegerType()), ("congestion_label", T.StringType())),
}
