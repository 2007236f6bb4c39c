"""Golden rows of every feed from small raw files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.plans import feeds
from areaflow.sources import raw
from tests.documents import document, land

RUN = dt.datetime(2025, 7, 6, 9)
AT = dt.datetime(2025, 7, 5, 23, 1)


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw"))
    land(base, 1, "20250705 2301")
    # same observation reported again by a later file
    land(base, 1, "20250705 2301", file_minute="20250705 2302")
    land(base, 2, "20250705 2359", document(2, "20250705 2359", EVENT_STTS=[], WEATHER_STTS=None,
         LIVE_CMRCL_STTS={"CMRCL_RSB": []}, LIVE_BUS_PPLTN={"BUS_STN_TIME": None}))
    land(base, 3, "20250706 0000", document(3, "20250706 0000", LIVE_CMRCL_STTS={"CMRCL_TIME": "soon"},
         LIVE_PPLTN_STTS=[{"PPLTN_TIME": "soon"}], EVENT_STTS=None))
    land(base, 4, "20250706 0900")
    return base


@pytest.fixture(scope="module")
def docs(spark, base):
    return raw.window(spark, base, dt.datetime(2025, 7, 5, 23), dt.datetime(2025, 7, 6, 9))


def test_window_is_half_open_and_crosses_midnight(docs):
    assert sorted({r[0] for r in docs.select("file_area_id").collect()}) == [1, 2, 3]


def test_window_without_files_is_empty(spark, base):
    empty = raw.window(spark, base, dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 2))
    assert empty.count() == 0
    assert feeds.weather(empty, RUN).count() == 0
    assert feeds.transit(empty, c.BUS, RUN).columns == c.SOURCE_TABLES["bus"].names


def test_commercial(docs):
    rows = {r.area_code: r for r in feeds.commercial(docs, RUN).collect()}
    assert sorted(rows) == ["POI001", "POI002"]
    r = rows["POI001"]
    assert (r.observed_at, r.created_at, r.congestion_level) == (AT, RUN, "busy")
    assert (r.total_payment_count, r.payment_amount_min, r.payment_amount_max) == (12, None, 9000)
    assert (r.male_ratio, r.female_ratio, r.age_10s_ratio) == (Decimal("55.13"), Decimal("44.90"), None)


def test_commercial_skips_processed(spark, docs):
    seen = spark.createDataFrame([(1, AT)], "area_id int, observed_at timestamp_ntz")
    assert [r.area_code for r in feeds.commercial(docs, RUN, seen).collect()] == ["POI002"]
    assert feeds.commercial_rsb(docs, RUN, seen).count() == 0


def test_categories(docs):
    rows = sorted((r.category_medium, r.category_payment_count) for r in feeds.commercial_rsb(docs, RUN).collect())
    assert rows == [("bar", None), ("cafe", 3)]
    assert feeds.commercial_rsb(docs, RUN, outer=True).count() == 3


def test_population(docs):
    rows = {r.area_code: r for r in feeds.population(docs, RUN).collect()}
    assert sorted(rows) == ["POI001", "POI002"]
    r = rows["POI001"]
    assert (r.population_min, r.population_max, r.male_population_ratio) == (100, 200, 48.5)
    assert r.is_replaced is False


def test_event(docs):
    rows = feeds.event(docs, RUN).collect()
    assert {(r.area_code, r.observed_at) for r in rows} == {("POI001", dt.datetime(2025, 7, 5))}
    assert (rows[0].event_x, rows[0].event_y, rows[0].is_paid) == (127.0, None, False)


def test_daily_slot_takes_first_file(spark, base):
    land(base, 7, "20250707 0031")
    land(base, 7, "20250707 0035")
    land(base, 7, "20250707 0101")
    slot = raw.daily_slot(spark, base, dt.date(2025, 7, 7))
    assert [r.file_hhmm for r in slot.collect()] == ["0031"]
    with pytest.raises(FileNotFoundError):
        raw.daily_slot(spark, base, dt.date(2031, 1, 1))


def test_transit(docs):
    bus = {r.area_code: r for r in feeds.transit(docs, c.BUS, RUN).where(F.col("observed_at") != AT).collect()}
    assert sorted(bus) == ["POI001", "POI003"]
    assert bus["POI001"].total_geton_population_min == 0
    assert bus["POI001"].station_count_basis_month == dt.datetime(2025, 6, 1)
    assert bus["POI001"].observed_at == dt.datetime(2025, 7, 5, 23, 2)
    subway = feeds.transit(docs, c.SUBWAY, RUN).collect()
    assert len(subway) == 4
    assert {r.getoff_5min_population_max for r in subway} == {10}


def test_weather_keeps_column_maxima(docs):
    rows = {r.area_code: r for r in feeds.weather(docs, RUN).collect()}
    assert sorted(rows) == ["POI001", "POI003"]
    r = rows["POI001"]
    assert (r.temperature, r.humidity, r.pm10_value, r.air_quality_value) == (21.5, None, 33, None)


@pytest.mark.parametrize(
    ("table", "build"),
    [
        ("commercial", lambda d: feeds.commercial(d, RUN)),
        ("commercial_rsb", lambda d: feeds.commercial_rsb(d, RUN)),
        ("population", lambda d: feeds.population(d, RUN)),
        ("event", lambda d: feeds.event(d, RUN)),
        ("bus", lambda d: feeds.transit(d, c.BUS, RUN)),
        ("subway", lambda d: feeds.transit(d, c.SUBWAY, RUN)),
        ("weather", lambda d: feeds.weather(d, RUN)),
    ],
)
def test_contract(docs, table, build):
    got = [(f.name, f.dataType) for f in build(docs).schema]
    assert got == [(f.name, f.dataType) for f in c.SOURCE_TABLES[table]]
