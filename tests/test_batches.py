"""Loads and mart builds end to end on files."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts as c
from areaflow.operators import history
from areaflow.plans import batches, dashboards, feeds
from areaflow.sources import sinks
from areaflow.sources.tables import Warehouse
from areaflow.streaming import batches as streams
from tests.documents import document, land

RUN = dt.datetime(2025, 7, 6, 9, 30)
_SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("at", T.TimestampNTZType())])


@pytest.fixture()
def base(tmp_path):
    base = str(tmp_path / "raw")
    for area in (1, 2):
        for minute in ("20250705 2101", "20250705 2359", "20250706 0001", "20250706 0859"):
            land(base, area, minute)
        land(base, area, "20250706 0031")
    return base


@pytest.fixture()
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    areas = spark.createDataFrame([(1, "POI001"), (2, "POI002")], "area_id int, area_code string")
    sinks.replace_prefix(areas, wh.path("dim", "area"))
    categories = spark.createDataFrame([(5, "food", "cafe")], "category_id int, category_large string, category_medium string")
    sinks.replace_prefix(categories, wh.path("dim", "category"))
    labels = spark.createDataFrame([(7, "calm")], "congestion_id int, congestion_label string")
    sinks.replace_prefix(labels, wh.path("dim", "congestion"))
    return wh


def counts(wh):
    names = ["commercial", "commercial_rsb", "population", "bus", "subway", "weather"]
    return {n: wh.source(n).count() for n in names}


def test_night_load_twice(spark, base, wh):
    expected = {"commercial": 10, "commercial_rsb": 20, "population": 10, "bus": 10, "subway": 10, "weather": 10}
    batches.load_night(wh, base, RUN)
    assert counts(wh) == expected
    assert wh.history("commercial").count() == wh.history("population").count() == 10
    # a second file of the same observation, in a later window: nothing new to load
    land(base, 1, "20250706 0859", file_minute="20250706 0901")
    batches.load_window(wh, base, dt.datetime(2025, 7, 6, 9), dt.datetime(2025, 7, 6, 9, 5), RUN)
    after = counts(wh)
    assert (after["commercial"], after["commercial_rsb"], after["population"]) == (10, 20, 10)
    assert (after["bus"], after["weather"]) == (11, 10)
    assert wh.history("commercial").count() == 10


def test_marts_incremental_equals_full(spark, base, wh):
    batches.load_night(wh, base, RUN)
    batches.load_events(wh, base, dt.date(2025, 7, 6), RUN)
    batches.build_marts(wh, RUN)
    batches.build_event_marts(wh, RUN)
    land(base, 1, "20250706 0910")
    later = RUN + dt.timedelta(hours=1)
    batches.load_window(wh, base, dt.datetime(2025, 7, 6, 9), dt.datetime(2025, 7, 6, 9, 15), later)
    batches.build_marts(wh, later)
    batches.build_event_marts(wh, later)
    facts = ["commercial", "commercial_rsb", "population", "transport", "weather", "event"]
    built = {n: _keys(wh.existing("fact", n), n) for n in facts}
    assert {n: len(v) for n, v in built.items()} == {
        "commercial": 11, "commercial_rsb": 22, "population": 11, "transport": 22, "weather": 11, "event": 2,
    }
    assert wh.existing("dim", "event").count() == 1
    batches.build_marts(wh, later, full_refresh=True)
    batches.build_event_marts(wh, later, full_refresh=True)
    assert {n: _keys(wh.existing("fact", n), n) for n in facts} == built
    latest = dashboards.latest_snapshot(*[wh.existing("fact", n) for n in ("commercial", "population", "weather")])
    minutes = {r.area_id: r.commercial_time_key for r in latest.collect()}
    assert minutes == {1: 202507060910, 2: 202507060859}


def _keys(df, name):
    return sorted(r[0] for r in df.select(f"fact_{name}_id").collect())


def test_corrected_observation_keeps_the_first_document(spark, base, wh):
    """Two files report one observation with different numbers; the first is loaded."""
    changed = document(1, "20250705 2101", LIVE_CMRCL_STTS={"AREA_SH_PAYMENT_CNT": "99"})
    land(base, 1, "20250705 2101", changed, file_minute="20250705 2103")
    batches.load_night(wh, base, RUN)
    rows = wh.source("commercial").where("area_code = 'POI001' and observed_at = timestamp_ntz'2025-07-05 21:01:00'")
    assert [r.total_payment_count for r in rows.collect()] == [12]
    batches.build_marts(wh, RUN)
    assert wh.existing("fact", "commercial").count() == 10


def test_event_day_is_replaced(spark, base, wh):
    day = dt.date(2025, 7, 6)
    for _again in range(2):
        batches.load_events(wh, base, day, RUN)
    assert wh.source("event").count() == 2


def test_history_documents_round_trip(spark, base, wh, tmp_path):
    batches.load_night(wh, base, RUN)
    path = str(tmp_path / "history")
    sinks.write_history_documents(wh.history("commercial"), path)
    back = history.read_documents(spark, path)
    keys = ["area_id", "observed_at", "processed_at"]
    assert sorted(back.select(*keys).collect()) == sorted(wh.history("commercial").select(*keys).collect())


def test_history_of_one_large_document(spark, tmp_path):
    (tmp_path / "h.json").write_text(
        '{"POI001": [{"observed_at": "2025-07-05 23:01:00", "processed_at": "2025-07-05 23:05:00"},\n'
        ' {"observed_at": "bad", "processed_at": ""}], "2": []}'
    )
    rows = history.read_documents(spark, str(tmp_path / "h.json"), whole_file=True).collect()
    assert sorted((r.area_id, r.observed_at) for r in rows if r.observed_at) == [(1, dt.datetime(2025, 7, 5, 23, 1))]


def test_document_stream_equals_batch(spark, base, wh, tmp_path):
    """The transit feed by stream, one file at a time, against the batch load."""
    out = str(tmp_path / "bus")
    docs = streams.document_stream(spark, base, files_per_trigger=3)
    bus = feeds.transit(docs, c.BUS, RUN).withColumn(sinks.DATE, F.to_date("observed_at"))
    streams.run_available(bus, str(tmp_path / "cp"), streams.upsert_sink(out, ["source_id"], "created_at"))
    batches.load_night(wh, base, RUN)
    names = c.SOURCE_TABLES["bus"].names
    streamed = sorted(map(tuple, spark.read.parquet(out).select(*names).collect()), key=str)
    assert streamed == sorted(map(tuple, wh.source("bus").collect()), key=str)
    # nothing new: a second run adds nothing
    streams.run_available(bus, str(tmp_path / "cp"), streams.upsert_sink(out, ["source_id"], "created_at"))
    assert spark.read.parquet(out).count() == len(streamed)


def test_units_that_arrive_again_replace_themselves(spark, tmp_path):
    """A corrected unit takes the place of what it held; rows of other units in its range stay."""
    folder, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    schema = T.StructType([*_SCHEMA.fields, T.StructField("unit", T.StringType())])

    def drop(name, rows):
        (folder / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run():
        stream = streams.json_stream(spark, str(folder), schema).withColumn(sinks.DATE, F.to_date("at"))
        streams.run_available(stream, cp, streams.replace_unit_sink(out, "unit"))

    drop("a.json", [{"id": 1, "at": "2025-07-05T10:00:00", "unit": "x"}, {"id": 2, "at": "2025-07-06T11:00:00", "unit": "x"}])
    run()
    drop("b.json", [{"id": 3, "at": "2025-07-05T10:30:00", "unit": "y"}, {"id": 4, "at": "2025-07-07T11:30:00", "unit": "y"}])
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
    drop("c.json", [{"id": 5, "at": "2025-07-05T10:01:00", "unit": "x"}])
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [3, 4, 5]


def test_late_rows_drop_behind_the_watermark(spark, tmp_path):
    """Counts close once the watermark passes; a row later than the delay is dropped."""
    folder, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def run(name, *minutes):
        rows = [{"id": 1, "at": f"2025-07-05T{m}:00"} for m in minutes]
        (folder / name).write_text("\n".join(map(json.dumps, rows)))
        counted = streams.tumbling(streams.json_stream(spark, str(folder), _SCHEMA), "at", 5, "10 minutes")
        counted = counted.withColumn(sinks.DATE, F.to_date("slot"))
        streams.run_available(counted, cp, streams.append_sink(out, ["slot"]))

    run("a.json", "10:01", "10:02", "10:07", "12:00")
    run("b.json", "10:03", "12:30")
    run("c.json", "13:00")
    counts = {f"{r.slot:%H:%M}": r.n for r in spark.read.parquet(out).collect()}
    assert counts == {"10:00": 2, "10:05": 1, "12:00": 1, "12:30": 1}


def test_document_load_ignores_bad_keys(spark, base, wh):
    folder = f"{base}/20250705"
    with open(f"{folder}/2102-9.json", "w") as f:
        json.dump(document(9, "20250705 2102"), f)
    batches.load_night(wh, base, RUN)
    assert wh.source("commercial").where("area_code = 'POI009'").count() == 0


def test_windows_with_one_start_lose_nothing(spark, base, wh):
    """A short window, the night that starts with it, and the short one again after a late document."""
    start = dt.datetime(2025, 7, 5, 21)
    short = start + dt.timedelta(minutes=5)
    batches.load_window(wh, base, start, short, RUN)
    assert counts(wh)["commercial"] == counts(wh)["population"] == 2
    batches.load_night(wh, base, RUN)
    night = {"commercial": 10, "commercial_rsb": 20, "population": 10, "weather": 10}
    assert {n: counts(wh)[n] for n in night} == night
    land(base, 3, "20250705 2103")
    batches.load_window(wh, base, start, short, RUN)
    more = {"commercial": 11, "commercial_rsb": 22, "population": 11, "weather": 11}
    assert {n: counts(wh)[n] for n in more} == more
    assert wh.history("commercial").count() == wh.history("population").count() == 11
    # running everything once more changes nothing
    batches.load_window(wh, base, start, short, RUN)
    batches.load_night(wh, base, RUN)
    assert {n: counts(wh)[n] for n in more} == more
    assert wh.history("commercial").count() == 11


def test_weather_of_a_later_file_survives_a_repeat(spark, base, wh):
    start = dt.datetime(2025, 7, 5, 21)
    land(base, 4, "20250705 2109", file_minute="20250705 2112")
    batches.load_window(wh, base, start, start + dt.timedelta(minutes=10), RUN)
    batches.load_window(wh, base, start + dt.timedelta(minutes=10), start + dt.timedelta(minutes=20), RUN)
    before = counts(wh)["weather"]
    batches.load_window(wh, base, start, start + dt.timedelta(minutes=10), RUN)
    assert counts(wh)["weather"] == before == 3


def test_second_load_with_the_same_clock_reaches_the_facts(spark, base, wh):
    first, second = dt.datetime(2025, 7, 5, 21), dt.datetime(2025, 7, 6)
    batches.load_window(wh, base, first, first + dt.timedelta(hours=1), RUN)
    batches.build_marts(wh, RUN)
    batches.load_window(wh, base, second, second + dt.timedelta(hours=1), RUN)
    batches.build_marts(wh, RUN)
    for fact, rows in {"commercial": 6, "commercial_rsb": 12, "population": 6, "transport": 12, "weather": 6}.items():
        assert wh.existing("fact", fact).count() == rows, fact


def test_documents_without_an_area_are_refused(spark, base, wh):
    for minute in ("20250705 2101", "20250705 2102"):
        bad = document(9, minute)
        bad[c.AREA_CODE] = ""
        land(base, 9, minute, bad)
    batches.load_night(wh, base, RUN)
    refused = spark.read.parquet(wh.path("refused", "documents"))
    assert [r.reason for r in refused.collect()] == ["no area code"] * 2
    batches.build_marts(wh, RUN)
    assert wh.existing("fact", "commercial").count() == 10
    transport = wh.existing("fact", "transport")
    assert {(r.area_id, r.area_code) for r in transport.collect()} == {(1, "POI001"), (2, "POI002")}


def test_repeated_dimension_key_is_refused(spark, base, wh):
    areas = spark.createDataFrame([(1, "POI001"), (9, "POI001")], "area_id int, area_code string")
    sinks.replace_prefix(areas, wh.path("dim", "area"))
    batches.load_night(wh, base, RUN)
    with pytest.raises(ValueError, match="duplicate keys"):
        batches.build_marts(wh, RUN)


def test_any_window_lists_by_day(spark, base):
    """A window of minutes and one of a hundred days read by the same rule, and only their files."""
    from areaflow.sources import raw

    start = dt.datetime(2025, 7, 5, 21)
    for end, found in ((start + dt.timedelta(minutes=5), 2), (start + dt.timedelta(days=100), 10)):
        docs = raw.window(spark, base, start, end)
        assert docs.count() == found
        assert len({r.path for r in docs.select("path").collect()}) == found
