"""Builds from the load ledger: what is read, what a repeat changes, what is noted for later."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.functions import clock
from areaflow.plans import batches, builds
from areaflow.sources import files, ledger, sinks
from areaflow.sources.tables import Warehouse

RUN = dt.datetime(2025, 7, 6, 9, 30)


@pytest.fixture()
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    sinks.replace_prefix(spark.createDataFrame([(1, "POI001")], "area_id int, area_code string"), wh.path("dim", "area"))
    for name in ("category", "congestion"):
        sinks.replace_prefix(spark.createDataFrame([], c.DIMENSIONS[name]), wh.path("dim", name))
    return wh


def observations(spark, *rows):
    """Commercial observations: id, area, day and the load's clock."""
    df = spark.createDataFrame(list(rows), "source_id string, area_code string, day int, hour int")
    names = c.SOURCE_TABLES["commercial"]
    at = F.timestamp_add("DAY", F.col("day"), clock.wall("2025-07-01 12:00:00"))
    full = df.withColumns({"observed_at": at, "created_at": F.timestamp_add("HOUR", F.col("hour"), clock.wall("2025-07-06"))})
    absent = [f for f in names.fields if f.name not in full.columns]
    return full.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent]).select(*names.names)


def facts(wh):
    rows = wh.existing("fact", "commercial").select("fact_commercial_id", "area_id").collect()
    return sorted(tuple(r) for r in rows)


def run(wh):
    return batches.build_marts(wh, RUN, facts=["commercial"])


def test_loads_in_any_order_and_again(spark, wh):
    batches.store_load(wh, "commercial", observations(spark, ("a", "POI001", 0, 9), ("b", "POI001", 1, 9)), "x")
    assert run(wh) == ["commercial"]
    assert run(wh) == []
    batches.store_load(wh, "commercial", observations(spark, ("c", "POI001", 0, 3)), "y")
    assert run(wh) == ["commercial"]
    assert [r[0] for r in facts(wh)] == ["a", "b", "c"]
    # the first load again, without its rows of one day and with a new one
    batches.store_load(wh, "commercial", observations(spark, ("d", "POI001", 0, 9)), "x")
    run(wh)
    assert [r[0] for r in facts(wh)] == ["c", "d"]


def test_a_build_that_dies_before_its_record_runs_again(spark, wh, monkeypatch):
    batches.store_load(wh, "commercial", observations(spark, ("a", "POI001", 0, 9)), "x")
    run(wh)
    batches.store_load(wh, "commercial", observations(spark, ("b", "POI001", 0, 9)), "y")
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "mark_built", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            run(wh)
    assert run(wh) == ["commercial"]
    assert run(wh) == []
    assert [r[0] for r in facts(wh)] == ["a", "b"]


def test_unknown_areas_are_noted_once_and_repaired(spark, wh):
    rows = [(f"n{i}", "POI002", i % 2, 9) for i in range(6)] + [("a", "POI001", 0, 9), ("z", None, 0, 9)]
    batches.store_load(wh, "commercial", observations(spark, *rows), "x")
    run(wh)
    noted = spark.read.parquet(wh.path("pending", "commercial"))
    assert sorted((r.lookup, r["keys"][0], r[sinks.DATE].day) for r in noted.collect()) == [("area", "POI002", 1), ("area", "POI002", 2)]
    more = spark.createDataFrame([(1, "POI001"), (2, "POI002")], "area_id int, area_code string")
    sinks.replace_prefix(more, wh.path("dim", "area"))
    assert run(wh) == ["commercial"]
    assert facts(wh) == [("a", 1), *[(f"n{i}", 2) for i in range(6)], ("z", None)]
    assert wh.spark.read.schema(builds.PENDING).parquet(wh.path("pending", "commercial")).count() == 0
    assert run(wh) == []


def test_every_source_read_of_an_increment_is_pruned(spark, wh):
    for name in ("commercial", "commercial_rsb", "population", "bus", "subway", "weather", "event"):
        schema = c.SOURCE_TABLES[name]
        one = spark.createDataFrame([tuple([None] * len(schema))], schema).withColumn("observed_at", clock.wall("2025-07-01 12:00:00"))
        if name in ("weather", "event"):
            dated = one.withColumn(sinks.DATE, F.to_date("observed_at"))
            sinks.write_partitions(dated, wh.path("source", name), [sinks.DATE])
            ledger.record(wh, name, "x", [dt.date(2025, 7, 1)])
        else:
            batches.store_load(wh, name, one, "x")
    dims = {**builds.dimensions(wh), "event": spark.createDataFrame([("e",)], "event_id string")}
    for plan in builds.PLANS.values():
        unbuilt, _ = ledger.unbuilt(wh, plan.name, [*plan.sources, *([plan.parent] if plan.parent else [])])
        new = builds.New.of(unbuilt)
        frame = plan.frame(builds._frames(wh, plan, new.of_sources(plan.sources), new), dims, RUN)
        text = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in text.splitlines() if "FileScan" in line and "/source/" in line]
        assert scans, plan.name
        for scan in scans:
            assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan, scan
            assert "observed_date" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]


def test_a_source_from_before_the_ledger_is_adopted(spark, wh):
    rows = observations(spark, ("a", "POI001", 0, 9), ("b", "POI001", 1, 9))
    dated = rows.withColumns({sinks.DATE: F.to_date("observed_at"), "load_batch": F.lit("old")})
    sinks.write_partitions(dated, wh.path("source", "commercial"), [sinks.DATE, "load_batch"])
    assert run(wh) == ["commercial"]
    assert run(wh) == []
    assert len(facts(wh)) == 2


def test_ledger_files_stay_few(spark, wh, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_FILES", 3)
    for i in range(6):
        ledger.record(wh, "bus", f"load {i}", [])
    assert len(files.matching(spark, f"{wh.path('ledger', 'loads')}/*.parquet")) <= 4
    unbuilt, _ = ledger.unbuilt(wh, "transport", ["bus"])
    assert sorted(r.load for r in unbuilt.collect()) == [f"load {i}" for i in range(6)]


def state(wh):
    """The stored state, and the ranking of the whole fact it must equal."""
    kept = {r.area_id: (r.time_key, r.fact_commercial_id) for r in wh.existing("state", "commercial").collect()}
    whole: dict = {}
    for r in wh.existing("fact", "commercial").where("area_id is not null").collect():
        best = whole.get(r.area_id)
        if best is None or (-r.time_key, r.fact_commercial_id) < (-best[0], best[1]):
            whole[r.area_id] = (r.time_key, r.fact_commercial_id)
    return kept, whole


def test_state_follows_loads_replays_and_replaced_loads(spark, wh):
    more = spark.createDataFrame([(1, "POI001"), (2, "POI002")], "area_id int, area_code string")
    sinks.replace_prefix(more, wh.path("dim", "area"))
    loads = [
        ("old", [("a", "POI001", -40, 9), ("b", "POI002", -3, 9), ("c", "POI001", -9, 9)]),
        ("new", [("d", "POI001", 2, 9), ("e", "POI002", 2, 9)]),
        ("earlier", [("f", "POI001", 1, 3)]),
        ("new", [("d", "POI001", 2, 9), ("e", "POI002", 2, 9)]),
        ("new", [("e", "POI002", 2, 9)]),
        ("earlier", [("g", "POI002", 0, 3)]),
        ("old", [("a", "POI001", -40, 9)]),
    ]
    for name, rows in loads:
        batches.store_load(wh, "commercial", observations(spark, *rows), name)
        run(wh)
        kept, whole = state(wh)
        assert kept == whole, (name, rows)
    assert set(kept) == {1, 2}


def test_dashboards_read_no_fact(spark, wh):
    from areaflow.plans import serving

    names = c.SOURCE_TABLES["population"]
    row = spark.createDataFrame([tuple([None] * len(names))], names)
    filled = row.withColumns({"source_id": F.lit("a"), "area_code": F.lit("POI001"), "observed_at": clock.wall("2025-06-25 08:00:00"),
                              "population_min": F.lit(3), "population_max": F.lit(4)})
    batches.store_load(wh, "population", filled, "x")
    batches.build_marts(wh, RUN, facts=["population"])
    weekly = serving.weekly_stats(wh, dt.datetime(2025, 7, 2))
    assert [(r.area_id, r.weekday, r.hour, r.population_avg) for r in weekly.collect()] == [(1, 3, 8, 3.5)]
    text = weekly._jdf.queryExecution().executedPlan().toString()
    assert "/fact/" not in text and "observed_date" in text[text.index("PartitionFilters") : text.index("PushedFilters")]
