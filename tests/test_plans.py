"""Physical plans: what reaches the scan, what is combined before a shuffle, no Python."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.operators import dedupe, history, lookup
from areaflow.queries import QUERIES
from areaflow.sources import sinks, tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["d10_source_commercial", "d12_source_population", "d15_source_weather", "d33_fact_event", "d34_fact_population",
     "d35_fact_transport", "d50_latest_snapshot", "x14_one_decimal", "s9_key_parts"],
)
def test_no_python_and_no_rdd(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert node not in text


def test_latest_wins_limits_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["d20_stg_bus"](spark, sf_dir))
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["f4_half_open_range"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan(QUERIES["d30_dim_event"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text


def test_top_k_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["o1_topk_one_key"](spark, sf_dir))


def test_dimension_is_hash_aggregated(spark, sf_dir):
    assert "SortAggregate" not in plan(QUERIES["d30_dim_event"](spark, sf_dir))


def test_lookup_broadcasts_only_below_the_threshold(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    dim = spark.read.parquet(f"{sf_dir}/supplier.parquet")

    def joined():
        return plan(lookup.lookup(events, dim, {"user_id": "s_suppkey"}, {"s_name": "name"}))

    assert "BroadcastHashJoin" in joined()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "Broadcast" not in joined()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_and_hours_are_pruned(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = str(tmp_path / "history")
    seen = events.select(F.col("user_id").alias("area_id"), F.col("ts").alias("observed_at"))
    sinks.write_partitions(seen.withColumn(sinks.DATE, F.to_date("observed_at")), path, [sinks.DATE])
    window = history.within(spark.read.parquet(path), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))
    text = plan(window)
    assert "PartitionFilters: [isnotnull(observed_date" in text and "GreaterThanOrEqual(observed_at" in text
    hourly = str(tmp_path / "hours")
    day = events.where(F.to_date("ts") == F.lit(dt.date(2024, 1, 5)))
    dated = day.withColumns(clock.date_parts(F.col("ts")))
    sinks.write_partitions(dated, hourly, ["year", "month", "day", "hour"])
    hours = tables.hour_partitions(spark.read.parquet(hourly), dt.datetime(2024, 1, 5, 3), dt.datetime(2024, 1, 5, 6))
    assert len(hours.inputFiles()) > 3
    scan = plan(hours)
    partition_filters = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "make_timestamp_ntz" in partition_filters


def test_one_area_with_a_third_of_the_rows(spark, sf_dir):
    """A hot area gives the same rows as brute force under every duplicate policy."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn(
        "area", F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_suppkey"))
    )
    rows = [(r.area, r.l_shipdate, r.l_orderkey, r.l_extendedprice) for r in items.collect()]
    assert sum(r[0] == 0 for r in rows) > len(rows) / 5
    newest, best = {}, {}
    for area, shipped, order, price in rows:
        key = (shipped, order, price)
        newest[area] = max(newest.get(area, key), key)
        best[area] = tuple(map(max, best.get(area, key), key))
    ties = [F.col("l_orderkey").desc(), F.col("l_extendedprice").desc()]
    narrow = items.select("area", "l_shipdate", "l_orderkey", "l_extendedprice")
    kept = dedupe.latest_wins(narrow, ["area"], "l_shipdate", ties).collect()
    assert {r[0]: tuple(r)[1:] for r in kept} == newest
    assert {r[0]: tuple(r)[1:] for r in dedupe.max_wins(narrow, ["area"]).collect()} == best


def test_a_hot_partition_is_split(spark, tmp_path):
    """One day with most rows is written by several tasks, each other day by one."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        day = F.when(F.col("id") % 10 < 7, F.lit(dt.date(2025, 7, 1))).otherwise(
            F.date_add(F.lit(dt.date(2025, 7, 1)), (F.col("id") % 10).cast("int"))
        )
        rows = spark.range(0, 200000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("v"), day.alias("d"))
        path = str(tmp_path / "hot")
        sinks.write_partitions(rows, path, ["d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(path)
    named = back.select("d", F.col("_metadata.file_name").alias("name"))
    files = named.groupBy("d").agg(F.countDistinct("name").alias("n"), F.count("*").alias("rows"))
    found = {r.d: (r.n, r.rows) for r in files.collect()}
    assert found[dt.date(2025, 7, 1)][0] > 1
    assert sum(r[1] for r in found.values()) == 200000
