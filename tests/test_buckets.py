"""Facts bucketed by area and minute: equal to the plain join, no shuffle under it, dates pruned."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.plans import dashboards, serving
from areaflow.sources import buckets, files, journal, sinks
from areaflow.sources.tables import Warehouse

FIRST, END = dt.date(2025, 7, 2), dt.date(2025, 7, 5)


def order():
    return [F.col("area_id").asc(), F.col("time_key").asc()]


def fact(spark, feed, rows=6000, step=1):
    """Minutes of seven days; area 0 has a third of the rows, some lack an area."""
    at = F.timestamp_add("MINUTE", (F.col("id") * 7 * step % 10080).cast("int"), clock.wall("2025-07-01"))
    ids = spark.range(rows).withColumn("at", at)
    area = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 80)
    columns = {name: (F.col("id") % 97).cast("int").alias(name) for name in dashboards.INSIGHT[feed]}
    return ids.select(
        area.cast("int").alias("area_id"), F.date_format("at", "yyyyMMddHHmm").cast("bigint").alias("time_key"),
        *columns.values(), F.to_date("at").alias(sinks.DATE),
    )


@pytest.fixture()
def wh(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    for feed in dashboards.INSIGHT:
        sinks.write_partitions(fact(spark, feed), wh.path("fact", feed), [sinks.DATE])
    serving.keep_insight(wh, 4)
    return wh


def plain(wh):
    sides = (wh.existing("fact", f).where(F.col(sinks.DATE).between(F.lit(FIRST), F.lit(dt.date(2025, 7, 4)))) for f in dashboards.INSIGHT)
    return sorted(map(tuple, dashboards.insight(*sides, [], order()).collect()))


def bucketed(wh, *conditions):
    return sorted(map(tuple, serving.insight(wh, FIRST, END, conditions, order()).collect()))


def test_equal_to_the_plain_join_also_after_changes(spark, wh):
    assert bucketed(wh) == plain(wh) != []
    day, gone = dt.date(2025, 7, 3), dt.date(2025, 7, 4)
    changed = fact(spark, "population", 3000).where(F.col(sinks.DATE) == F.lit(day))
    sinks.replace_days(changed, wh.path("fact", "population"), [day, gone])
    serving.refresh_insight(wh, "population", [day, gone])
    assert bucketed(wh) == plain(wh) != []
    assert {r[1] // 10000 for r in bucketed(wh)} == {20250702, 20250703}
    sinks.write_partitions(fact(spark, "population", 2000), wh.path("fact", "population"), [sinks.DATE], keep_others=False)
    serving.refresh_insight(wh, "population", None)
    assert bucketed(wh) == plain(wh) != []


def test_no_exchange_under_the_join_and_dates_pruned(spark, wh):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = serving.insight(wh, FIRST, END, [F.col("male_ratio") >= 20], order())
        text = both._jdf.queryExecution().executedPlan().toString()
        join = text[text.index("SortMergeJoin") :]
        assert "Exchange" not in join
        scans = [part[: part.index("PushedFilters")] for part in join.split("PartitionFilters: ")[1:]]
        assert len(scans) == 2 and all("observed_date" in s and ">= 2025-07-02" in s for s in scans)
        assert "Bucketed: true" in join and "/fact/" not in join
        assert sorted(map(tuple, both.collect())) == bucketed(wh, F.col("male_ratio") >= 20)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_session_that_does_not_know_the_table_registers_it(spark, wh):
    known = bucketed(wh)
    for feed in dashboards.INSIGHT:
        spark.sql(f"DROP TABLE {buckets._table_name(wh.path('insight', feed))}")
    assert bucketed(wh) == known


def test_a_hot_area_is_spread(spark, wh):
    side = buckets.read(spark, wh.path("insight", "commercial")).where("area_id = 0")
    per = side.groupBy(F.regexp_extract(F.col("_metadata.file_name"), "_([0-9]{5})[.]", 1)).count().collect()
    assert len(per) == 4 and max(r["count"] for r in per) < 0.4 * sum(r["count"] for r in per)


def test_a_rewrite_that_dies_is_finished_or_left(spark, wh, monkeypatch):
    known, day = bucketed(wh), dt.date(2025, 7, 3)
    path = wh.path("insight", "population")

    def die(*args):
        raise RuntimeError("lost")

    empty = buckets.read(spark, path).limit(0)
    monkeypatch.setattr(journal, "_finish", die)
    with pytest.raises(RuntimeError):
        buckets.replace_days(empty, path, [day])
    assert bucketed(wh) == known
    monkeypatch.undo()
    assert journal.recover(spark, path) == 1
    assert bucketed(wh) == [r for r in known if r[1] // 10000 != 20250703]


def test_nothing_is_kept_unless_asked_for(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "other"))
    sinks.write_partitions(fact(spark, "commercial", 10), wh.path("fact", "commercial"), [sinks.DATE])
    serving.refresh_insight(wh, "commercial", None)
    assert not files.exists(spark, wh.path("insight", "commercial"))


def test_an_empty_fact_gives_an_empty_view(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "empty"))
    for feed in dashboards.INSIGHT:
        sinks.write_partitions(fact(spark, feed, 5), wh.path("fact", feed), [sinks.DATE])
    serving.keep_insight(wh, 2)
    buckets.create(serving._side(wh.existing("fact", "commercial").limit(0), "commercial"), wh.path("insight", "commercial"), serving.INSIGHT_KEYS, 2)
    assert bucketed(wh) == []
