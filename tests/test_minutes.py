"""History as bitmaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.operators import history, minutes

SCHEMA = "area_id int, observed_at timestamp_ntz"


def at(text):
    return dt.datetime.fromisoformat(text)


def test_every_minute_of_a_date(spark):
    """All 1,440 minutes are one row, a hundred times smaller, and each is found again alone."""
    start = clock.wall("2025-07-05 00:00:00")
    day = spark.range(1440).select(F.lit(7).alias("area_id"), F.timestamp_add("MINUTE", F.col("id").cast("int"), start).alias("observed_at"))
    packed = minutes.pack(day)
    row = packed.collect()[0]
    assert len(row.bits) == minutes.BYTES and row.rest == [] and packed.count() == 1
    assert 1440 * (4 + 8 + 4) > 100 * (len(row.bits) + 4 + 8)
    assert sorted(minutes.unpack(packed).collect()) == sorted((7, r.observed_at, dt.date(2025, 7, 5)) for r in day.collect())
    for some in ("id % 7 = 3", "id in (0, 7, 8, 1439)", "id < 0"):
        some_minutes = spark.range(1440).where(some).select(
            F.lit(7).alias("area_id"), F.timestamp_add("MINUTE", F.col("id").cast("int"), start).alias("observed_at"))
        left = minutes.unseen(day, minutes.pack(some_minutes))
        assert left.count() == 1440 - some_minutes.count()
        assert left.join(some_minutes, ["area_id", "observed_at"]).count() == 0


def test_the_same_rows_as_the_join_of_rows(spark):
    """Off minutes, nulls, repeated entries, several loads and an empty history."""
    rows = [
        (1, at("2025-07-05T10:00:00")), (1, at("2025-07-05T10:00:30")), (1, at("2025-07-05T10:01:00.000001")), (1, at("2025-07-05T23:59:00")),
        (1, at("2025-07-06T10:00:00")), (2, at("2025-07-05T10:00:00")), (None, at("2025-07-05T10:00:00")), (1, None), (2, at("1999-12-31T00:00:00")),
    ]
    batch = spark.createDataFrame([(i, *r) for i, r in enumerate(rows * 2)], f"id int, {SCHEMA}")
    known = spark.createDataFrame(rows[1:2] + rows[2:5] + rows[1:2] + rows[6:8], SCHEMA).withColumn("load", F.col("area_id"))
    for past in (known, known.where("area_id = 9")):
        packed = minutes.merged(minutes.pack(past, by=["load"]))
        assert sorted(map(tuple, history.unseen(batch, packed).collect())) == sorted(map(tuple, history.unseen(batch, past).collect()))
        assert packed.count() == past.dropna().select("area_id", F.to_date("observed_at")).distinct().count()
    named = batch.withColumnsRenamed({"area_id": "a", "observed_at": "t"})
    on = {"a": "area_id", "t": "observed_at"}
    assert history.unseen(named, minutes.merged(minutes.pack(known)), on).count() == history.unseen(named, known, on).count()


def test_a_group_carries_its_own_size_and_a_list_is_made_once(spark, capsys):
    """Spark's bitmap aggregate has 4,096 bytes in every row it sends or sorts; a plain explode would make the list twice."""
    rows = [(i % 3, at(f"2025-07-05T{h:02d}:{i % 60:02d}:{s:02d}")) for i, (h, s) in enumerate([(0, 0), (1, 4), (23, 0), (7, 0), (7, 59)] * 60)]
    past = spark.createDataFrame(rows, SCHEMA).withColumn("load", F.minute("observed_at") % 4)
    read = minutes.unpack(minutes.merged(minutes.pack(past, by=["load"])))
    read.explain()
    plan = capsys.readouterr().out
    assert "bitmap" not in plan and "(size(" not in plan
    assert sorted((r.area_id, r.observed_at) for r in read.collect()) == sorted(set(rows))
