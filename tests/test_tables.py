"""Table changes: properties of merges and replacement loads."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areaflow.operators import dedupe, incremental, lookup
from areaflow.sources import files, journal, sinks

SCHEMA = "id int, day int, v string"


def rows(spark, *values):
    df = spark.createDataFrame(list(values), SCHEMA)
    date = F.when(F.col("day").isNotNull(), F.date_add(F.lit(dt.date(2025, 7, 1)), F.col("day")))
    at = F.timestamp_add("DAY", F.col("day"), F.lit("2025-07-01 12:00:00").cast("timestamp_ntz"))
    return df.withColumns({sinks.DATE: date, "at": at})


def content(spark, path):
    return sorted((r.id, r.day, r.v) for r in spark.read.parquet(path).collect())


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "table")


def test_upsert_replaces_and_adds(spark, path):
    sinks.upsert(rows(spark, (1, 0, "a"), (2, 1, "a"), (3, 2, "a")), path, ["id"])
    untouched = {f for f in _files(path) if "07-03" in f}
    batch = rows(spark, (2, 1, "b"), (4, 0, "b"))
    for _again in range(2):
        sinks.upsert(batch, path, ["id"])
        assert content(spark, path) == [(1, 0, "a"), (2, 1, "b"), (3, 2, "a"), (4, 0, "b")]
    assert untouched <= set(_files(path))


def _files(path):
    import glob

    return glob.glob(f"{path}/*/*.parquet")


def test_upsert_of_nothing(spark, path):
    empty = rows(spark, (1, 0, "a")).where("false")
    sinks.upsert(empty, path, ["id"])
    assert not files.exists(spark, path)
    sinks.upsert(rows(spark, (1, 0, "a")), path, ["id"])
    sinks.upsert(empty, path, ["id"])
    assert content(spark, path) == [(1, 0, "a")]


def test_upsert_without_a_date(spark, path):
    sinks.upsert(rows(spark, (1, 0, "a"), (2, None, "a")), path, ["id"])
    sinks.upsert(rows(spark, (2, None, "b")), path, ["id"])
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_upsert_unpartitioned(spark, path):
    sinks.upsert(rows(spark, (1, 0, "a"), (2, 1, "a")), path, ["id"], by=None)
    sinks.upsert(rows(spark, (2, 1, "b")), path, ["id"], by=None)
    assert content(spark, path) == [(1, 0, "a"), (2, 1, "b")]


def test_upsert_rejects_repeated_keys(spark, path):
    with pytest.raises(ValueError, match="duplicate"):
        sinks.upsert(rows(spark, (1, 0, "a"), (1, 0, "b")), path, ["id"])


def test_replace_range_bounds(spark, path):
    sinks.write_partitions(rows(spark, *[(i, i, "a") for i in range(5)]), path, [sinks.DATE])
    low, high = dt.datetime(2025, 7, 2, 12), dt.datetime(2025, 7, 4, 12)
    sinks.replace_range(rows(spark, (9, 1, "b")), path, "at", low, high, closed=False)
    assert content(spark, path) == [(0, 0, "a"), (3, 3, "a"), (4, 4, "a"), (9, 1, "b")]
    sinks.replace_range(rows(spark, (8, 3, "c")), path, "at", low, high)
    assert content(spark, path) == [(0, 0, "a"), (4, 4, "a"), (8, 3, "c")]
    sinks.replace_range(rows(spark, (8, 3, "c")).where("false"), path, "at", low, high)
    assert content(spark, path) == [(0, 0, "a"), (4, 4, "a")]


def test_replace_key_then_emptied_table(spark, path):
    noon = dt.datetime(2025, 7, 1, 12)
    sinks.replace_key(rows(spark, (1, 0, "a")), path, "at", noon)
    sinks.replace_key(rows(spark, (2, 0, "b")), path, "at", noon)
    assert content(spark, path) == [(2, 0, "b")]
    sinks.replace_key(rows(spark, (2, 0, "b")).where("false"), path, "at", noon)
    sinks.replace_key(rows(spark, (3, 0, "c")), path, "at", noon)
    assert content(spark, path) == [(3, 0, "c")]


def test_insert_if_absent(spark, path):
    noon = dt.datetime(2025, 7, 1, 12)
    assert sinks.insert_if_absent(rows(spark, (1, 0, "a")), path, "at", noon)
    assert not sinks.insert_if_absent(rows(spark, (2, 0, "b")), path, "at", noon)
    assert content(spark, path) == [(1, 0, "a")]


def test_insert_only_appends_columns(spark, path):
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.insert_only(first, path, ["id"])
    second = spark.createDataFrame([(1, "b", 5), (2, "b", 5)], "id int, v string, w int")
    for _again in range(2):
        sinks.insert_only(second, path, ["id"])
    stored = spark.read.option("mergeSchema", True).parquet(path)
    assert sorted(tuple(r) for r in stored.select("id", "v", "w").collect()) == [(1, "a", None), (2, "b", 5)]


def test_positional_append_checks_types(spark, path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError, match="positional"):
        sinks.append_positional(df.select("v", "id"), path, df.schema)


def test_watermark_of_empty_target(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    assert incremental.since(df, df.where("false"), F.col("id"), "id").count() == 2
    assert incremental.since(df, df.where("id = 1"), F.col("id"), "id").count() == 1
    assert incremental.since(df, None, F.col("id"), "id").count() == 2


def test_ranking_the_increment_equals_ranking_everything(spark):
    """Latest-wins over new rows only, then the watermark, gives the full result."""
    stamps = [None, "2025-07-01 10:00:00", "2025-07-02 10:00:00", "2025-07-03 10:00:00"]
    cases = [(k, stamps[i], i) for k in range(16) for i in range(4) if (k >> i) & 1]
    df = spark.createDataFrame(cases, "k int, s string, v int").withColumn("t", F.col("s").cast("timestamp_ntz"))
    built = df.where("s = '2025-07-01 10:00:00'")

    def result(rows):
        latest = dedupe.latest_wins(rows, ["k"], "t", [F.col("v").desc()])
        return sorted((r.k, r.v) for r in incremental.since(latest, built, F.col("t"), "t").collect())

    assert result(df) == result(incremental.since_or_unknown(df, built, F.col("t"), "t")) != []


def test_event_time_bound(spark):
    built = spark.createDataFrame([(202507052359,)], "time_key long")
    assert incremental.event_time_bound(built) == dt.datetime(2025, 7, 6)
    assert incremental.event_time_bound(built, 60) == dt.datetime(2025, 7, 5, 23)
    assert incremental.event_time_bound(built.where("false")) is None


def test_merge_is_idempotent(spark):
    target, batch = rows(spark, (1, 0, "a"), (2, 0, "a")), rows(spark, (2, 0, "b"), (3, 0, "b"))
    once = incremental.upsert(target, batch, ["id"])
    twice = incremental.upsert(once, batch, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_lookup_needs_unique_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    with pytest.raises(ValueError, match="duplicate"):
        lookup.require_unique(df, "id")
    assert lookup.require_unique(df.distinct(), "id").count() == 2


class _Died(Exception):
    pass


@pytest.mark.parametrize("by", [sinks.DATE, None])
def test_a_job_that_dies_at_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, by):
    """Every move, removal and record of a publish fails once; the next writer finds the old table or makes the new one."""
    before = rows(spark, (1, 0, "a"), (2, 1, "a"), (3, 2, "a"))
    # day 0 changes, day 1 loses its only row, day 3 is new
    low, high = dt.datetime(2025, 7, 1), dt.datetime(2025, 7, 2, 23)
    batch = rows(spark, (5, 0, "b"), (6, 3, "b"))
    old = [(1, 0, "a"), (2, 1, "a"), (3, 2, "a")]
    new = [(3, 2, "a"), (5, 0, "b"), (6, 3, "b")]

    def change(path):
        if by:
            sinks.replace_range(batch, path, "at", low, high)
        else:
            sinks.replace_prefix(batch.unionByName(before.where("id = 3")), path)

    failed, step = 0, 0
    while True:
        path = str(tmp_path / f"table-{step}")
        if by:
            sinks.write_partitions(before, path, [by])
        else:
            sinks.replace_prefix(before, path)
        calls = 0

        def counted(real):
            def call(*args):
                nonlocal calls
                calls += 1
                if calls == step + 1:
                    raise _Died
                return real(*args)

            return call

        with monkeypatch.context() as patch:
            for name in ("write_text", "rename", "remove", "make_folder"):
                patch.setattr(files, name, counted(getattr(files, name)))
            try:
                change(path)
                died = False
            except _Died:
                died = True
        intended = journal.recover(spark, path)
        found = content(spark, path)
        assert found == new if intended or not died else found in (old, new)
        assert journal.recover(spark, path) == 0
        if found == old:
            change(path)
            assert content(spark, path) == new
        if not died:
            break
        failed += 1
        step += 1
    assert failed >= 6


def test_staged_rows_of_a_dead_writer_are_not_read(spark, path):
    sinks.write_partitions(rows(spark, (1, 0, "a")), path, [sinks.DATE])
    rows(spark, (9, 0, "x")).write.partitionBy(sinks.DATE).parquet(journal.staging(path))
    assert content(spark, path) == [(1, 0, "a")]
    assert journal.recover(spark, path) == 0
    sinks.upsert(rows(spark, (2, 0, "b")), path, ["id"])
    assert content(spark, path) == [(1, 0, "a"), (2, 0, "b")]


def test_a_failing_change_leaves_no_scratch(spark, path, tmp_path):
    sinks.upsert(rows(spark, (1, 0, "a")), path, ["id"])
    bad = rows(spark, (2, 0, "b")).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.upsert(bad, path, ["id"])
    assert content(spark, path) == [(1, 0, "a")]
    assert not list((tmp_path / "_publish" / "table").iterdir())
