"""Units in pieces, the index from units to dates, and rows behind the watermark."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from areaflow.sources import files, sinks
from areaflow.streaming import batches as streams

SCHEMA = "id int, at timestamp_ntz, unit string, size int"


@pytest.fixture()
def run(spark, tmp_path):
    """Lands rows as one file and runs over it."""
    folder, out = tmp_path / "in", str(tmp_path / "out" / "table")
    folder.mkdir()

    def run(name, *rows, patience_ms=60_000):
        lines = [json.dumps({"id": i, "at": f"2025-07-{day:02d}T10:00:00.000007", "unit": unit, "size": size}) for i, day, unit, size in rows]
        (folder / f"{name}.json").write_text("\n".join(lines))
        stream = streams.json_stream(spark, str(folder), spark.createDataFrame([], SCHEMA).schema)
        whole = streams.whole_units(stream.withColumn(sinks.DATE, F.to_date("at")), "unit", "size", patience_ms)
        streams.run_available(whole, str(tmp_path / "cp"), streams.replace_unit_sink(out, "unit"))
        if not files.exists(spark, out):
            return []
        found = spark.read.parquet(out)
        assert {r.at.microsecond for r in found.collect()} == {7}
        return sorted((r.id, r.unit, r.complete) for r in found.collect())

    return run


def test_a_unit_over_several_triggers_loses_nothing(run, spark, tmp_path):
    assert run("a", (1, 1, "x", 3), (7, 1, "y", 1)) == [(7, "y", True)]
    assert run("b", (2, 2, "x", 3)) == [(7, "y", True)]
    assert run("c", (3, 3, "x", 3)) == [(1, "x", True), (2, "x", True), (3, "x", True), (7, "y", True)]
    # the unit again, smaller and on fewer dates; its other dates are known from the index
    assert run("d", (4, 2, "x", 1)) == [(4, "x", True), (7, "y", True)]
    out = str(tmp_path / "out" / "table")
    units = spark.createDataFrame([("x",)], "unit string")
    assert sorted(d.day for d in sinks._known_days(units, out, "unit", sinks.DATE)) == [1, 2, 3]
    # a table from before there was an index gets one
    files.remove(spark, sinks._unit_index(out))
    assert run("e", (5, 9, "x", 1)) == [(5, "x", True), (7, "y", True)]


def test_a_unit_that_stays_incomplete_leaves_after_the_wait(run):
    assert run("a", (1, 1, "x", 2), patience_ms=1) == []
    assert (1, "x", False) in run("b", (2, 1, "y", 1), patience_ms=1)


def test_late_rows_are_kept_with_their_reason(spark, tmp_path):
    path = str(tmp_path / "slots")
    route = streams.routed_sink(path, "at", 5, 10)

    def rows(*minutes):
        times = [None if m is None else dt.datetime(2025, 7, 5, 10) + dt.timedelta(minutes=m) for m in minutes]
        return spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, at timestamp_ntz")

    def found():
        counts = {(r.slot.hour * 60 + r.slot.minute): r.n for r in streams.slot_counts(spark, path).collect()}
        late = sorted((r.reason, r.n) for r in streams.late_counts(spark, path).collect())
        return counts, late

    route(rows(1, 2, 7, 60, None), 0)
    assert found() == ({600: 2, 605: 1, 660: 1}, [("no time", 1)])
    # newest 11:00 less ten minutes: slots that end by 10:50 are closed, the one that ends at 10:55 is not
    second = rows(3, 44, 52, 90)
    for _again in range(2):
        route(second, 1)
        assert found() == ({600: 2, 605: 1, 650: 1, 660: 1, 690: 1}, [("behind the watermark", 1), ("behind the watermark", 1), ("no time", 1)])
    # the first micro-batch once more is judged as it was
    route(rows(1, 2, 7, 60, None), 0)
    assert found()[0] == {600: 2, 605: 1, 650: 1, 660: 1, 690: 1}
