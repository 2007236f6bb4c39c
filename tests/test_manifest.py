"""Manifests: what is listed is read whole, or the scan fails."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.sources import manifest, sinks

START, END = dt.datetime(2025, 7, 5, 22), dt.datetime(2025, 7, 6, 2)


@pytest.fixture()
def root(spark, tmp_path):
    """Five hours over midnight, the last of them outside the window."""
    at = F.timestamp_add("HOUR", F.col("id").cast("int"), clock.wall(START))
    hours = spark.range(5).select("id", at.alias("at"))
    root = str(tmp_path / "hours")
    sinks.write_partitions(hours.withColumns(clock.date_parts(F.col("at"))), root, ["year", "month", "day", "hour"])
    return root


def ids(df):
    return sorted(r.id for r in df.collect())


def one_file(root):
    return glob.glob(f"{root}/*/*/*/hour=0/*.parquet")[0]


def test_listed_files_only(spark, root, tmp_path):
    path = str(tmp_path / "manifest")
    assert manifest.write(spark, root, START, END, path)
    listed = [json.loads(line) for name in glob.glob(f"{path}/*.json") for line in open(name)]
    assert len(listed) == 4
    assert all(e["mandatory"] and e["meta"]["record_count"] == 1 for e in listed)
    assert {e["meta"]["content_length"] for e in listed} <= {os.path.getsize(f) for f in glob.glob(f"{root}/*/*/*/*/*.parquet")}
    late = one_file(root)
    shutil.copy(late, late.replace("part-", "part-late-"))
    assert ids(manifest.scan(spark, path)) == [0, 1, 2, 3]


@pytest.mark.parametrize("harm", ["removed", "other rows", "other bytes", "folder removed"])
def test_a_changed_file_stops_the_load(spark, root, tmp_path, harm):
    path = str(tmp_path / "manifest")
    manifest.write(spark, root, START, END, path)
    name = one_file(root)
    if harm == "removed":
        os.remove(name)
    elif harm == "folder removed":
        shutil.rmtree(os.path.dirname(name))
    else:
        other = str(tmp_path / "other")
        rows = spark.range(10, 12 if harm == "other rows" else 11).select("id", F.lit("x" * 500).alias("more"))
        rows.coalesce(1).write.parquet(other)
        shutil.copy(glob.glob(f"{other}/*.parquet")[0], name)
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    with pytest.raises(manifest.ManifestError, match="1 files are not as listed"):
        manifest.scan(spark, path)


def test_an_optional_file_may_be_missing(spark, root, tmp_path):
    path = tmp_path / "manifest"
    manifest.write(spark, root, START, END, str(path))
    lines = [json.loads(line) for name in path.glob("*.json") for line in name.read_text().splitlines()]
    again = tmp_path / "again"
    again.mkdir()
    (again / "m.json").write_text("\n".join(json.dumps({**e, "mandatory": False}) for e in lines))
    os.remove(one_file(root))
    assert ids(manifest.scan(spark, str(again))) == [0, 1, 3]


def test_nothing_to_list(spark, root, tmp_path):
    path = str(tmp_path / "manifest")
    assert not manifest.write(spark, root, END + dt.timedelta(days=9), END + dt.timedelta(days=10), path)
    assert not manifest.write(spark, str(tmp_path / "none"), START, END, path)
    with pytest.raises(manifest.ManifestError, match="no file"):
        manifest.scan(spark, path)
