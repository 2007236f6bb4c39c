"""Work that costs more than a row's bytes: done once, on rows dealt over all tasks, and not on rows that move."""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import unquote, urlparse

from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow.operators import history
from areaflow.queries import roles
from areaflow.queries.registry import QUERIES


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def _tables(spark, tmp_path):
    """Events of two days in one row group; one has no user, one no time."""
    at = dt.datetime(2024, 1, 1, 23, 58)
    rows = [
        (i, None if i == 5 else at + dt.timedelta(minutes=i), None if i == 6 else 7 + i % 3, "view", 1.5, f'{{"k": {i}}}')
        for i in range(8)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    lines = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(8)]
    spark.createDataFrame(lines, "l_suppkey long, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_history_documents_are_parsed_once(spark, capsys):
    texts = ['{"POI001": [{"observed_at": "2025-07-05 10:00:00", "processed_at": "2025-07-05 11:00:00"}], "2": []}', "{}", "no map", None]
    found = history.from_documents(spark.createDataFrame([(t,) for t in texts], "d string"), F.col("d"))
    assert [(r.area_id, r.observed_at) for r in found.collect()] == [(1, dt.datetime(2025, 7, 5, 10))]
    assert _plan(found, capsys).count("from_json(") == 1


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path, capsys):
    sf = _tables(spark, tmp_path)
    scan = QUERIES["s12_history_scan"](spark, sf)
    assert scan.count() == 8 and "RoundRobinPartitioning" in _plan(scan, capsys)
    docs = roles.documents(spark, sf)
    assert docs.count() == 8 and "RoundRobinPartitioning" in _plan(docs, capsys)


def test_documents_are_made_behind_the_shuffle_and_the_sort(spark, tmp_path, capsys):
    sf = _tables(spark, tmp_path)
    plan = _plan(roles.by_day(spark, sf), capsys)
    assert "named_struct" in plan.split("Exchange")[0] and "named_struct" not in plan.split("Exchange")[1]
    landed = roles.landed_documents(spark, sf)
    days = {r.key: r.ymd for r in landed.select("key", "ymd").collect()}
    assert landed.count() == 8 and {k and int(k.split("/")[1]) for k in days} == set(days.values()) == {20240101, 20240102, None}


def test_landed_documents_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    at, kinds = dt.datetime(2024, 1, 1), ["view", "click", "error", None]
    rows = [
        (i, at + dt.timedelta(minutes=7 * i), 100 + i * 37 % 91, kinds[i % 4], i * 13 % 997 / 100, f'{{"k": {i * 29 % 100}}}')
        for i in range(400)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame([*rows, rows[0]], schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    sf = str(tmp_path)
    monkeypatch.setattr(roles, "FILE_DOCUMENTS", 60, raising=False)
    landed = roles.landed_documents(spark, sf)
    files = {r[0]: r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()}
    texts = roles.json_documents(spark, sf)
    held = sum(os.path.getsize(unquote(urlparse(f).path)) for f in files)
    assert held * 10 < texts.agg(F.sum(F.length("body"))).first()[0]
    assert sum(files.values()) == 401 and max(files.values()) == 60
    keyed = landed.select(F.to_json(F.struct(*c.RAW_DOCUMENT.names)).alias("body"), F.col("key").alias("path"))
    assert keyed.exceptAll(texts).isEmpty() and texts.exceptAll(keyed).isEmpty()
