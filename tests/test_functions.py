"""Scalar rules on edge values."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from areaflow.functions import clock, keys, parsing, text
from areaflow.sources import paths


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("rule", "values", "expected"),
    [
        ("int_truncating", ["12", "12.9", "-3.5", "", None, "abc", "nan", "9999999999"],
         [12, 12, -3, None, None, None, None, None]),
        ("int_strict", ["12", "12.5", "", None, "abc"], [12, None, None, None, None]),
        ("int_or_zero", ["7", "", None, "x"], [7, 0, 0, 0]),
        ("real", ["1.5", "", None, "x"], [1.5, None, None, None]),
        ("real_unless_sentinel", ["2.5", "점검중", None], [2.5, None, None]),
        ("coordinate", ["126.97", "", "  ", "0", None, "?"], [126.97, None, None, 0.0, None, None]),
        ("ratio", ["12.345", "12.344", "1234.5", "", None],
         [Decimal("12.35"), Decimal("12.34"), None, None, None]),
        ("yes_no", ["Y", "N", "y", None], [True, False, None, None]),
        ("is_yes", ["Y", "N", None], [True, False, False]),
        ("text_or_empty", ["a", "", None], ["a", "", ""]),
    ],
)
def test_rules(spark, rule, values, expected):
    assert column(spark, values, parsing.RULES[rule]) == expected


def test_basis_month_layouts(spark):
    values = ["2024-05", "202405", "20240503", "2024-05-03", "2024-05-03 10:20", "soon", "", None]
    got = column(spark, values, parsing.basis_month)
    day = dt.datetime(2024, 5, 3)
    assert got == [dt.datetime(2024, 5, 1)] * 2 + [day, day, dt.datetime(2024, 5, 3, 10, 20), None, None, None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-999, 999) | st.integers(-19980, 19980).map(lambda n: n / 20), min_size=20, max_size=60))
def test_one_decimal_is_binary_rounding(spark, values):
    expected = [Decimal(str(round(v, 1))) + 0 for v in values]
    assert column(spark, values, parsing.one_decimal, "double") == expected


def test_one_decimal_edges(spark):
    values = [0.25, 0.75, 2.35, -0.05, 999.94, 999.96, 1e300, float("nan"), float("inf"), None]
    expected = [Decimal(s) for s in ("0.2", "0.8", "2.4", "-0.1", "999.9")] + [None] * 5
    assert round(2.35, 1) == 2.4 and round(-0.05, 1) == -0.1
    assert column(spark, values, parsing.one_decimal, "double") == expected


def test_keys(spark):
    stamp = "2025-07-05 23:01:00"
    row = spark.sql(f"SELECT 'POI001' AS a, timestamp_ntz'{stamp}' AS t, CAST(NULL AS STRING) AS n").select(
        keys.source_id(F.col("a"), F.col("t")),
        keys.surrogate_key(F.col("a"), F.col("n")),
        keys.transit_key(F.col("t"), F.col("a"), F.lit("bus")),
        keys.transit_key(F.col("t"), F.col("n"), F.lit("bus")),
        clock.time_key(F.col("t")),
    ).first()
    assert row[0] == hashlib.md5(f"POI001_{stamp}".encode()).hexdigest()
    assert row[1] == hashlib.md5(b"POI001-_dbt_utils_surrogate_key_null_").hexdigest()
    assert row[2] == "202507052301-POI001-bus"
    assert row[3] is None
    assert row[4] == 202507052301


def test_period_bounds(spark):
    values = ["2025-07-01~2025-07-31", "2025-07-01 ~ 2025-07-31", "2025-07-01 ~", "~2025-07-31", "later", None]
    start, end = dt.date(2025, 7, 1), dt.date(2025, 7, 31)
    assert column(spark, values, lambda c: clock.period_bound(c, 1)) == [start, start, start, None, None, None]
    assert column(spark, values, lambda c: clock.period_bound(c, 2)) == [end, end, None, end, None, None]


def test_iso_text_to_local_clock(spark):
    values = ["2025-07-05T12:00:00+00:00", "2025-07-05T12:00:00+09:00", "bad", None]
    noon = dt.datetime(2025, 7, 5, 12)
    assert column(spark, values, clock.iso_to_local) == [noon + dt.timedelta(hours=9), noon, None, None]


def test_key_parts(spark):
    rows = [
        "s3://b/raw-json/20250705/2301_12.json",
        "s3://b/raw-json/20250705/2301.json",
        "s3://b/raw-json/20250705/2301_x.json",
        "s3://b/raw-json/20251399/2301_12.json",
    ]
    df = paths.with_key_parts(spark.createDataFrame([(r,) for r in rows], "path string"), F.col("path"))
    got = [(r.file_ts, r.file_hhmm, r.file_area_id) for r in df.collect()]
    assert got == [
        (dt.datetime(2025, 7, 5, 23, 1), "2301", 12),
        (None, None, None),
        (None, None, None),
        (None, "2301", 12),
    ]


def test_area_number(spark):
    assert column(spark, ["POI001", "12", "none", None], text.area_number) == [1, 12, None, None]


def test_hourly_globs():
    start, end = dt.datetime(2025, 7, 5, 22), dt.datetime(2025, 7, 6, 1)
    exclusive = ["b/20250705/22*.json", "b/20250705/23*.json", "b/20250706/00*.json"]
    assert paths.hourly_globs("b", start, end) == exclusive
    assert paths.hourly_globs("b", start, end, inclusive=True) == [*exclusive, "b/20250706/01*.json"]
    half = end - dt.timedelta(minutes=30)
    assert paths.hourly_globs("b", start, half) == exclusive
    assert paths.hourly_globs("b", start, half, inclusive=True) == exclusive


def test_windows():
    run = dt.datetime(2025, 7, 9, 0, 3, 20)
    assert clock.previous_minutes(run, 5) == (dt.datetime(2025, 7, 8, 23, 58), dt.datetime(2025, 7, 9, 0, 3))
    assert clock.previous_night(run) == (dt.datetime(2025, 7, 8, 21), dt.datetime(2025, 7, 9, 9))
    assert clock.previous_week(run) == (dt.datetime(2025, 6, 30), dt.datetime(2025, 7, 7))
