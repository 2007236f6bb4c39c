"""Duplicate policies.

Each of them combines map-side first, so a key that holds a large share of the
rows reaches its final task as one candidate per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key; planned with a group limit before the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by)).where("_rank = 1").drop("_rank")


def latest_wins(
    df: DataFrame, keys: Sequence[str], newest: str = "created_at", ties: Sequence[Column] = ()
) -> DataFrame:
    """Newest row of each key; a missing time counts as newest.

    ``ties`` makes the choice between equally new rows deterministic.
    """
    return ranked_first(df, keys, [F.col(newest).desc_nulls_first(), *ties])


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return ranked_first(df, keys, order)


def max_wins(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Column-wise maximum per key, NULLs ignored, a NULL key is a group."""
    rest = [c for c in df.columns if c not in keys]
    merged = df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])
    return merged.select(*df.columns)


def any_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def latest_per_group(
    df: DataFrame, group: str, time: str, columns: Sequence[str | Column], ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row of each of few, large groups, cut to the wanted columns.

    The columns are dropped before ranking, so the map-side sort handles narrow
    rows and each task passes on one row per group.
    """
    by = Window.partitionBy(group).orderBy(F.col(time).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    ranked = df.where(F.col(group).isNotNull()).select(group, *columns, F.row_number().over(by).alias("_rank"))
    return ranked.where("_rank = 1").drop("_rank")
