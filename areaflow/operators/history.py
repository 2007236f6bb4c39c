"""Processed-observation history: which (area, observation time) was loaded.

Stored as minute bitmaps partitioned by observation date and load.  A batch only ever
looks at the dates of its own window, however long the history has grown.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow import contracts
from areaflow.functions import clock, text
from areaflow.operators import generators, minutes

KEYS = ("area_id", "observed_at")


def from_documents(df: DataFrame, document: Column) -> DataFrame:
    """JSON maps ``{area: [{observed_at, processed_at}]}`` to history rows.

    Any number of documents may name the same area.  An area is matched by its
    number, so ``POI001`` and ``1`` are one area.
    """
    maps = df.select(F.from_json(document, contracts.HISTORY_DOCUMENT).alias("m"))
    entries = generators.map_rows(maps, F.col("m"), "area")
    return entries.select(
        text.area_number(F.col("area")).alias("area_id"),
        clock.parse(F.col("observed_at"), contracts.DASHED_SECOND).alias("observed_at"),
        clock.parse(F.col("processed_at"), contracts.DASHED_SECOND).alias("processed_at"),
    ).withColumn("observed_date", F.to_date("observed_at"))


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """History documents from text files, one per line or one per file."""
    return from_documents(spark.read.text(path, wholetext=whole_file), F.col("value"))


def to_documents(history: DataFrame) -> DataFrame:
    """One JSON map per area and hour.

    A single document, or one per area, would grow without bound; at one entry
    per second an hour holds at most 3,600, and the reader accepts many maps.
    """
    stamp = F.date_format("observed_at", contracts.DASHED_SECOND)
    # one entry per second, so the list below is bounded whatever the input repeats
    entries = (
        history.withColumns({"_hour": clock.truncated(F.col("observed_at"), "hour"), "_at": stamp})
        .groupBy("area_id", "_hour", "_at")
        .agg(F.min("processed_at").alias("_done"))
    )
    entry = F.struct(
        F.col("_at").alias("observed_at"),
        F.date_format("_done", contracts.DASHED_SECOND).alias("processed_at"),
    )
    grouped = entries.groupBy("area_id", "_hour").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    document = F.to_json(F.create_map(F.col("area_id").cast("string"), F.col("entries")))
    return grouped.select("area_id", F.col("_hour").alias("observed_hour"), "entries", document.alias("document"))


def entry_total(documents: DataFrame) -> DataFrame:
    """Number of entries over all documents."""
    return documents.agg(F.sum(F.size("entries")).cast("bigint").alias("entries"))


def within(history: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """History of ``[start, end)``, pruned to its date partitions."""
    in_dates = F.col("observed_date").between(F.lit(start.date()), F.lit(end.date()))
    in_time = (F.col("observed_at") >= clock.wall(start)) & (F.col("observed_at") < clock.wall(end))
    return history.where(in_dates & in_time)


def by_others(history: DataFrame, name: str) -> DataFrame:
    """History without the entries of one load, so that repeating the load finds its rows again."""
    return history.where(F.col("load_batch").isNull() | (F.col("load_batch") != F.lit(name)))


def for_batch(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History on the dates a batch spans; reads one row of bounds."""
    day = F.to_date("observed_at")
    low, high = batch.agg(F.min(day), F.max(day)).first()
    if low is None:
        return history.where(F.lit(False))
    return history.where(F.col("observed_date").between(F.lit(low), F.lit(high)))


def unseen(batch: DataFrame, history: DataFrame, on: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose key is not in the history.

    ``on`` maps batch columns to history columns, by default :data:`KEYS` to
    themselves.  The history side is reduced to distinct keys before the join; packed
    history (:mod:`areaflow.operators.minutes`) is tested bit by bit.
    """
    on = on or {k: k for k in KEYS}
    if minutes.is_packed(history):
        area, observed_at = (next(b for b, h in on.items() if h == k) for k in KEYS)
        return minutes.unseen(batch, history, area, observed_at)
    side = history.select(*[F.col(h).alias(f"_seen_{i}") for i, h in enumerate(on.values())]).distinct()
    condition = [batch[b] == side[f"_seen_{i}"] for i, b in enumerate(on)]
    return batch.join(side, condition, "left_anti")


def entries_of(batch: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """History rows for the observations of a batch."""
    return (
        batch.select(*KEYS)
        .distinct()
        .withColumns({"processed_at": clock.wall(run_ts), "observed_date": F.to_date("observed_at")})
    )


def merged(history: DataFrame, new: DataFrame) -> DataFrame:
    """History with the new observations; entries already there are kept."""
    return history.unionByName(unseen(new.dropDuplicates(list(KEYS)), history))
