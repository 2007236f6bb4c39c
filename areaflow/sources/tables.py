"""Warehouse tables as Parquet folders under one root."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts
from areaflow.functions import clock
from areaflow.operators import minutes
from areaflow.sources import files


#: Partition columns of stored sources: the observation's date, and the load where several share a date.
DATE = "observed_date"
BATCH = "load_batch"
_BY_DATE = ("weather", "event")


class Warehouse:
    """Resolves ``source`` tables, dimensions and facts by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def stored(self, name: str) -> DataFrame:
        """A source table with its partition columns."""
        schema = T.StructType([*contracts.SOURCE_TABLES[name].fields, T.StructField(DATE, T.DateType())])
        if name not in _BY_DATE:
            schema.add(BATCH, T.StringType())
        return files.read_or_empty(self.spark, self.path("source", name), schema)

    def source(self, name: str, from_day: dt.date | None = None) -> DataFrame:
        """A source table in its contract order, pruned to the days from ``from_day`` on."""
        stored = self.stored(name)
        if from_day:
            stored = stored.where(F.col(DATE) >= F.lit(from_day))
        return stored.select(*contracts.SOURCE_TABLES[name].names)

    def dimension(self, name: str) -> DataFrame:
        return files.read_or_empty(self.spark, self.path("dim", name), contracts.DIMENSIONS[name])

    def history_minutes(self, feed: str) -> DataFrame:
        """History as stored: one row of bits per area, date and load."""
        return files.read_or_empty(self.spark, self.path("history_minutes", feed), contracts.HISTORY_MINUTES)

    def history_rows(self, feed: str) -> DataFrame:
        """History stored row by row, as it was before there were bits."""
        return files.read_or_empty(self.spark, self.path("history", feed), contracts.HISTORY_TABLE)

    def history(self, feed: str) -> DataFrame:
        """All history as rows."""
        rows = self.history_rows(feed)
        return minutes.unpack(self.history_minutes(feed)).select(*rows.columns).unionByName(rows)

    def existing(self, layer: str, name: str) -> DataFrame | None:
        """A built table, or None before its first build."""
        path = self.path(layer, name)
        if not files.exists(self.spark, path):
            return None
        # only dimensions gain columns; merging the footers of a fact would read them all
        return self.spark.read.option("mergeSchema", layer == "dim").parquet(path)

    def register(self, layer: str, name: str) -> str:
        """Expose a table to SQL; returns the view name."""
        view = f"{layer}_{name}"
        reader = {"source": self.source, "dim": self.dimension, "history": self.history}.get(layer)
        df = reader(name) if reader else self.existing(layer, name)
        if df is None:
            raise FileNotFoundError(self.path(layer, name))
        df.createOrReplaceTempView(view)
        return view


def hour_partitions(df: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Prune a year/month/day/hour table to the hours of ``[start, end)``.

    The hour comparison selects partitions; the day bound in front of it keeps
    the predicate on partition columns only, so no file outside is opened.
    """
    hour = F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    first = start.replace(minute=0, second=0, microsecond=0)
    return df.where((hour >= clock.wall(first)) & (hour < clock.wall(end)))
