"""Manifests: the files a load has to read, all of them, as they were when listed.

A manifest is a folder of JSON lines, one per file: its place, whether the load must have
it, its bytes and its rows.  A scan checks the files against it in one Spark job, which
reads footers only, and then reads these files and no others.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.sources import files, tables

ENTRY = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("mandatory", T.BooleanType()),
        T.StructField(
            "meta",
            T.StructType([T.StructField("content_length", T.LongType()), T.StructField("record_count", T.LongType())]),
        ),
    ]
)


class ManifestError(ValueError):
    """A file of a manifest is missing or is not what was listed."""


def _files_of(rows: DataFrame) -> DataFrame:
    """``url, content_length, record_count`` of the files behind a Parquet scan; files without rows are none."""
    place = rows.select(F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_size").alias("content_length"))
    return place.groupBy("url", "content_length").agg(F.count("*").alias("record_count"))


def entries(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Entries for the hours of ``[start, end)`` of a year/month/day/hour table."""
    found = _files_of(tables.hour_partitions(spark.read.parquet(root), start, end))
    return found.select("url", F.lit(True).alias("mandatory"), F.struct("content_length", "record_count").alias("meta"))


def write(spark: SparkSession, root: str, start: dt.datetime, end: dt.datetime, path: str) -> bool:
    """Write the manifest of a window; without files there is none, and nothing to load."""
    if not files.exists(spark, root):
        return False
    entries(spark, root, start, end).coalesce(1).write.mode("overwrite").json(path)
    return not spark.read.schema(ENTRY).json(path).isEmpty()


def _checked(spark: SparkSession, listed: DataFrame) -> list[str]:
    """The places to read; fails when a mandatory file is not as listed."""
    # one folder per hour of the window
    folder = F.regexp_replace("url", "/[^/]*$", "")
    folders = [f for (f,) in listed.select(folder).distinct().collect() if files.matches(spark, f"{f}/*.parquet")]
    actual = _files_of(spark.read.parquet(*folders)) if folders else None
    if actual is None:
        actual = spark.createDataFrame([], "url string, content_length long, record_count long")
    found = actual.select("url", F.struct("content_length", "record_count").alias("found"))
    compared = listed.join(found, "url", "left")
    wrong = compared.where(~F.col("found").eqNullSafe(F.col("meta")) & (F.col("mandatory") | F.col("found").isNotNull()))
    total = wrong.count()
    if total:
        some = [f"{r.url}: {'missing' if r.found is None else tuple(r.found)} for {tuple(r.meta)}" for r in wrong.limit(5).collect()]
        raise ManifestError(f"{total} files are not as listed (bytes, rows): {'; '.join(some)}")
    return sorted(r.url for r in compared.where("found is not null").select("url").collect())


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the listed files, with their partition columns."""
    listed = spark.read.schema(ENTRY).json(path)
    places = _checked(spark, listed)
    if not places:
        if schema is None:
            raise ManifestError(f"{path} lists no file")
        return spark.createDataFrame([], schema)
    # the table begins above the first partition folder
    root = re.sub(r"/[^/=]+=.*$", "", places[0])
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema else reader).parquet(*places)
