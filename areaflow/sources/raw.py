"""Nested area documents."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts
from areaflow.sources import files, paths


def documents(spark: SparkSession, locations: str | list[str], multiline: bool = False) -> DataFrame:
    """Scan documents with the declared schema; no inference pass."""
    df = (
        spark.read.schema(contracts.RAW_DOCUMENT)
        .option("multiLine", multiline)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .json(locations)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    return paths.with_key_parts(df, F.col("path"))


def window(
    spark: SparkSession,
    base: str,
    start: dt.datetime,
    end: dt.datetime,
    multiline: bool = False,
) -> DataFrame:
    """Documents of a half-open file window; days without files are no error.

    Every window reads its day folders; the key filter, applied while files are
    listed, leaves those of other minutes unopened.
    """
    folders = [f for f in paths.day_folders(base, start, end) if files.exists(spark, f)]
    if not folders:
        empty = spark.createDataFrame([], contracts.RAW_DOCUMENT).withColumn("path", F.lit(None).cast("string"))
        return paths.with_key_parts(empty, F.col("path"))
    return documents(spark, folders, multiline).where(paths.in_window(F.col("file_ts"), start, end))


def daily_slot(spark: SparkSession, base: str, day: dt.date, prefix: str = "003", multiline: bool = False) -> DataFrame:
    """First document of each area in the day's fixed slot."""
    glob = f"{base}/{day:%Y%m%d}/{prefix}*.json"
    if not files.matches(spark, glob):
        raise FileNotFoundError(glob)
    docs = documents(spark, glob, multiline)
    first = paths.first_per_location(docs.where("file_area_id is not null"), "file_area_id")
    return docs.join(first, ["file_area_id", "path"], "left_semi")


def from_json_text(df: DataFrame, text: Column, *keep: str, payloads: Sequence[str] = ()) -> DataFrame:
    """Documents that arrive as a text column instead of as files.

    ``payloads`` names the fields to parse, by default all; the parser skips
    the others.
    """
    schema = contracts.RAW_DOCUMENT
    if payloads:
        schema = T.StructType([f for f in schema.fields if f.name in payloads])
    # A projected from_json would be repeated inside every filter on its fields;
    # the output of a generator is not, so each text is parsed once.
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))
