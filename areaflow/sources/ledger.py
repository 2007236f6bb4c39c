"""Which loads the sources hold, and which of them each fact was built from.

A load that has written its partitions is recorded with a version and the dates it
touched; a load that runs again gets a new version.  A build reads the loads whose
version its fact lacks, whatever their clocks, and records them once its rows are stored.
A build that dies before that finds the same loads again.

Both tables are appended to, one small file each time, and rewritten when there
are many.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import session
from areaflow.sources import files, sinks
from areaflow.sources.tables import BATCH, Warehouse

_TEXT = T.StringType()
LOADS = T.StructType([T.StructField(n, _TEXT) for n in ("source", "load", "version")]).add("days", T.ArrayType(T.DateType()))
BUILT = T.StructType([T.StructField(n, _TEXT) for n in ("fact", "source", "load", "version")])
_LOAD = ["source", "load", "version"]
#: Files of a ledger table before it is rewritten as few.
MOST_FILES = 64


def _read(wh: Warehouse, name: str, schema: T.StructType) -> DataFrame:
    return files.read_or_empty(wh.spark, wh.path("ledger", name), schema)


def _add(wh: Warehouse, name: str, rows: DataFrame, schema: T.StructType) -> None:
    path = wh.path("ledger", name)
    sinks.append(rows.select(*schema.names), path)
    if len(files.matching(wh.spark, f"{path}/*.parquet")) > MOST_FILES:
        sinks.replace_prefix(_read(wh, name, schema), path)


def record(wh: Warehouse, source: str, load: str, days: Sequence[dt.date | None]) -> None:
    """A load has written ``days`` of a source, or taken rows away there."""
    version = f"{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex}"
    _add(wh, "loads", wh.spark.createDataFrame([(source, load, version, list(days))], LOADS), LOADS)


def adopt(wh: Warehouse, source: str) -> None:
    """Record what a source held before it had a ledger."""
    if not files.exists(wh.spark, wh.path("source", source)):
        return
    if not _read(wh, "loads", LOADS).where(F.col("source") == source).isEmpty():
        return
    stored = wh.stored(source)
    load = F.coalesce(F.col(BATCH if BATCH in stored.columns else sinks.DATE).cast("string"), F.lit("")).alias("load")
    found = stored.select(load, sinks.DATE).distinct().groupBy("load").agg(F.collect_list(sinks.DATE).alias("days"))
    _add(wh, "loads", found.select(F.lit(source).alias("source"), "load", F.lit("0").alias("version"), "days"), LOADS)


def is_built(wh: Warehouse, fact: str) -> bool:
    return not _read(wh, "built", BUILT).where(F.col("fact") == fact).isEmpty()


def unbuilt(wh: Warehouse, fact: str, sources: Sequence[str]) -> tuple[DataFrame, str]:
    """``source, load, version, days, again`` of the loads a fact lacks; ``again`` where it has an earlier version.

    Stored, so that loads recorded while a build runs are left to the next one.
    """
    loads = _read(wh, "loads", LOADS).where(F.col("source").isin(list(sources)))
    built = _read(wh, "built", BUILT).where(F.col("fact") == fact)
    earlier = built.select("source", "load", F.lit(True).alias("again")).distinct()
    new = loads.join(built.select(*_LOAD), _LOAD, "left_anti").join(earlier, ["source", "load"], "left")
    return session.staged(new.select(*LOADS.names, F.coalesce("again", F.lit(False)).alias("again")), "unbuilt")


def mark_built(wh: Warehouse, fact: str, loads: DataFrame) -> None:
    _add(wh, "built", loads.select(F.lit(fact).alias("fact"), *_LOAD), BUILT)
