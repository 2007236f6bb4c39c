"""Tables with date partitions, bucketed inside by the keys they are joined on.

Two tables with the same keys and number of buckets join without a shuffle: a task reads
the same bucket of both.  The keys should spread a hot value, as area and minute do.

How a table is bucketed is recorded beside it and never changes, so any session can
register it anew.  Dates are rewritten through the publish journal, like those of other tables.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from areaflow.sources import files, sinks


def _record(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_buckets/{name}.json"


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, _record(path))


def _table_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write all rows as a new table, in place of one that is there."""
    spark = df.sparkSession
    files.remove(spark, _record(path))
    files.remove(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    kept = {"keys": list(keys), "buckets": buckets, "schema": df.schema.json()}
    sinks.write_partitions(df, path, [sinks.DATE], keep_others=False, write=_writer(kept))
    files.write_text(spark, _record(path), json.dumps(kept))


def replace_days(df: DataFrame, path: str, days: Sequence[dt.date | None]) -> None:
    """The rows of some dates become these; a date without rows loses its partition."""
    kept = json.loads(files.read_text(df.sparkSession, _record(path)))
    sinks.replace_days(df, path, days, write=_writer(kept))


def _writer(kept: dict):
    def write(df: DataFrame, staged: str, by: Sequence[str]) -> None:
        name = f"staged_{uuid.uuid4().hex}"
        # the bucket expression is the hash of the shuffle, so a task holds one bucket and a date gets one file of it
        placed = df.repartition(kept["buckets"], *kept["keys"]).sortWithinPartitions(*by, *kept["keys"])
        writer = placed.write.format("parquet").option("path", staged).option("compression", "snappy")
        writer.partitionBy(*by).bucketBy(kept["buckets"], *kept["keys"]).sortBy(*kept["keys"]).saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")  # its files stay

    return write


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table with its buckets known to the planner."""
    kept = json.loads(files.read_text(spark, _record(path)))
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        fields = T.StructType.fromJson(json.loads(kept["schema"])).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        keys = ", ".join(f"`{k}`" for k in kept["keys"])
        files.make_folder(spark, path)
        spark.sql(
            f"""CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({sinks.DATE})
            CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {kept["buckets"]} BUCKETS LOCATION '{path}'"""
        )
    # other writers may have changed dates, and files of a date
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)
