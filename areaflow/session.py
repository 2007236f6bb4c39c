"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build(master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``extra`` takes further options with ``__`` in place of dots, for example
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName("areaflow")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder the session names.

    Without ``spark.checkpoint.dir`` only a local master may fall back to a
    machine-local folder: executors elsewhere could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="areaflow-")
    return os.path.join(base, "areaflow", f"{label}-{uuid.uuid4().hex}")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt out anew, for work that costs far more than a row's bytes.

    A scan is cut by bytes and never inside a row group, so narrow rows reach few tasks.  Without a
    number adaptive execution takes a task per core, more of them where the rows are many.
    """
    return df.hint("repartition")


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to shared scratch and read it back.

    Cuts the lineage on reliable storage, so an expensive batch is computed once
    even when several actions follow or executors are lost in between.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
