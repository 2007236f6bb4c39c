"""File-system lookups through the Hadoop client Spark already uses."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@functools.lru_cache(maxsize=4)
def _path_class(jvm):
    """Looked up once: resolving a class name asks the JVM for every part of it."""
    return jvm.org.apache.hadoop.fs.Path


def _fs(spark: SparkSession, path: str):
    hadoop_path = _path_class(spark._jvm)(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths a pattern names; meant for folders of one load, of which there are few."""
    fs, p = _fs(spark, pattern)
    return [str(found.getPath()) for found in (fs.globStatus(p) or [])]


def children(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Paths below a folder, relative to it; names that Spark does not read are left out."""
    base = str(_fs(spark, path)[0].makeQualified(_fs(spark, path)[1]))
    below = (found.removeprefix(base).strip("/") for found in matching(spark, f"{path}/{pattern}"))
    return [b for b in below if not any(part.startswith(("_", ".")) for part in b.split("/"))]


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a name not in use, within one file system."""
    fs, p = _fs(spark, old)
    _, q = _fs(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"could not move {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: it gets its name when it is complete."""
    fs, p = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one on the first run."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
