"""Parquet loads: append, overwrite, replace and upsert by touched partitions.

A changed table is never written over the files it is read from.  The changed
partitions are written beside it, once, and moved into place by a publish that
the next writer finishes where one died: see :mod:`areaflow.sources.journal`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import session
from areaflow.functions import clock
from areaflow.operators import conform, incremental, lookup
from areaflow.operators import history as processed
from areaflow.sources import files, journal

DATE = "observed_date"
#: Writes rows to a new folder, by partition columns.
Write = Callable[[DataFrame, str, Sequence[str]], None]
#: Files of an index before it is rewritten as few.
INDEX_FILES = 64


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cluster rows by output partition without giving a hot one to one task.

    The rebalance hint lets adaptive execution split an oversized partition and
    merge small ones, so files come out near the advisory size.
    """
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def _write(df: DataFrame, path: str, by: Sequence[str], mode: str, dynamic: bool) -> None:
    writer = balanced(df, by).write.mode(mode).option("compression", "snappy")
    if by:
        writer = writer.partitionBy(*by)
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def write_batch(df: DataFrame, root: str, stamp: dt.datetime) -> str:
    """One batch folder stamped with the run time; an empty batch keeps its schema."""
    path = f"{root}/{stamp:%Y%m%d}/{stamp:%H%M}"
    _write(df, path, [], "overwrite", False)
    return path


def _write_new(df: DataFrame, path: str, by: Sequence[str]) -> None:
    _write(df, path, by, "errorifexists", False)


def _put(
    df: DataFrame, path: str, by: Sequence[str], removed: Sequence[str] = (), write: Write = _write_new
) -> list[str]:
    """Publish the partitions of ``df`` in place of those of the same name; ``removed`` ones go unless they are among them.

    Without partition columns the files of ``df`` become the table.  Returns the partition folders touched.
    """
    spark = df.sparkSession
    staged = journal.staging(path)
    try:
        write(df, staged, by)
    except BaseException:
        files.remove(spark, staged)
        raise
    moved = journal.folders(spark, staged, len(by))
    before = removed if by else journal.folders(spark, path, 0)
    journal.publish(spark, path, staged, moved, before)
    return sorted({*moved, *before})


def replace_prefix(df: DataFrame, path: str) -> None:
    """Everything under the path becomes this batch."""
    journal.recover(df.sparkSession, path)
    _put(df, path, [])


def write_partitions(
    df: DataFrame, path: str, by: Sequence[str], keep_others: bool = True, write: Write = _write_new
) -> None:
    """Overwrite the partitions the batch holds; others stay unless told not to."""
    spark = df.sparkSession
    journal.recover(spark, path)
    _put(df, path, by, () if keep_others else journal.folders(spark, path, len(by)), write)


def replace_days(
    df: DataFrame, path: str, days: Sequence[dt.date | None], by: str = DATE, write: Write = _write_new
) -> None:
    """The rows of some dates become these; a date without rows loses its partition."""
    journal.recover(df.sparkSession, path)
    _put(df, path, [by], [_folder(by, day) for day in days], write)


def replace_load(df: DataFrame, path: str, load: str, by: Sequence[str]) -> list[str]:
    """Overwrite the partitions of one load; the last of ``by`` holds its name.

    Partitions of the load that it no longer fills are removed.  Returns the partition folders touched.
    """
    spark = df.sparkSession
    journal.recover(spark, path)
    pattern = "/".join([*["*"] * (len(by) - 1), _folder(by[-1], load)])
    before = files.children(spark, path, pattern) if files.exists(spark, path) else []
    return _put(df, path, by, before)


def _folder(column: str, value) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> None:
    """Append, optionally through an explicit column list."""
    _write(df.select(*columns) if columns else df, path, by, "append", False)


def append_positional(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append by column position, as a load without a column list does."""
    append(conform.check_positions(df, schema), path)


def append_unless_empty(df: DataFrame, path: str, by: Sequence[str] = ()) -> bool:
    """Skip the load of an empty batch; tells whether rows were written."""
    if df.isEmpty():
        return False
    append(df, path, by=by)
    return True


def _days(df: DataFrame, by: str) -> list:
    """Distinct partition dates: one value per calendar day, so a short list."""
    if not isinstance(df.schema[by].dataType, T.DateType):
        raise TypeError(f"{by} must be a date column")
    return [row[0] for row in df.select(by).distinct().collect()]


def on_days(df: DataFrame, by: str, days: list) -> DataFrame:
    known = [d for d in days if d is not None]
    condition = F.col(by).isin(known) if known else F.lit(False)
    return df.where(condition | F.col(by).isNull()) if None in days else df.where(condition)


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table; one whose last partition was removed has no files."""
    if files.matches(spark, f"{path}/*.parquet") or files.matches(spark, f"{path}/*/*.parquet"):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def _change(
    path: str,
    batch: DataFrame,
    by: str | None,
    change: Callable[[DataFrame, DataFrame], DataFrame],
    stale_days: Callable[[DataFrame], DataFrame] | None = None,
    unique: Sequence[str] = (),
    more_days: Sequence = (),
) -> list:
    """Apply ``change(target, batch)`` to the partitions it can affect; returns their dates."""
    spark = batch.sparkSession
    journal.recover(spark, path)
    batch, batch_path = session.staged(batch, "batch")
    try:
        if unique:
            lookup.require_unique(batch, *unique)
        partitions = [by] if by else []
        if not files.exists(spark, path):
            if not batch.isEmpty():
                _put(batch, path, partitions)
            return _days(batch, by) if by else []
        if stale_days is None and not more_days and batch.isEmpty():
            return []
        target = _table(spark, path, batch.schema)
        days: list = []
        if by:
            days = list({*_days(batch, by), *more_days, *(_days(stale_days(target), by) if stale_days else [])})
            target = on_days(target, by, days)
        # a partition left without rows is not written, so it is removed
        _put(change(target, batch), path, partitions, [_folder(by, day) for day in days] if by else [])
        return days
    finally:
        files.remove(spark, batch_path)


def upsert(batch: DataFrame, path: str, keys: Sequence[str], by: str | None = DATE) -> list:
    """Merge a batch by key.  The key must determine the partition date.  Returns the dates touched."""
    return _change(path, batch, by, lambda target, b: incremental.upsert(target, b, keys), unique=keys)


def upsert_alive(
    batch: DataFrame, path: str, keys: Sequence[str], alive: DataFrame, days: Sequence[dt.date], by: str = DATE
) -> list:
    """Merge a batch by key; stored rows of ``days`` whose key is not among ``alive`` go."""

    def change(target: DataFrame, b: DataFrame) -> DataFrame:
        checked = F.coalesce(F.col(by).isin(list(days)), F.lit(False))
        known = target.where(checked).join(alive.select(*keys).distinct(), list(keys), "left_semi").select(*target.columns)
        return incremental.upsert(target.where(~checked).unionByName(known), b, keys)

    return _change(path, batch, by, change, unique=keys, more_days=days)


def upsert_newest(
    batch: DataFrame, path: str, keys: Sequence[str], newest: str, by: str | None = DATE
) -> None:
    """Merge a batch by key, the newest version staying.  The key must determine the partition date."""
    nothing = batch.limit(0)
    newer = incremental.upsert_newest(nothing, batch, keys, newest)
    _change(path, newer, by, lambda target, b: incremental.upsert_newest(target, b, keys, newest), unique=keys)


def add_unknown(batch: DataFrame, path: str, keys: Sequence[str], by: str = DATE) -> None:
    """Add the rows whose key the partitions of their dates lack."""
    _change(path, batch, by, lambda target, b: incremental.insert_only(target, b, keys))


def exchange(added: DataFrame, gone: DataFrame, path: str, keys: Sequence[str], by: str = DATE) -> list:
    """Rows with the keys of ``gone`` and ``added`` go, those of ``added`` come."""
    spark = added.sparkSession
    days = _days(gone, by)
    if not files.exists(spark, path):
        write_partitions(added, path, [by])
        return days

    def change(target: DataFrame, b: DataFrame) -> DataFrame:
        out = gone.select(*keys).unionByName(b.select(*keys)).distinct()
        return target.join(out, list(keys), "left_anti").select(*b.columns).unionByName(b)

    return _change(path, added, by, change, more_days=days)


def _unit_index(path: str) -> str:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_units/{name}"


def _unit_days(target: DataFrame, unit: str, by: str) -> DataFrame:
    """Which dates each unit has rows on, sorted so that a range of units is a few row groups."""
    return target.select(F.col(unit).alias("unit"), F.col(by).alias("day")).distinct().sort("unit")


def _known_days(units: DataFrame, path: str, unit: str, by: str) -> list:
    """The dates that units of a batch had rows on, from the index beside the table."""
    spark, index = units.sparkSession, _unit_index(path)
    if not files.exists(spark, path):
        return []
    if not files.exists(spark, index):
        append(_unit_days(spark.read.parquet(path), unit, by), index)
    low, high = units.agg(F.min(unit), F.max(unit)).first()
    # names of units begin with their time, so the bounds leave most files unread
    near = spark.read.parquet(index).where(F.col("unit").between(F.lit(low), F.lit(high)))
    found = near.join(units.select(F.col(unit).alias("unit")).distinct(), "unit", "left_semi")
    return [row[0] for row in found.select("day").distinct().collect()]


def replace_units(batch: DataFrame, path: str, unit: str, by: str = DATE) -> None:
    """Rows of the load units in the batch become the batch's, on whatever dates they were.

    An index from units to dates says which partitions to rewrite.  It is added to before the
    table changes, so it never lacks a date; one too many costs a partition read in vain.
    """
    spark = batch.sparkSession
    journal.recover(spark, path)
    rows, rows_path = session.staged(batch, "units")
    try:
        if rows.isEmpty():
            return
        index = _unit_index(path)
        days = _known_days(rows, path, unit, by)
        append(_unit_days(rows, unit, by).coalesce(1), index)
        if len(files.matching(spark, f"{index}/*.parquet")) > INDEX_FILES:
            replace_prefix(spark.read.parquet(index).distinct().sort("unit"), index)
        _change(
            path,
            rows,
            by,
            lambda target, b: target.join(b.select(unit).distinct(), unit, "left_anti").select(*target.columns).unionByName(b),
            more_days=days,
        )
    finally:
        files.remove(spark, rows_path)


def insert_only(batch: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append the rows whose key is new; nothing is rewritten."""
    spark = batch.sparkSession
    if not files.exists(spark, path):
        append(batch, path)
        return
    target = spark.read.option("mergeSchema", True).parquet(path)
    fresh, fresh_path = session.staged(incremental.new_rows(target, batch, keys), "fresh")
    append_unless_empty(fresh, path)
    files.remove(spark, fresh_path)


def replace_range(
    batch: DataFrame, path: str, column: str, low: dt.datetime, high: dt.datetime, closed: bool = True, by: str = DATE
) -> None:
    """Delete a time range and load the batch, rewriting only the days involved."""
    _change(
        path,
        batch,
        by,
        lambda target, b: incremental.replace_range(target, b, column, low, high, closed),
        stale_days=lambda target: target.where(F.col(by).between(F.lit(low.date()), F.lit(high.date()))),
    )


def replace_key(batch: DataFrame, path: str, column: str, value: dt.datetime, by: str = DATE) -> list:
    """Delete the rows of one load key and load the batch; returns the dates touched."""
    return _change(
        path,
        batch,
        by,
        lambda target, b: incremental.replace_key(target, b, column, value),
        stale_days=lambda target: target.where(F.col(by) == F.lit(value.date())),
    )


def insert_if_absent(batch: DataFrame, path: str, column: str, value: dt.datetime, by: str = DATE) -> bool:
    """Load the batch only when no row with the load key exists."""
    spark = batch.sparkSession
    if files.exists(spark, path):
        loaded = spark.read.parquet(path).where((F.col(by) == F.lit(value.date())) & (F.col(column) == clock.wall(value)))
        if not loaded.isEmpty():
            return False
    return append_unless_empty(batch, path, by=[by])


def write_history_documents(history: DataFrame, path: str) -> None:
    """Export history as JSON maps, one per line."""
    documents = processed.to_documents(history).select(F.col("document").alias("value"))
    balanced(documents, []).write.mode("overwrite").text(path)
