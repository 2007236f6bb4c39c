"""The scheduled micro-batches as Structured Streaming queries.

The watermark needs a ``timestamp`` column, so observation times are cast for
the stateful step and cast back to wall clocks in each micro-batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from areaflow import contracts, session
from areaflow.functions import clock
from areaflow.sources import files, paths, sinks

EVENT_TIME = "_event_time"


def document_stream(spark: SparkSession, base: str, files_per_trigger: int | None = None) -> DataFrame:
    """New area documents under the raw folder, with their key parts."""
    docs = json_stream(spark, base, contracts.RAW_DOCUMENT, files_per_trigger)
    return paths.with_key_parts(docs.withColumn("path", F.col("_metadata.file_path")), F.col("path"))


def json_stream(
    spark: SparkSession, base: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(base)


def with_event_time(df: DataFrame, observed_at: str, delay: str) -> DataFrame:
    return df.withColumn(EVENT_TIME, F.col(observed_at).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def unseen(df: DataFrame, keys: Sequence[str], observed_at: str, delay: str) -> DataFrame:
    """Each key once within the watermark delay; state is bounded by the delay.

    A key seen again later than that passes, so the sink merges by key.
    """
    return with_event_time(df, observed_at, delay).dropDuplicatesWithinWatermark(list(keys))


def tumbling(df: DataFrame, observed_at: str, minutes: int, delay: str, *by: str) -> DataFrame:
    """Row counts per tumbling batch; late rows beyond the delay are dropped."""
    slot = F.window(EVENT_TIME, f"{minutes} minutes")
    counted = with_event_time(df, observed_at, delay).groupBy(slot, *by).count()
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("slot"), *by, F.col("count").alias("n"))


# --- units that arrive in pieces --------------------------------------------------------

_GATHERED = "rows array<string>, expected int"
# rows wait as JSON, with times to the microsecond
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_EXACT = {"timestampNTZFormat": _MICROS, "timestampFormat": f"{_MICROS}XXX", "ignoreNullFields": "false"}


def whole_units(
    df: DataFrame, unit: str, expected: str | None = None, patience_ms: int = 1_800_000
) -> DataFrame:
    """Rows of a load unit together, however many micro-batches they arrive in.

    Rows wait in the state of their unit until there are as many as ``expected`` says, or until
    others have been arriving for ``patience_ms`` longer; then all leave at once, with
    ``complete`` telling which.  A unit that arrives again after that is gathered anew.  Timers
    and watermark go by the time of arrival, so a unit of any age is taken and none is late.
    State holds the units under way, each as large as one unit.
    """
    kept = [f for f in df.schema.fields if f.name != expected]
    row_type = T.StructType(kept)
    packed = df.select(
        F.col(unit).cast("string").alias("_unit"),
        F.to_json(F.struct(*[f.name for f in kept]), _EXACT).alias("_row"),
        (F.col(expected).cast("int") if expected else F.lit(None).cast("int")).alias("_expected"),
        F.current_timestamp().alias("_arrived"),
    )
    timed = packed.withWatermark("_arrived", f"{patience_ms} milliseconds").withColumn("_at", F.unix_millis("_arrived"))

    def gather(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, size = (list(state.get[0]), state.get[1]) if state.exists else ([], None)
        arrived = 0
        # a timer brings no rows
        for piece in () if state.hasTimedOut else pieces:
            rows.extend(piece["_row"].tolist())
            arrived = max(arrived, int(piece["_at"].max()))
            sizes = piece["_expected"].dropna()
            size = int(sizes.iloc[-1]) if len(sizes) else size
        complete = size is not None and len(rows) >= size
        if complete or state.hasTimedOut:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"_row": rows, "complete": complete})
        else:
            state.update((rows, size))
            state.setTimeoutTimestamp(arrived)

    whole = timed.groupBy("_unit").applyInPandasWithState(
        gather, "_row string, complete boolean", _GATHERED, "append", GroupStateTimeout.EventTimeTimeout
    )
    return whole.select(F.from_json("_row", row_type, _EXACT).alias("_r"), "complete").select("_r.*", "complete")


# --- rows behind the watermark ----------------------------------------------------------------


def routed_sink(path: str, observed_at: str, minutes: int, delay_minutes: int, *by: str) -> Callable[[DataFrame, int], None]:
    """Counts per tumbling slot, with rows of closed slots kept apart instead of dropped.

    A slot is closed once it ends at or before the newest time of earlier micro-batches less the
    delay.  ``on_time`` holds counts, ``late`` whole rows with the reason, both by micro-batch, so
    a micro-batch that runs again replaces what it wrote; ``marks`` holds each one's newest time.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, staged = session.staged(batch.withColumn(_BATCH, F.lit(batch_id).cast("bigint")), "micro-batch")
        try:
            mark = None
            if files.exists(spark, f"{path}/marks"):
                earlier = spark.read.schema(_MARKS).parquet(f"{path}/marks").where(F.col(_BATCH) < batch_id)
                mark = earlier.agg(F.max("newest")).first()[0]
            slot = F.timestamp_add("MINUTE", -(F.minute(observed_at) % minutes), clock.truncated(F.col(observed_at), "minute"))
            slotted = rows.withColumn("slot", slot)
            bound = F.lit(None).cast("timestamp_ntz") if mark is None else clock.wall(mark - dt.timedelta(minutes=delay_minutes))
            closed = F.timestamp_add("MINUTE", F.lit(minutes), F.col("slot")) <= bound
            reason = F.when(F.col("slot").isNull(), "no time").when(closed, "behind the watermark")
            judged = slotted.withColumns({"reason": reason, "bound": bound})
            late = judged.where("reason is not null")
            counted = judged.where("reason is null").groupBy("slot", *by, _BATCH).agg(F.count("*").alias("n"))
            sinks.write_partitions(late, f"{path}/late", [_BATCH])
            sinks.write_partitions(counted, f"{path}/on_time", [_BATCH])
            newest = rows.groupBy(_BATCH).agg(F.max(F.col(observed_at).cast("timestamp_ntz")).alias("newest"))
            sinks.write_partitions(newest.select("newest", _BATCH), f"{path}/marks", [_BATCH])
        finally:
            files.remove(spark, staged)

    return route


_BATCH = "batch_id"
_MARKS = f"newest timestamp_ntz, {_BATCH} bigint"


def slot_counts(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """Rows on time of every slot."""
    return spark.read.parquet(f"{path}/on_time").groupBy("slot", *by).agg(F.sum("n").alias("n"))


def late_counts(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """How many rows came too late, by reason and slot."""
    return spark.read.parquet(f"{path}/late").groupBy("reason", "slot", *by).agg(F.count("*").alias("n"))


def run_available(
    df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Process everything available now, then stop."""
    query = (
        df.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_sink(
    path: str, keys: Sequence[str], newest: str, by: str | None = sinks.DATE
) -> Callable[[DataFrame, int], None]:
    """Merge each micro-batch by key: the newest version by ``newest`` stays.

    Replaying a batch, or an older version arriving later, changes nothing.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        sinks.upsert_newest(batch.drop(EVENT_TIME), path, keys, newest, by)

    return merge


def append_sink(path: str, keys: Sequence[str], by: str = sinks.DATE) -> Callable[[DataFrame, int], None]:
    """Add the rows of each micro-batch whose key is not stored yet.

    A key may return after its state expired, and a batch may be replayed.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        sinks.add_unknown(batch.drop(EVENT_TIME).dropDuplicates(list(keys)), path, keys, by)

    return write


def replace_unit_sink(path: str, unit: str, by: str = sinks.DATE) -> Callable[[DataFrame, int], None]:
    """Late data by replacement: a load unit that arrives again replaces all its rows.

    A unit is what arrives whole in one micro-batch, such as a file's minute and
    area, or what :func:`whole_units` has gathered.  A micro-batch as such is no unit:
    other rows of its time range stay.
    """

    def replace(batch: DataFrame, _batch_id: int) -> None:
        sinks.replace_units(batch.drop(EVENT_TIME), path, unit, by)

    return replace
