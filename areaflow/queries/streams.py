"""Micro-batch loads run as streams: several landings, one run each, with state that expires in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import session
from areaflow.functions import clock
from areaflow.queries.registry import query, table
from areaflow.sources import sinks
from areaflow.streaming import batches

_LAYOUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_DELAY = "2 days"


def _events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


def _thirds(rows: DataFrame) -> list[DataFrame]:
    """The month in three consecutive parts."""
    first, second = clock.wall("2024-01-11"), clock.wall("2024-01-21")
    ts = F.col("ts")
    return [rows.where(ts < first), rows.where((ts >= first) & (ts < second)), rows.where(ts >= second)]


def _stream(
    landings: list[list[DataFrame]], shape: Callable[[DataFrame], DataFrame], sink, mode: str = "append"
) -> None:
    """Each landing adds JSON files, one write per frame, and is followed by one run over what is new."""
    spark = landings[0][0].sparkSession
    path, checkpoint = session.scratch(spark, "stream-in"), session.scratch(spark, "checkpoint")
    schema = landings[0][0].schema
    for frames in landings:
        for frame in frames:
            frame.write.mode("append").option("timestampNTZFormat", _LAYOUT).json(path)
        rows = spark.readStream.schema(schema).option("timestampNTZFormat", _LAYOUT).json(path)
        batches.run_available(shape(rows), checkpoint, sink, mode)


def _dated(rows: DataFrame, column: str = "ts") -> DataFrame:
    return rows.withColumn(sinks.DATE, F.to_date(column))


@query("b5_stream_unseen_keys", "SELECT event_id, ts, user_id, event_type FROM events")
def _(spark, sf):
    """Every document arrives twice, some once more after their state expired; each is stored once."""
    path = session.scratch(spark, "stream-unseen")
    first, second, third = _thirds(_events(spark, sf))
    again = first.where("event_type = 'click'")
    _stream(
        [[first, first], [second, second], [third, third, again]],
        lambda rows: _dated(batches.unseen(rows, ["user_id", "ts"], "ts", _DELAY)),
        batches.append_sink(path, ["user_id", "ts"]),
    )
    return spark.read.parquet(path).drop(sinks.DATE)


@query(
    "b8_stream_upsert",
    """SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN 3 ELSE 2 END AS version,
         CAST(ts AS DATE) AS observed_date FROM events""",
)
def _(spark, sf):
    """Versions of a key within one micro-batch and over several; the newest stays, an older one changes nothing."""
    path = session.scratch(spark, "stream-upsert")
    rows = _events(spark, sf)

    def version(n: int, some: DataFrame = rows) -> DataFrame:
        return some.withColumn("version", F.lit(n))

    _stream(
        [[version(2), version(1)], [version(3, rows.where("event_type = 'click'"))], [version(1)]],
        _dated,
        batches.upsert_sink(path, ["event_id"], "version"),
    )
    return spark.read.parquet(path).select("event_id", "event_type", "version", sinks.DATE)


@query(
    "b7_stream_replace_unit",
    """SELECT event_id, ts, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 2 ELSE 1 END AS load
       FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15' OR event_type <> 'click'""",
)
def _(spark, sf):
    """Days arrive as units; one arrives again without some rows, and nothing else changes."""
    path = session.scratch(spark, "stream-unit")
    rows = _dated(_events(spark, sf)).select("event_id", "ts", "event_type", F.col(sinks.DATE).cast("string").alias("unit"))
    parts = [part.withColumn("load", F.lit(1)) for part in _thirds(rows)]
    again = rows.where("unit = '2024-01-15' AND event_type <> 'click'").withColumn("load", F.lit(2))
    _stream([[p] for p in parts] + [[again]], _dated, batches.replace_unit_sink(path, "unit"))
    return spark.read.parquet(path).select("event_id", "ts", "event_type", "load")


@query(
    "b1_stream_tumbling",
    "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    """Complete counts per slot: later updates replace a slot's count, rows behind the watermark are dropped."""
    path = session.scratch(spark, "stream-tumbling")
    first, second, third = _thirds(_events(spark, sf))
    _stream(
        [[first], [second], [third, first]],
        lambda rows: _dated(batches.tumbling(rows, "ts", 5, _DELAY, "event_type"), "slot"),
        batches.upsert_sink(path, ["slot", "event_type"], "n"),
        mode="update",
    )
    return spark.read.parquet(path).drop(sinks.DATE)


@query(
    "b7_stream_unit_in_pieces",
    """SELECT event_id, ts, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 2 ELSE 1 END AS load, true AS complete
       FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15' OR event_type <> 'click'""",
)
def _(spark, sf):
    """Days are units whose rows arrive over three triggers; one arrives again later, in two pieces, and replaces itself."""
    path = session.scratch(spark, "stream-pieces")
    rows = _dated(_events(spark, sf)).select("event_id", "ts", "event_type", F.col(sinks.DATE).cast("string").alias("unit"))
    sizes = rows.groupBy("unit").agg(F.count("*").alias("size"))
    first = rows.join(sizes, "unit").withColumn("load", F.lit(1))
    again = rows.where("unit = '2024-01-15' AND event_type <> 'click'").withColumn("load", F.lit(2))
    again = again.join(again.groupBy("unit").agg(F.count("*").alias("size")), "unit").select(*first.columns)
    pieces = [first.where(F.col("event_id") % 3 == i) for i in range(3)]
    halves = [again.where(F.col("event_id") % 2 == i) for i in range(2)]
    _stream(
        [[p] for p in [*pieces, *halves]],
        lambda stream: batches.whole_units(_dated(stream), "unit", expected="size"),
        batches.replace_unit_sink(path, "unit"),
    )
    return spark.read.parquet(path).select("event_id", "ts", "event_type", "load", "complete")


@query(
    "b6_stream_late_rows",
    """SELECT 'on time' AS arrived, event_type, count(*) AS n FROM events GROUP BY event_type
       UNION ALL SELECT 'behind the watermark', event_type, count(*) FROM events
       WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-11' GROUP BY event_type""",
)
def _(spark, sf):
    """The month in thirds, clicks of the first again with the last: these are kept as late, with the reason."""
    path = session.scratch(spark, "stream-late")
    first, second, third = _thirds(_events(spark, sf))
    _stream(
        [[first], [second], [third, first.where("event_type = 'click'")]],
        lambda stream: stream,
        batches.routed_sink(path, "ts", 5, 2 * 24 * 60, "event_type"),
    )
    on_time = batches.slot_counts(spark, path, "event_type").select(F.lit("on time").alias("arrived"), "event_type", "n")
    late = batches.late_counts(spark, path, "event_type").select(F.col("reason").alias("arrived"), "event_type", "n")
    return on_time.unionByName(late).groupBy("arrived", "event_type").agg(F.sum("n").alias("n"))
