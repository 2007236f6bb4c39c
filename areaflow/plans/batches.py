"""Loads and builds: a file window into source tables, source tables into marts.

A load is named by its window's start and end.  It reads its documents once into
shared scratch, writes its own (date, load) partitions, takes away those it no
longer holds, and records the history last, under its name.  A repeat ignores the
entries of its own name, so it writes the complete window again and loses nothing;
loads of overlapping windows have other names and are left alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaflow import contracts as c
from areaflow import session
from areaflow.functions import clock, text
from areaflow.operators import history, lookup, minutes
from areaflow.plans import builds, feeds, marts
from areaflow.sources import files, ledger, paths, raw, sinks
from areaflow.sources.tables import BATCH, Warehouse

def load_name(start: dt.datetime, end: dt.datetime) -> str:
    return f"{start:%Y%m%d%H%M}-{end:%Y%m%d%H%M}"


def store_load(wh: Warehouse, name: str, df: DataFrame, load: str) -> None:
    """Store a load of a source and record it for the builds."""
    dated = df.withColumns({sinks.DATE: F.to_date("observed_at"), BATCH: F.lit(load)})
    touched = sinks.replace_load(dated, wh.path("source", name), load, [sinks.DATE, BATCH])
    if touched:
        ledger.record(wh, name, load, sorted({_day(folder) for folder in touched}, key=str))


def _day(folder: str) -> dt.date | None:
    """The date of a partition folder."""
    value = folder.split("/")[0].split("=")[1]
    return None if value.startswith("__") else dt.date.fromisoformat(value)


def _known(wh: Warehouse, feed: str, seen: DataFrame, load: str) -> DataFrame:
    """Minutes of other loads on the batch's dates, one row per area and date."""
    packed = history.by_others(history.for_batch(wh.history_minutes(feed), seen), load)
    older = history.by_others(history.for_batch(wh.history_rows(feed), seen), load)
    columns = ["area_id", sinks.DATE, minutes.BITS, minutes.REST]
    return minutes.merged(packed.select(*columns).unionByName(minutes.pack(older).select(*columns)))


def _remember(wh: Warehouse, feed: str, seen: DataFrame, run_ts: dt.datetime, load: str) -> None:
    entries = history.unseen(history.entries_of(seen, run_ts), _known(wh, feed, seen, load))
    fresh = minutes.pack(entries, by=["processed_at"]).withColumn(BATCH, F.lit(load))
    sinks.replace_load(fresh, wh.path("history_minutes", feed), load, [sinks.DATE, BATCH])


def refuse(docs: DataFrame, wh: Warehouse, run_ts: dt.datetime, load: str) -> DataFrame:
    """The documents that name an area; the others go to a table of refused ones, with the reason."""
    code = F.trim(F.coalesce(F.col(c.AREA_CODE), F.lit("")))
    bad = docs.where(code == "").select(
        "path", F.lit("no area code").alias("reason"), clock.wall(run_ts).alias("refused_at"), F.lit(load).alias(BATCH)
    )
    sinks.replace_load(bad, wh.path("refused", "documents"), load, [BATCH])
    return docs.where(code != "")


def _documents(
    wh: Warehouse, base: str, start: dt.datetime, end: dt.datetime, multiline: bool
) -> tuple[DataFrame, str]:
    """The window's documents, parsed once for all feeds that read them."""
    return session.staged(raw.window(wh.spark, base, start, end, multiline), "documents")


def load_commercial(docs: DataFrame, wh: Warehouse, load: str, run_ts: dt.datetime) -> None:
    """The first document of each observation not loaded before."""
    observed = clock.parse(F.col(f"{c.COMMERCIAL}.{c.COMMERCIAL_TIME}"), c.COMPACT_MINUTE)
    seen = docs.select(F.col("file_area_id").alias("area_id"), observed.alias("observed_at"), "path").dropna()
    first = paths.first_per_location(seen, "area_id", "observed_at").select("path")
    chosen = docs.join(first, "path", "left_semi")
    known = _known(wh, "commercial", seen, load)
    store_load(wh, "commercial", feeds.commercial(chosen, run_ts, known), load)
    store_load(wh, "commercial_rsb", feeds.commercial_rsb(chosen, run_ts, known), load)
    _remember(wh, "commercial", seen, run_ts, load)


def load_population(docs: DataFrame, wh: Warehouse, load: str, run_ts: dt.datetime) -> None:
    typed, path = session.staged(feeds.population(docs, run_ts), "population")
    numbered = typed.withColumn("area_id", text.area_number(F.col("area_code")))
    fresh = history.unseen(numbered, _known(wh, "population", numbered, load))
    store_load(wh, "population", fresh.drop("area_id"), load)
    _remember(wh, "population", numbered.select("area_id", "observed_at").dropna(), run_ts, load)
    files.remove(wh.spark, path)


def load_transit(docs: DataFrame, wh: Warehouse, load: str, run_ts: dt.datetime) -> None:
    for feed in (c.BUS, c.SUBWAY):
        store_load(wh, feed.label, feeds.transit(docs, feed, run_ts), load)


def load_weather(docs: DataFrame, wh: Warehouse, load: str, run_ts: dt.datetime) -> None:
    """Observations replace themselves by id.

    A window's files are not all that report its observations, so nothing else is removed.
    """
    batch = feeds.weather(docs, run_ts).where("observed_at is not null").withColumn(sinks.DATE, F.to_date("observed_at"))
    days = sinks.upsert(batch, wh.path("source", "weather"), ["source_id"])
    if days:
        ledger.record(wh, "weather", load, sorted(days))


def load_events(wh: Warehouse, base: str, day: dt.date, run_ts: dt.datetime, multiline: bool = False) -> None:
    """The day's slot; a second run replaces the day."""
    docs = raw.daily_slot(wh.spark, base, day, multiline=multiline)
    midnight = dt.datetime.combine(day, dt.time())
    batch = feeds.event(docs, run_ts, clock.wall(midnight)).withColumn(sinks.DATE, F.lit(day))
    sinks.replace_key(batch, wh.path("source", "event"), "observed_at", midnight)
    ledger.record(wh, "event", str(day), [day])


def load_window(
    wh: Warehouse, base: str, start: dt.datetime, end: dt.datetime, run_ts: dt.datetime, multiline: bool = False
) -> None:
    """All minute feeds of a half-open file window, from one scan."""
    load = load_name(start, end)
    docs, path = _documents(wh, base, start, end, multiline)
    try:
        docs = refuse(docs, wh, run_ts, load)
        load_commercial(docs, wh, load, run_ts)
        load_population(docs, wh, load, run_ts)
        load_transit(docs, wh, load, run_ts)
        load_weather(docs, wh, load, run_ts)
    finally:
        files.remove(wh.spark, path)


def load_night(wh: Warehouse, base: str, run_ts: dt.datetime, multiline: bool = False) -> None:
    """The 21:00 -> 09:00 backfill."""
    start, end = clock.previous_night(run_ts)
    load_window(wh, base, start, end, run_ts, multiline)


def build_event_marts(wh: Warehouse, run_ts: dt.datetime, full_refresh: bool = False) -> None:
    """The event dimension first: the fact reads the stored ids."""
    _build_events(wh, run_ts, full_refresh)
    areas = lookup.require_unique(wh.dimension("area"), "area_code")
    events = wh.existing("dim", "event")
    if events is not None:
        builds.build(wh, builds.PLANS["event"], {"area": areas, "event": events}, run_ts, full_refresh)


def _build_events(wh: Warehouse, run_ts: dt.datetime, full_refresh: bool) -> None:
    ledger.adopt(wh, "event")
    unbuilt, path = ledger.unbuilt(wh, _EVENTS, ["event"])
    try:
        everything = full_refresh or not ledger.is_built(wh, _EVENTS)
        days = None if everything else builds.New.of(unbuilt).of_sources(["event"])
        if days is None or days:
            events = marts.dim_event(marts.stg_event(builds.source_rows(wh, "event", days)), run_ts)
            if everything:
                sinks.replace_prefix(events, wh.path("dim", "event"))
            else:
                sinks.insert_only(events, wh.path("dim", "event"), ["event_id"])
            ledger.mark_built(wh, _EVENTS, unbuilt)
    finally:
        files.remove(wh.spark, path)


_EVENTS = "dim_event"


def build_marts(
    wh: Warehouse, run_ts: dt.datetime, full_refresh: bool = False, facts: Sequence[str] = builds.MINUTE_FACTS
) -> list[str]:
    """The minute facts, from loads not built yet unless a full refresh is asked for; returns those that changed."""
    dims = builds.dimensions(wh)
    return [name for name in facts if builds.build(wh, builds.PLANS[name], dims, run_ts, full_refresh)]
