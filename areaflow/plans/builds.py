"""Incremental builds of the facts: from loads not built yet, and for keys learned late.

A fact reads the source partitions of the loads that its ledger lacks, so neither the
order in which loads finish nor their clocks matter.  A load that ran again is built
again, and rows it no longer has leave the fact.

A lookup that finds nothing leaves a NULL in the fact, or no row where the join is an
inner one.  The missed key is noted with its date.  Once the dimension, or the parent
observation, has the key, the source rows with it are read on these dates alone and merged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow import contracts as c
from areaflow import session
from areaflow.operators import lookup
from areaflow.plans import marts, serving
from areaflow.sources import files, ledger, sinks
from areaflow.sources.tables import BATCH, Warehouse

DATE = sinks.DATE
PENDING = T.StructType([
    T.StructField("lookup", T.StringType()), T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField(DATE, T.DateType()),
])
PARENT = "parent"

Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Lookup:
    """A dimension's key columns; the same names in the source; and the fact column that stays NULL."""

    keys: tuple[str, ...]
    found: str
    #: Names of the keys in the source, where they differ.
    source_keys: tuple[str, ...] = ()

    def in_source(self) -> tuple[str, ...]:
        return self.source_keys or self.keys


AREA = Lookup(("area_code",), "area_id")


@dataclass(frozen=True)
class Plan:
    """How one fact comes from its sources."""

    name: str
    #: Sources whose rows become rows of the fact.
    sources: tuple[str, ...]
    #: The fact from source frames, dimensions and the run's clock; key columns of lookups are carried along.
    frame: Callable[[Frames, Frames, dt.datetime], DataFrame]
    lookups: dict[str, Lookup] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    #: A source whose rows are looked up, read on the dates of the others.
    parent: str | None = None
    #: Several loads hold versions of one row, so a date is read with all its loads.
    whole_days: bool = False

    def key(self) -> list[str]:
        return list(self.keys or (f"fact_{self.name}_id",))

    def carried(self) -> list[str]:
        return sorted({"observed_at", *(k for found in self.lookups.values() for k in found.keys)})


def _carry(plan: Plan, wanted: Sequence[str]) -> list[str]:
    return [k for k in plan.carried() if k in wanted]


def _commercial(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    staged = marts.stg_commercial(frames["commercial"])
    return marts.fact_commercial(staged, dims["area"], carry=["area_code", "observed_at"])


def _categories(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    staged = marts.stg_commercial_rsb(frames["commercial_rsb"], frames["commercial"], carry=["observed_at"])
    return marts.fact_commercial_rsb(staged, dims["category"], carry=["category_large", "category_medium", "source_id", "observed_at"])


def _population(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    staged = marts.stg_population(frames["population"])
    carry = ["area_code", "congestion_label", "observed_at"]
    return marts.fact_population(staged, dims["area"], dims["congestion"], run_ts, carry=carry)


def _transport(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    staged = [marts.stg_transit(frames[feed.label]) for feed in (c.BUS, c.SUBWAY)]
    return marts.fact_transport(*staged, dims["area"], run_ts, carry=["area_code", "observed_at"])


def _weather(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    return marts.fact_weather(marts.stg_weather(frames["weather"]), dims["area"], run_ts, carry=["area_code", "observed_at"])


def _events(frames: Frames, dims: Frames, run_ts: dt.datetime) -> DataFrame:
    staged = marts.stg_event(frames["event"])
    return marts.fact_event(staged, dims["event"], dims["area"], run_ts, carry=["area_code", "observed_at"])


PLANS = {
    plan.name: plan
    for plan in (
        Plan("commercial", ("commercial",), _commercial, {"area": AREA}),
        Plan(
            "commercial_rsb", ("commercial_rsb",), _categories,
            {"category": Lookup(("category_large", "category_medium"), "category_id"), PARENT: Lookup(("source_id",), "time_key")},
            ("fact_commercial_rsb_id",), parent="commercial",
        ),
        Plan(
            "population", ("population",), _population,
            {"area": AREA, "congestion": Lookup(("congestion_label",), "congestion_id")},
        ),
        Plan("transport", (c.BUS.label, c.SUBWAY.label), _transport, {"area": AREA}, whole_days=True),
        Plan("weather", ("weather",), _weather, {"area": AREA}),
        Plan("event", ("event",), _events, {"area": AREA}, ("event_id", "area_id", "observed_at")),
    )
}
MINUTE_FACTS = tuple(name for name in PLANS if name != "event")


def dimensions(wh: Warehouse) -> Frames:
    """The dimensions, each with unique keys: a repeated one would give an observation several rows."""
    areas = lookup.require_unique(wh.dimension("area"), "area_code")
    pairs = lookup.require_unique(wh.dimension("category"), "category_large", "category_medium")
    labels = lookup.require_unique(wh.dimension("congestion"), "congestion_label")
    return {"area": areas, "category": pairs, "congestion": labels}


# --- what a build reads ---------------------------------------------------------------


def source_rows(
    wh: Warehouse, source: str, days: Sequence[dt.date | None] | None = None, loads: Sequence[str] | None = None
) -> DataFrame:
    """A source on some dates and of some loads; both select partitions."""
    stored = wh.stored(source)
    if days is not None:
        stored = sinks.on_days(stored, DATE, list(days))
    if loads is not None and BATCH in stored.columns:
        stored = stored.where(F.col(BATCH).isin(list(loads)))
    return stored.select(*c.SOURCE_TABLES[source].names, DATE)


@dataclass
class New:
    """Loads a fact lacks, as names and dates; a handful between two builds."""

    loads: dict[str, set[str]] = field(default_factory=dict)
    days: dict[str, set] = field(default_factory=dict)
    again: set = field(default_factory=set)

    @classmethod
    def of(cls, unbuilt: DataFrame) -> New:
        new = cls()
        for row in unbuilt.collect():
            new.loads.setdefault(row.source, set()).add(row.load)
            new.days.setdefault(row.source, set()).update(row.days)
            if row.again:
                new.again.update(row.days)
        return new

    def of_sources(self, sources: Sequence[str]) -> set:
        return set().union(*(self.days.get(s, set()) for s in sources))


def _frames(wh: Warehouse, plan: Plan, days: set | None, new: New | None = None) -> Frames:
    """Source frames of a plan: everything, whole dates, or the new loads on their dates."""
    frames = {}
    for source in plan.sources:
        if new is None or plan.whole_days:
            frames[source] = source_rows(wh, source, days)
        else:
            frames[source] = source_rows(wh, source, new.days.get(source, set()), new.loads.get(source, set()))
    if plan.parent:
        frames[plan.parent] = source_rows(wh, plan.parent, days)
    return frames


# --- keys missed and learned ------------------------------------------------------------


def _key(name: str):
    return F.col(marts.carried(name))


def missed(plan: Plan, built: DataFrame) -> DataFrame:
    """Distinct keys that found nothing, by date."""
    none = built.sparkSession.createDataFrame([], PENDING)
    for name, found in plan.lookups.items():
        keys = F.array(*[_key(k).cast("string") for k in found.keys])
        rows = built.where(F.col(found.found).isNull()).dropna(subset=[marts.carried(k) for k in found.keys] + [DATE])
        none = none.unionByName(rows.select(F.lit(name).alias("lookup"), keys.alias("keys"), DATE))
    return none.distinct()


def _learned(wh: Warehouse, plan: Plan, dims: Frames, new: New) -> tuple[DataFrame, str] | None:
    """Noted keys that the dimensions, or parents of new loads, have now."""
    path = wh.path("pending", plan.name)
    if not files.exists(wh.spark, path):
        return None
    noted = files.read_or_empty(wh.spark, path, PENDING)
    known = wh.spark.createDataFrame([], PENDING)
    for name, found in plan.lookups.items():
        if name == PARENT:
            side = source_rows(wh, plan.parent, new.days.get(plan.parent, set()), new.loads.get(plan.parent, set()))
        else:
            side = dims[name]
        keys = side.select(F.array(*[F.col(k).cast("string") for k in found.keys]).alias("keys")).distinct()
        known = known.unionByName(noted.where(F.col("lookup") == name).join(keys, "keys", "left_semi").select(*PENDING.names))
    return session.staged(known, "learned")


def _with_keys(plan: Plan, rows: DataFrame, learned: DataFrame) -> DataFrame:
    """Source rows that hold a learned key, each once."""
    kept = []
    for name, found in plan.lookups.items():
        side = learned.where(F.col("lookup") == name).select(F.col("keys").alias("_keys"), F.col(DATE).alias("_date"))
        keys = F.array(*[rows[k].cast("string") for k in found.in_source()])
        same = (keys == side["_keys"]) & (rows[DATE] == side["_date"])
        kept.append(rows.join(side, same, "left_semi"))
        rows = rows.join(side, same, "left_anti")
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


# --- a build --------------------------------------------------------------------------------


def build(wh: Warehouse, plan: Plan, dims: Frames, run_ts: dt.datetime, full_refresh: bool = False) -> bool:
    """Bring a fact up to date with its sources; tells whether there was anything to do.

    The first build, or a full refresh, reads everything.
    """
    sources = [*plan.sources, *([plan.parent] if plan.parent else [])]
    for source in sources:
        ledger.adopt(wh, source)
    unbuilt, unbuilt_path = ledger.unbuilt(wh, plan.name, sources)
    scratch = [unbuilt_path]
    try:
        if full_refresh or not ledger.is_built(wh, plan.name):
            _build_all(wh, plan, dims, run_ts, scratch)
        elif not _build_new(wh, plan, dims, run_ts, New.of(unbuilt), scratch):
            return False
        ledger.mark_built(wh, plan.name, unbuilt)
        return True
    finally:
        for path in scratch:
            files.remove(wh.spark, path)


def _dated(built: DataFrame) -> DataFrame:
    return built.withColumn(DATE, F.to_date(_key("observed_at")))


def _rows(plan: Plan, built: DataFrame) -> DataFrame:
    """The fact's own rows and columns."""
    kept = built.dropna(subset=[k for k in plan.key() if k == "area_id"])
    return kept.drop(*[n for n in built.columns if marts.is_carried(n)])


def _build_all(wh: Warehouse, plan: Plan, dims: Frames, run_ts: dt.datetime, scratch: list[str]) -> None:
    built, path = session.staged(_dated(plan.frame(_frames(wh, plan, None), dims, run_ts)), "build")
    scratch.append(path)
    rows = _rows(plan, built)
    sinks.write_partitions(rows, wh.path("fact", plan.name), [DATE], keep_others=False)
    serving.refresh(wh, plan.name, rows, None)
    keys = missed(plan, built)
    if files.exists(wh.spark, wh.path("pending", plan.name)) or not keys.isEmpty():
        sinks.write_partitions(keys, wh.path("pending", plan.name), [DATE], keep_others=False)


def _build_new(
    wh: Warehouse, plan: Plan, dims: Frames, run_ts: dt.datetime, new: New, scratch: list[str]
) -> bool:
    days = new.of_sources(plan.sources)
    learned = _learned(wh, plan, dims, new)
    late_days: set = set()
    parts = []
    if days:
        parts.append(plan.frame(_frames(wh, plan, days, new), dims, run_ts))
    if learned:
        scratch.append(learned[1])
        late_days = {row[0] for row in learned[0].select(DATE).distinct().collect()}
    if late_days:
        frames = _frames(wh, plan, late_days)
        late = plan.frame({s: _with_keys(plan, f, learned[0]) if s in plan.sources else f for s, f in frames.items()}, dims, run_ts)
        parts.append(late.join(parts[0], plan.key(), "left_anti").select(*late.columns) if parts else late)
    if not parts:
        # loads of the parent alone, which no row was waiting for, are done with
        return bool(new.loads)
    built, path = session.staged(_dated(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])), "build")
    scratch.append(path)
    fact_path, rows = wh.path("fact", plan.name), _rows(plan, built)
    again = sorted(new.again & days)
    if again:
        alive, alive_path = session.staged(plan.frame(_frames(wh, plan, new.again), dims, run_ts).select(*plan.key()), "alive")
        scratch.append(alive_path)
        touched = sinks.upsert_alive(rows, fact_path, plan.key(), alive, again)
    else:
        touched = sinks.upsert(rows, fact_path, plan.key())
    serving.refresh(wh, plan.name, rows, touched, again)
    _note(wh, plan, missed(plan, built), learned[0] if late_days else None)
    return True


def _note(wh: Warehouse, plan: Plan, keys: DataFrame, learned: DataFrame | None) -> None:
    path = wh.path("pending", plan.name)
    if learned is not None or not keys.isEmpty():
        sinks.exchange(keys, keys.limit(0) if learned is None else learned.select(*keys.columns), path, PENDING.names)
