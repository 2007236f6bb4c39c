"""History as bitmaps: one row per area and date holds which minutes were loaded.

A feed observes an area at most once a minute, so a date's history is 1,440 bits; a
lookup is a join by area and date and a test of one bit.  Entries off the whole minute,
which imported documents may hold, stand in a list beside the bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions import clock

#: Bytes of a date's bits.
BYTES = 180
#: Words of 64 bits for them; half of the last stays empty.
WORDS = 23
DATE = "observed_date"
BITS, REST = "bits", "rest"


def is_packed(df: DataFrame) -> bool:
    return BITS in df.columns and REST in df.columns


def _minute(at: Column) -> Column:
    return F.hour(at) * 60 + F.minute(at)


def _whole(at: Column) -> Column:
    return at == clock.truncated(at, "minute")


def _word(i: int) -> str:
    return f"_word_{i}"


def _bits() -> Column:
    """The bytes of all words; a word's first byte is its highest."""
    digits = [F.lpad(F.hex(F.coalesce(_word(i), F.lit(0))), 16, "0") for i in range(WORDS)]
    return F.substr(F.unhex(F.concat(*digits)), F.lit(1), F.lit(BYTES)).alias(BITS)


def pack(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``area_id, observed_date, *by, bits, rest`` of history rows; rows without an area or time are left out."""
    at, minute = F.col("observed_at"), F.when(_whole(F.col("observed_at")), _minute(F.col("observed_at")))
    known = history.dropna(subset=["area_id", "observed_at"])
    # the bit of a minute in its word, whose bytes are read from the highest down
    place = 56 - F.floor(minute % 64 / 8) * 8 + minute % 8
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
    placed = known.select(
        "area_id", F.to_date(at).alias(DATE), *by, F.floor(minute / 64).alias("_at"), one.alias("_one"), F.when(~_whole(at), at).alias("_off")
    )
    # words of a date's own size: Spark's bitmap aggregate carries 4,096 bytes for every group through shuffles and sorts;
    # the list is empty for whole minutes
    words = [F.bit_or(F.when(F.col("_at") == i, F.col("_one"))).alias(_word(i)) for i in range(WORDS)]
    packed = placed.groupBy("area_id", DATE, *by).agg(*words, F.collect_set("_off").alias(REST))
    return packed.select("area_id", DATE, *by, _bits(), F.array_sort(REST).alias(REST))


def merged(packed: DataFrame) -> DataFrame:
    """One row per area and date from those of several loads."""
    digits = packed.select("area_id", DATE, F.rpad(F.hex(BITS), 16 * WORDS, "0").alias("_digits"), REST)

    def number(i: int) -> Column:
        own = F.substr(F.col("_digits"), F.lit(16 * i + 1), F.lit(16))
        return F.when(own != "0" * 16, F.conv(own, 16, -10).cast("long"))

    words = [F.bit_or(number(i)).alias(_word(i)) for i in range(WORDS)]
    one = digits.groupBy("area_id", DATE).agg(*words, F.array_distinct(F.flatten(F.collect_list(REST))).alias(REST))
    return one.select("area_id", DATE, _bits(), REST)


def _bit(bits: Column, minute: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (minute / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (minute % 8).cast("int")).bitwiseAND(1) == 1


def unpack(packed: DataFrame) -> DataFrame:
    """Rows again: ``area_id, observed_at``, the columns beside, and ``observed_date``."""
    beside = [c for c in packed.columns if c not in ("area_id", DATE, BITS, REST)]
    bits = F.col(BITS)

    def within(places: Column, width: int, end: int) -> Column:
        """The ``width`` numbers below each place, up to ``end``."""
        return F.flatten(F.transform(places, lambda p: F.sequence(p * width, F.least(p * width + width, F.lit(end)) - 1)))

    # most of a date is empty, so words are looked at first, then the bytes of some, then the bits of some of these
    words = F.filter(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.substr(bits, w * 8 + 1, F.lit(8)) != F.lit(bytes(8)))
    filled = F.filter(within(words, 8, BYTES), lambda b: F.substr(bits, b + 1, F.lit(1)) != F.lit(bytes(1)))
    set_ = F.filter(within(filled, 8, BYTES * 8), lambda m: _bit(bits, m))
    midnight = F.col(DATE).cast("timestamp_ntz")
    times = F.transform(set_, lambda m: F.timestamp_add("MINUTE", m, midnight))
    # a plain explode would have the list made once more, for a filter on its size
    rows = packed.select("area_id", F.explode_outer(F.concat(times, REST)).alias("observed_at"), *beside, DATE)
    return rows.where("observed_at is not null")


def unseen(batch: DataFrame, packed: DataFrame, area: str = "area_id", observed_at: str = "observed_at") -> DataFrame:
    """Batch rows whose area and time are not in the packed history; ``packed`` has one row per area and date."""
    side = packed.select(F.col("area_id").alias("_area"), F.col(DATE).alias("_date"), F.col(BITS).alias("_bits"), F.col(REST).alias("_rest"))
    at = batch[observed_at]
    joined = batch.join(side, (batch[area] == side["_area"]) & (F.to_date(at) == side["_date"]), "left")
    seen = F.when(_whole(at), _bit(F.col("_bits"), _minute(at))).otherwise(F.array_contains("_rest", at))
    return joined.where(~F.coalesce(seen, F.lit(False))).drop("_area", "_date", "_bits", "_rest")
