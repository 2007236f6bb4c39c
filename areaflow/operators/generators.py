"""Arrays and maps to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows(df: DataFrame, array: Column, name: str, *, outer: bool = False, first_only: bool = False) -> DataFrame:
    """One row per element.

    ``outer`` keeps parents without elements; ``first_only`` takes the first
    element instead of generating rows.
    """
    if first_only:
        out = df.withColumn(name, F.get(array, F.lit(0)))
        return out if outer else out.where(F.size(array) > 0)
    if outer:
        return df.withColumn(name, F.explode_outer(array))
    # For a plain explode Catalyst infers size(array) > 0 and pushes it down to
    # where the array is made, so a parsed or computed array would be made twice.
    # A position filter above the generator says the same without that.
    return df.select("*", F.posexplode_outer(array).alias("_pos", name)).where("_pos is not null").drop("_pos")


def map_rows(df: DataFrame, mapping: Column, key: str, *keep: str) -> DataFrame:
    """``map<k, array<struct>>`` to one row per struct, fields expanded."""
    # a plain explode would have a parsed map parsed once more, as in rows; no items give no row below
    pairs = df.select(*keep, F.explode_outer(mapping).alias(key, "_items"))
    return pairs.select(*keep, key, F.inline("_items"))
