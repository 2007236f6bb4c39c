"""Dimension lookups.

No broadcast hint is given: Spark broadcasts a dimension when its measured size
is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
adaptive execution splits hot keys of the left side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add dimension columns by equality.

    ``on`` maps columns of ``df`` to dimension columns, ``take`` maps dimension
    columns to the names they get.  ``how="inner"`` drops unmatched rows.
    """
    keys = {d: f"_dim_{i}" for i, d in enumerate(on.values())}
    side = dim.select(*[F.col(d).alias(k) for d, k in keys.items()], *[F.col(d).alias(n) for d, n in take.items()])
    condition = [df[column] == side[keys[d]] for column, d in on.items()]
    return df.join(side, condition, how).drop(*keys.values())


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count; a NULL key matches nothing and may repeat."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fail when a key repeats: it would fan out a lookup or a merge."""
    repeated = duplicate_keys(df, *keys).limit(5).collect()
    if repeated:
        raise ValueError(f"duplicate keys {list(keys)}: {[tuple(r) for r in repeated]}")
    return df
