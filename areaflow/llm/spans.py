"""Columns derived from an array of found spans."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS_SQL = "array<struct<kind:string,start:int,end:int,base:boolean>>"
SPANS_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
)


def digest(found: Column, only_base: bool) -> Column:
    """``kind:start:end`` of the spans in their order, joined by commas."""
    kept = F.filter(found, lambda s: s["base"]) if only_base else found
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def columns(found: Column, kinds: Sequence[str]) -> list[Column]:
    """A count of base spans for each kind, the hash of the base spans, and all spans as text."""

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["base"] & (s["kind"] == F.lit(kind)))).cast("long")

    return [
        *(count(k).alias(f"n_{k}") for k in kinds),
        F.sha2(F.encode(digest(found, True), "UTF-8"), 256).alias("base_sha256"),
        digest(found, False).alias("spans"),
    ]
