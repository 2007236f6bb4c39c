"""Schema conformance, fills and column order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areaflow.contracts import Field
from areaflow.functions import clock
from areaflow.functions.parsing import RULES


def project(payload: str, fields: Iterable[Field]) -> list[Column]:
    """Select, parse and rename payload fields as a contract table says."""
    return [RULES[f.rule](F.col(f"{payload}.`{f.raw}`")).alias(f.column) for f in fields]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in order, cast with NULL on failure."""
    have = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        wanted = field.dataType.simpleString()
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif have[field.name] == wanted:
            column = F.col(field.name)
        else:
            column = F.col(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def fill_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing integers become 0 and missing texts ''; timestamps stay NULL."""
    fills = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.IntegerType):
            fills[field.name] = 0
        elif isinstance(field.dataType, T.StringType):
            fills[field.name] = ""
    return df.fillna(fills)


def check_positions(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Guard for positional loads: same count and types in the same places."""
    got = [t for _, t in df.dtypes]
    want = [f.dataType.simpleString() for f in schema.fields]
    if got != want:
        raise ValueError(f"positional load expects {want}, got {got}")
    return df.toDF(*schema.names)


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(clock.date_parts(F.col(ts)))


def display(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their display names."""
    return df.select(*[F.col(k).alias(v) for k, v in names.items()])
