"""Dashboard reads over source tables and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areaflow.functions import clock
from areaflow.operators import conform, dedupe

# --- fixed values: display names of the dashboards ----------------------------

_RATIO_NAMES = {
    "male_ratio": "남성(%)",
    "female_ratio": "여성(%)",
    "age_10s_ratio": "10대 이하(%)",
    "age_20s_ratio": "20대(%)",
    "age_30s_ratio": "30대(%)",
    "age_40s_ratio": "40대(%)",
    "age_50s_ratio": "50대(%)",
    "age_60s_ratio": "60대 이상(%)",
    "individual_consumer_ratio": "개인(%)",
    "corporate_consumer_ratio": "법인(%)",
}
_PAYMENT_NAMES = {
    "congestion_level": "상권 현황",
    "total_payment_count": "결제 건수(신한)",
    "payment_amount_min": "결제 금액(최소)",
    "payment_amount_max": "결제 금액(최대)",
}
_CATEGORY_NAMES = {
    "category_congestion_level": "상권 현황",
    "category_payment_count": "업종별 결제 건수",
    "category_payment_min": "결제 금액(최소)",
    "category_payment_max": "결제 금액(최대)",
    "merchant_count": "가맹점 수",
    "merchant_basis_month": "가맹점 수 업데이트 기준",
}
_SOURCE_TIMES = {"observed_at": "기준 시각", "created_at": "적재 시간"}

FACT_COMMERCIAL_NAMES = {
    **_PAYMENT_NAMES,
    **_RATIO_NAMES,
    "area_id": "장소명(ID)",
    "time_key": "기준 시각",
}
FACT_CATEGORY_NAMES = {
    "fact_commercial_id": "fact_commercial_id",
    **_CATEGORY_NAMES,
    "category_id": "category_id",
}
SOURCE_COMMERCIAL_NAMES = {
    "area_code": "장소명(코드)",
    "area_name": "장소명",
    **_PAYMENT_NAMES,
    **_RATIO_NAMES,
    **_SOURCE_TIMES,
}
SOURCE_CATEGORY_NAMES = {
    "category_large": "대분류",
    "category_medium": "중분류",
    **_CATEGORY_NAMES,
    **_SOURCE_TIMES,
}


def top_k(df: DataFrame, order: Sequence[str], ties: Sequence[str], k: int = 10) -> DataFrame:
    """First ``k`` rows, NULLs last; ``ties`` makes the choice unique."""
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in (*order, *ties)]).limit(k)


def fact_commercial_view(fact: DataFrame) -> DataFrame:
    return conform.display(top_k(fact, ["area_id"], ["time_key", "fact_commercial_id"]), FACT_COMMERCIAL_NAMES)


def fact_category_view(fact: DataFrame) -> DataFrame:
    return conform.display(
        top_k(fact, ["category_id"], ["time_key", "fact_commercial_id", "fact_commercial_rsb_id"]),
        FACT_CATEGORY_NAMES,
    )


def source_commercial_view(source: DataFrame) -> DataFrame:
    return conform.display(top_k(source, ["area_name"], ["observed_at", "source_id"]), SOURCE_COMMERCIAL_NAMES)


def source_category_view(source: DataFrame) -> DataFrame:
    return conform.display(
        top_k(source, ["category_large", "observed_at"], ["category_medium", "commercial_id"]),
        SOURCE_CATEGORY_NAMES,
    )


def latest_snapshot(commercial: DataFrame, population: DataFrame, weather: DataFrame) -> DataFrame:
    """Newest commercial, population and weather row of every area.

    On stored facts pass the last days only (``observed_date``): a live view
    needs no more, and older partitions are then not opened.
    """
    def newest(fact: DataFrame, feed: str, *columns: str) -> DataFrame:
        minute = F.col("time_key").alias(f"{feed}_time_key")
        return dedupe.latest_per_group(fact, "area_id", "time_key", [minute, *columns], [f"fact_{feed}_id"])

    spends = newest(commercial, "commercial", "congestion_level", "total_payment_count")
    crowds = newest(population, "population", "congestion_id", "population_min", "population_max")
    skies = newest(weather, "weather", "temperature", "pm10_value", "air_quality_value")
    return spends.join(crowds, "area_id", "full").join(skies, "area_id", "full")


def _key_bounds(start: dt.datetime, end: dt.datetime) -> Column:
    low, high = (int(f"{t:%Y%m%d%H%M}") for t in (start, end))
    return (F.col("time_key") >= low) & (F.col("time_key") < high)


def weekly_stats(fact_population: DataFrame, run_ts: dt.datetime, area_id: int | None = None) -> DataFrame:
    """Crowd size by weekday and hour over the week before ``run_ts``."""
    week = fact_population.where(_key_bounds(*clock.previous_week(run_ts)))
    if area_id is not None:
        week = week.where(F.col("area_id") == area_id)
    at = F.try_to_timestamp(F.col("time_key").cast("string"), F.lit("yyyyMMddHHmm"))
    middle = (F.col("population_min").cast("bigint") + F.col("population_max")) / 2
    return (
        week.where("area_id is not null")
        .withColumns({"weekday": F.weekday(at) + 1, "hour": F.hour(at), "_middle": middle})
        .groupBy("area_id", "weekday", "hour")
        .agg(
            F.count("*").alias("observations"),
            F.min("population_min").alias("population_min"),
            F.max("population_max").alias("population_max"),
            # halves are exact, so the sum does not depend on the row order
            (F.sum("_middle") / F.count("_middle")).alias("population_avg"),
        )
    )


#: What the insight view takes of each fact, next to area and minute.
INSIGHT = {
    "commercial": [*_PAYMENT_NAMES, *_RATIO_NAMES],
    "population": ["congestion_id", "population_min", "population_max", "resident_ratio", "non_resident_ratio"],
}


def insight(
    fact_commercial: DataFrame, fact_population: DataFrame, conditions: Sequence[Column], order: Sequence[Column]
) -> DataFrame:
    """Spending and crowd traits of the same area and minute, filtered and sorted."""
    at = ["area_id", "time_key"]
    spends = fact_commercial.select(*at, *INSIGHT["commercial"])
    crowds = fact_population.select(*at, *INSIGHT["population"])
    joined = spends.join(crowds, at)
    for condition in conditions:
        joined = joined.where(condition)
    return joined.orderBy(*order)
