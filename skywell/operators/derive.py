"""Derived columns."""

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.functions.attach import attach
from skywell.functions.scalars import comfort_index, cyclic, season, weekday

# Pollutant weights of the air quality index.
INDEX_WEIGHTS = {"co_gt": 0.4, "nox_gt": 0.3, "no2_gt": 0.3}


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """D1, D2."""
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": weekday(ts),
            "month": F.month(ts),
            "season": season(F.month(ts)),
        }
    )


def air_quality_index(df: DataFrame, scope=(), weights=INDEX_WEIGHTS, bounded: bool = False) -> DataFrame:
    """D3: weighted share of each pollutant's maximum within the scope.

    For `bounded` scopes (micro-batches) the maximum is a window, which needs no join.
    """

    def index(top):
        terms = [F.when(top(c) > 0, F.col(c) / top(c)).otherwise(F.lit(0.0)) * w for c, w in weights.items()]
        return reduce(lambda a, b: a + b, terms) * 100

    if bounded:
        own = W.partitionBy(*scope)
        tops = df.withColumns({f"_top_{c}": F.max(c).over(own) for c in weights})
        return tops.withColumn("air_quality_index", index(lambda c: F.col(f"_top_{c}"))).drop(*[f"_top_{c}" for c in weights])
    tops = df.groupBy(*scope).agg(*[F.max(c).alias(c) for c in weights])
    rows = attach(df, tops, scope, "_top")
    return rows.withColumn("air_quality_index", index(lambda c: F.col(f"_top.{c}"))).drop("_top")


def with_comfort_index(df: DataFrame) -> DataFrame:
    """D4."""
    return df.withColumn("comfort_index", comfort_index("temperature", "relative_humidity"))


def cyclic_encode(df: DataFrame, ts: str) -> DataFrame:
    """D5."""
    sin_hour, cos_hour = cyclic(F.hour(ts), 24)
    return df.withColumns({"sin_hour": sin_hour, "cos_hour": cos_hour})


def add_derived(df: DataFrame, ts: str, scope=(), bounded: bool = False) -> DataFrame:
    """D1-D4 in the column order of the clean table."""
    return with_comfort_index(air_quality_index(calendar_features(df, ts), scope, bounded=bounded))
