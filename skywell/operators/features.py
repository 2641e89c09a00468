"""Lagged features and chronological splits on a dense hourly series."""

from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.functions.attach import attach
from skywell.functions.scalars import epoch_seconds
from skywell.operators.derive import cyclic_encode
from skywell.operators.ordered import DAY, HOUR, halo
from skywell.schema import HORIZON, LAGS, TRAILING_MIN, TRAILING_ROWS, TRAIN_SHARE, VAL_SHARE


def short(channel: str) -> str:
    return channel.removesuffix("_gt")


def feature_names(target="nox_gt", exogenous=("co_gt", "no2_gt"), lags=tuple(LAGS), temporal=True) -> list[str]:
    t = short(target)
    names = [f"{t}_lag{k}" for k in lags] + [f"{t}_mean_24h"] + [f"{short(c)}_lag1" for c in exogenous]
    return names + (["sin_hour", "cos_hour"] if temporal else [])


def build_features(
    df: DataFrame, ts: str, keys=(), target: str = "nox_gt", exogenous=("co_gt", "no2_gt"),
    horizon: int = HORIZON, lags=tuple(LAGS), step: int = HOUR, width: int = 30 * DAY, complete: bool = True,
) -> DataFrame:
    """Lags, trailing mean, cyclic hour and the value `horizon` steps ahead as `y`.

    `df` must be a dense grid, where k rows are k steps. Exogenous channels that are absent
    are left out. `complete` keeps only rows with every feature and the target (B11).
    """
    keys = list(keys)
    exogenous = [c for c in exogenous if c in df.columns]
    cut = halo(df.select(*keys, ts, *dict.fromkeys([target, *exogenous])), ts, max(*lags, TRAILING_ROWS) * step, horizon * step, width)
    w = W.partitionBy(*keys, "_bucket").orderBy(ts)
    trailing = w.rowsBetween(-TRAILING_ROWS, -1)
    t = short(target)
    cut = cut.withColumns(
        {
            **{f"{t}_lag{k}": F.lag(target, k).over(w) for k in lags},
            f"{t}_mean_24h": F.when(F.count(target).over(trailing) >= TRAILING_MIN, F.avg(target).over(trailing)),
            **{f"{short(c)}_lag1": F.lag(c, 1).over(w) for c in exogenous},
            "y": F.lead(target, horizon).over(w),
        }
    ).filter("_core")
    names = feature_names(target, exogenous, lags)
    rows = cyclic_encode(cut, ts).select(*keys, ts, F.col(target).alias("current"), *names, "y")
    return rows.dropna(subset=[*names, "y"]) if complete else rows


def series_bounds(df: DataFrame, ts: str, keys=()) -> DataFrame:
    """First and last time of each series; on a dense grid they fix every cut point."""
    return df.groupBy(*keys).agg(F.min(ts).alias("t0"), F.max(ts).alias("t1"))


def chronological_split(
    df: DataFrame, ts: str, keys=(), bounds: DataFrame | None = None, step: int = HOUR,
    train: float = TRAIN_SHARE, val: float = VAL_SHARE, purge: int = 0,
) -> DataFrame:
    """`split` by position on the dense grid, computed from the bounds without ranking.

    `purge` drops the last rows of train and validation, whose targets lie in the next part.
    """
    keys = list(keys)
    b = bounds if bounds is not None else series_bounds(df, ts, keys)
    rows = attach(df, b, keys, "_b").withColumn("_t0", epoch_seconds("_b.t0"))
    n = (epoch_seconds("_b.t1") - F.col("_t0")) / step + 1
    place = (epoch_seconds(ts) - F.col("_t0")) / step
    first_val = F.floor(n * train)
    first_test = first_val + F.floor(n * val)
    rows = rows.withColumns({"_i": place, "_v": first_val, "_e": first_test})
    split = F.when(F.col("_i") < F.col("_v"), "train").when(F.col("_i") < F.col("_e"), "val").otherwise("test")
    edge = F.when(F.col("_i") < F.col("_v"), F.col("_v")).when(F.col("_i") < F.col("_e"), F.col("_e"))
    clear = edge.isNull() | (F.col("_i") < edge - purge)
    return rows.withColumn("split", split).filter(clear).drop("_b", "_t0", "_i", "_v", "_e")


def time_slice(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows between two times, both included."""
    return df.filter(F.col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def split_summary(df: DataFrame, ts: str, keys=()) -> DataFrame:
    """Rows and time span of each part."""
    return df.groupBy(*keys, "split").agg(F.count("*").alias("rows"), F.min(ts).alias("start"), F.max(ts).alias("end"))
