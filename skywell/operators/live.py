"""Live windows of the last N rows and what is computed on them."""

from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.functions.attach import attach
from skywell.functions.scalars import count_where, epoch_seconds
from skywell.operators.explore import correlation_matrix, temporal_patterns
from skywell.operators.ordered import HOUR
from skywell.operators.outliers import zscore_outliers
from skywell.schema import LIVE_WINDOWS, POLLUTANTS

def latest_rows(df: DataFrame, n: int, ts: str, tiebreak: str, keys=(), width: int = HOUR) -> DataFrame:
    """The newest `n` rows per key, numbered by `age` from 1.

    Without keys this is a top-n, merged from every task's own n rows. With keys, rows are first
    counted per key and time bucket; only the newest buckets that together hold `n` rows are
    read on, so a hot key never sends more than n rows and one bucket to a task.
    """
    keys, newest = list(keys), [F.col(ts).desc(), F.col(tiebreak).desc()]
    if keys:
        own = F.floor(epoch_seconds(ts) / F.lit(width))
        later = W.partitionBy(*keys).orderBy(F.col("_b").desc()).rowsBetween(W.unboundedPreceding, -1)
        first = (
            df.groupBy(*keys, own.alias("_b")).agg(F.count("*").alias("_n"))
            .withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
            .groupBy(*keys).agg(F.min(F.when(F.col("_later") < n, F.col("_b"))).alias("b"))
        )
        df = attach(df, first, keys, "_first").filter(own >= F.col("_first.b")).drop("_first")
    else:
        df = df.orderBy(*newest).limit(n)
    by_age = W.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("age", F.row_number().over(by_age)).filter(F.col("age") <= n)


def last_n_windows(df: DataFrame, ts: str, tiebreak: str, keys=(), sizes=LIVE_WINDOWS) -> DataFrame:
    """G1: one row per window a row belongs to, named in `window`."""
    rows = latest_rows(df, max(sizes.values()), ts, tiebreak, keys)
    member = F.array_compact(F.array(*[F.when(F.col("age") <= n, F.lit(w)) for w, n in sizes.items()]))
    return rows.withColumn("window", F.explode(member))


def window_stats(windows: DataFrame, cols=POLLUTANTS, keys=()) -> DataFrame:
    """Mean, sample deviation, extremes and count per window and channel."""
    keys = [*keys, "window"]
    wide = windows.groupBy(*keys).agg(
        *[
            F.struct(
                F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"), F.max(c).alias("max"), F.count(c).alias("count"),
            ).alias(c)
            for c in cols
        ]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"{c}.*")) for c in cols])
    return wide.select(*keys, F.inline(entries)).filter("count > 0")


def window_correlations(windows: DataFrame, cols=POLLUTANTS, keys=()) -> DataFrame:
    """G3."""
    return correlation_matrix(windows, cols, [*keys, "window"])


def zscore_anomalies(windows: DataFrame, ts: str, threshold: float = 3.0, cols=POLLUTANTS, keys=()) -> DataFrame:
    """Outliers of the shortest window by sample deviation."""
    shortest = windows.filter(F.col("window") == min(LIVE_WINDOWS, key=LIVE_WINDOWS.get))
    return zscore_outliers(shortest, cols, ts, threshold, ddof=1, keys=keys)


def live_patterns(windows: DataFrame, ts: str, cols=POLLUTANTS, keys=(), need: int = 24) -> DataFrame:
    """Hour and weekday means of the 168-row window, once it holds `need` rows."""
    daily = windows.filter(F.col("window") == "daily")
    held = daily.groupBy(*keys).agg(F.count("*").alias("held"))
    enough = attach(daily, held, keys, "_h").filter(F.col("_h.held") >= need).drop("_h")
    return temporal_patterns(enough, cols, ts, ("hour", "weekday"), keys)


def live_summary(df: DataFrame, windows: DataFrame, anomalies: DataFrame, ts: str) -> DataFrame:
    """Rows seen, latest time, fill of each window, current anomalies."""
    fill = windows.groupBy().agg(*[count_where(F.col("window") == w).alias(w) for w in LIVE_WINDOWS])
    return df.agg(F.count("*").alias("total_records"), F.max(ts).alias("last_update")).withColumns(
        {
            "_f": fill.select(F.struct("*")).scalar(),
            "recent_anomalies": anomalies.agg(F.count("*")).scalar(),
        }
    ).select("total_records", "last_update", "_f.*", "recent_anomalies")
