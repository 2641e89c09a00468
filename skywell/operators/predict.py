"""Serving forecasts from fitted models."""

from pyspark.sql import DataFrame, functions as F

from skywell.functions.attach import attach
from skywell.operators.features import build_features, series_bounds
from skywell.operators.ordered import HOUR
from skywell.schema import HORIZON, LAGS, TRAILING_ROWS


def serving_rows(dense: DataFrame, ts: str, keys=(), horizon: int = HORIZON, **features) -> DataFrame:
    """The features of the `horizon` anchors that end at each series' last time.

    The anchor `horizon - k` steps back predicts step k. A series lacking a complete anchor is
    refused as a whole. Only rows near the end of a series are read.
    """
    keys = list(keys)
    ends = series_bounds(dense, ts, keys).drop("t0")
    step = features.get("step", HOUR)
    seconds = (max(*features.get("lags", LAGS), TRAILING_ROWS) + horizon) * step
    near = F.col(ts) >= F.timestamp_add("SECOND", F.lit(-seconds), F.col("_e.t1"))
    reach = attach(dense, ends, keys, "_e").filter(near).drop("_e")
    rows = build_features(reach, ts, keys, horizon=horizon, complete=False, **features).drop("y", "current")
    names = [c for c in rows.columns if c not in [*keys, ts]]
    anchors = attach(rows, ends, keys, "_e").withColumn(
        "step", horizon - F.floor(F.timestamp_diff("SECOND", F.col(ts), F.col("_e.t1")) / step)
    ).filter(F.col("step").between(1, horizon)).drop("_e")
    whole = anchors.dropna(subset=names).groupBy(*keys).agg(F.count("*").alias("n"))
    return (
        attach(anchors, whole, keys, "_w").filter(F.col("_w.n") == horizon).drop("_w")
        .withColumn("anchor", F.col(ts))
        .withColumn(ts, F.timestamp_add("SECOND", F.lit(horizon * step), F.col(ts)))
    )


def forecast_direct(dense: DataFrame, predict, ts: str, keys=(), into: str = "prediction", **options) -> DataFrame:
    """The next steps of every series, each predicted from its own anchor.

    `predict` adds the column `into` to a feature table.
    """
    return predict(serving_rows(dense, ts, keys, **options)).select(*keys, ts, "step", into)


def forecast_latest(dense: DataFrame, predict, ts: str, keys=(), into: str = "prediction", horizon: int = HORIZON, **options) -> DataFrame:
    """From the latest complete row, only the last step is predicted; the others are NULL."""
    keys = list(keys)
    rows = build_features(dense, ts, keys, horizon=horizon, complete=False, **options).drop("y", "current")
    names = [c for c in rows.columns if c not in [*keys, ts]]
    complete = rows.dropna(subset=names)
    last = complete.groupBy(*keys).agg(F.max_by(F.struct(ts, *names), F.col(ts)).alias("r")).select(*keys, "r.*")
    done = predict(last.filter(F.col(ts).isNotNull())).select(*keys, ts, F.col(into).alias("_y"))
    return done.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *keys,
        F.timestamp_add("SECOND", F.col("step") * F.lit(options.get("step", HOUR)), F.col(ts)).alias(ts),
        F.col("step").cast("bigint").alias("step"),
        F.when(F.col("step") == horizon, F.col("_y")).alias(into),
    )
