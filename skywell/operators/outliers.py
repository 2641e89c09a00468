"""Outlier detection (G4, H10-H12, H14, H16); all methods share one result schema."""

from pyspark.sql import DataFrame, functions as F

from skywell.functions.attach import attach, melt, null_safe_join
from skywell.operators.clean import long_series
from skywell.operators.explore import quartile_fences
from skywell.operators.forest import fit_forest

MIN_VALUES = 10  # fixed value: channels with fewer values are not judged


def zscore_outliers(df: DataFrame, cols, ts: str, threshold: float = 3.0, ddof: int = 0, keys=(), ids=()) -> DataFrame:
    """H10 (`ddof=0`), G4 (`ddof=1`): values more than `threshold` deviations from the mean."""
    keys = list(keys)
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.groupBy(*keys).agg(
        *[F.struct(F.count(c).alias("n"), F.avg(c).alias("m"), spread(c).alias("s")).alias(c) for c in cols]
    )

    def fields(c):
        s = F.col(f"_s.{c}")
        z = F.when((s["n"] >= MIN_VALUES) & (s["s"] > 0), F.abs(F.col(c) - s["m"]) / s["s"])
        return [F.col(c).cast("double").alias("value"), z.alias("score"), F.lit("z_score").alias("method")]

    rows = attach(df.select(*keys, *ids, ts, *cols), stats, keys, "_s")
    return melt(rows, cols, fields, [*keys, *ids, ts], F.col("score") > threshold)


def iqr_outliers(df: DataFrame, cols, ts: str, keys=(), ids=(), reach: float = 1.5) -> DataFrame:
    """Values outside the quartile fences; the score is (x - Q1) / IQR, 0 for IQR 0."""
    keys = list(keys)
    rows = attach(df.select(*keys, *ids, ts, *cols), quartile_fences(df, cols, keys, reach), keys, "_f")

    def fields(c):
        f, x = F.col(f"_f.{c}"), F.col(c)
        out = (f["n"] >= MIN_VALUES) & ((x < f["low"]) | (x > f["high"]))
        width = f["q3"] - f["q1"]
        score = F.when(out, F.when(width > 0, (x - f["q1"]) / width).otherwise(0.0))
        return [x.cast("double").alias("value"), score.alias("score"), F.lit("iqr").alias("method")]

    return melt(rows, cols, fields, [*keys, *ids, ts], F.col("score").isNotNull())


def forest_outliers(df: DataFrame, cols, ts: str, row_id: str, contamination: float = 0.1, ids=()) -> DataFrame:
    """The most isolated share of the complete rows, judged on all channels together."""
    model = fit_forest(df, cols, row_id)
    if model is None:
        return df.sparkSession.createDataFrame([], _schema(df, [*ids, ts]))
    scored = model.score(df).select(*ids, ts, "anomaly")
    return model.flag(scored, contamination).select(
        *ids, ts, F.lit(", ".join(cols)).alias("channel"), F.lit(None).cast("double").alias("value"),
        F.col("decision").alias("score"), F.lit("isolation_forest").alias("method"),
    )


def _schema(df, names):
    kept = ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)
    return f"{kept}, channel string, value double, score double, method string"


def detect_outliers(df: DataFrame, method: str, cols, ts: str, multivariate: bool = False, **options) -> DataFrame:
    """Pick a method; only the isolation forest judges channels together."""
    if multivariate != (method == "isolation_forest"):
        raise ValueError(f"{method} is {'multivariate' if method == 'isolation_forest' else 'per channel'} only")
    methods = {"z_score": zscore_outliers, "iqr": iqr_outliers, "isolation_forest": forest_outliers}
    return methods[method](df, cols, ts, **options)


def overlay_outliers(df: DataFrame, outliers: DataFrame, cols, ts: str, ids=()) -> DataFrame:
    """The long series with each outlier marked; `(ids, ts, channel)` must be unique."""
    marks = outliers.select(*ids, ts, "channel", F.col("score"), F.lit(True).alias("_hit"))
    series = long_series(df, cols, ts, ids).filter(F.col("value").isNotNull())
    return null_safe_join(series, marks, [*ids, ts, "channel"]).withColumn(
        "is_outlier", F.coalesce(F.col("_hit"), F.lit(False))
    ).drop("_hit")
