"""Queries on the dense hourly series: grid, features, splits, models, forecasts."""

import uuid

from pyspark.sql import DataFrame, functions as F

from skywell.operators import boosting, evaluate, features, grid, models, predict, seasonal
from skywell.plans import ctes
from skywell.plans.explore_queries import MEASURES, lineitem
from skywell.plans.fixtures import hourly
from skywell.plans.registry import final, query, rounded
from skywell.schema import HORIZON, LAGS
from skywell.session import checkpoint_dir, settle

SERIES = ["nox_gt", "co_gt", "no2_gt"]
STATION = ["station"]
NAMES = features.feature_names()
WIDTHS = (5 * 86_400, 3)  # small buckets, so that even this month of data crosses their edges


def by_station(spark, sf_dir) -> DataFrame:
    return hourly(spark, sf_dir, station=True).select("station", "ts", *SERIES)


def dense(spark, sf_dir) -> DataFrame:
    """The gap-free series of every station, written once."""
    rows = by_station(spark, sf_dir).withColumn("tie", F.lit(0))
    return settle(grid.load_series(rows, SERIES, STATION, "ts", "tie"))


_UP = "(PARTITION BY station ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_DOWN = "(PARTITION BY station ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
_ENDS = ", ".join(
    f"{c}, last_value({c} IGNORE NULLS) OVER {_UP} AS p_{c}, "
    f"last_value(CASE WHEN {c} IS NOT NULL THEN t END IGNORE NULLS) OVER {_UP} AS i_{c}, "
    f"first_value({c} IGNORE NULLS) OVER {_DOWN} AS n_{c}, "
    f"first_value(CASE WHEN {c} IS NOT NULL THEN t END IGNORE NULLS) OVER {_DOWN} AS j_{c}"
    for c in SERIES
)
_LINES = ", ".join(
    f"coalesce({c}, CASE WHEN t - i_{c} <= 3 THEN CASE WHEN j_{c} IS NULL THEN p_{c} "
    f"ELSE p_{c} + (n_{c} - p_{c}) * ((t - i_{c}) / (j_{c} - i_{c})) END END) AS {c}"
    for c in SERIES
)
GRID = f"""{ctes.STATION_HOURLY},
    bounds AS (SELECT station, min(ts) AS t0, max(ts) AS t1 FROM hourly GROUP BY station),
    steps AS (SELECT station, unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS ts FROM bounds),
    grid AS (SELECT s.station, s.ts, epoch(s.ts)::BIGINT // 3600 AS t, {', '.join(f'h.{c}' for c in SERIES)}
        FROM steps s LEFT JOIN hourly h ON s.station = h.station AND s.ts = h.ts)"""
LINED = f"{GRID}, ended AS (SELECT station, ts, t, {_ENDS} FROM grid), lined AS (SELECT station, ts, {_LINES} FROM ended)"
_SEASON = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in SERIES)
_MEDIAN = ", ".join(f"quantile_cont({c}, 0.5) AS d_{c}" for c in SERIES)
_FILLED = ", ".join(
    f"coalesce(l.{c}, least(greatest(m_{c}, m_{c} - 1.5 * s_{c}), m_{c} + 1.5 * s_{c}), d_{c}) AS {c}" for c in SERIES
)
DENSE = f"""{LINED},
    seasons AS (SELECT station, hour(ts) AS h, {_SEASON} FROM lined GROUP BY 1, 2),
    medians AS (SELECT station, {_MEDIAN} FROM lined GROUP BY 1),
    dense AS (SELECT l.station, l.ts, {_FILLED} FROM lined l
        LEFT JOIN seasons s ON l.station = s.station AND hour(l.ts) = s.h LEFT JOIN medians m ON l.station = m.station)"""


@query(final(GRID, "grid", ["station", "ts"], SERIES))
def regular_grid(spark, sf_dir):
    """C4."""
    return rounded(grid.regular_grid(by_station(spark, sf_dir), SERIES, STATION, "ts", widths=WIDTHS))


@query(final(LINED, "lined", ["station", "ts"], SERIES))
def interpolate_time_limit3(spark, sf_dir):
    """C5 on the grid of C4, as two steps."""
    steps = grid.regular_grid(by_station(spark, sf_dir), SERIES, STATION, "ts", widths=WIDTHS)
    return rounded(grid.interpolate(steps, SERIES, STATION, "ts", by="time", limit=3, widths=WIDTHS))


@query(final(LINED, "lined", ["station", "ts"], SERIES))
def grid_interpolated(spark, sf_dir):
    """C4 and C5 in one pass."""
    return rounded(grid.regular_grid(by_station(spark, sf_dir), SERIES, STATION, "ts", widths=WIDTHS, fill=3))


@query(final(DENSE, "dense", ["station", "ts"], SERIES))
def seasonal_fill(spark, sf_dir):
    """C6, C7 after the grid: the whole of A13."""
    return rounded(dense(spark, sf_dir))


_BY = "(PARTITION BY station ORDER BY ts)"
_TRAIL = "(PARTITION BY station ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
_FEATURES = ", ".join(
    [f"lag(nox_gt, {k}) OVER {_BY} AS nox_lag{k}" for k in LAGS]
    + [
        f"CASE WHEN count(nox_gt) OVER {_TRAIL} >= 6 THEN avg(nox_gt) OVER {_TRAIL} END AS nox_mean_24h",
        f"lag(co_gt, 1) OVER {_BY} AS co_lag1", f"lag(no2_gt, 1) OVER {_BY} AS no2_lag1",
        "sin(hour(ts) * (2.0::DOUBLE * pi()) / 24) AS sin_hour", "cos(hour(ts) * (2.0::DOUBLE * pi()) / 24) AS cos_hour",
        f"lead(nox_gt, {HORIZON}) OVER {_BY} AS y", "nox_gt AS current",
        "row_number() OVER (PARTITION BY station ORDER BY ts) - 1 AS i", "count(*) OVER (PARTITION BY station) AS n",
    ]
)
_SPLIT = (
    "CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' "
    "WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split"
)
FEATURES = f"""{DENSE}, wide AS (SELECT station, ts, {_FEATURES} FROM dense),
    features AS (SELECT *, {_SPLIT} FROM wide WHERE y IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in NAMES)})"""


def feature_table(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Features with their split, and the dense series they came from."""
    series = dense(spark, sf_dir)
    rows = features.build_features(series, "ts", STATION, width=5 * 86_400)
    return features.chronological_split(rows, "ts", STATION, features.series_bounds(series, "ts", STATION)), series


@query(final(FEATURES, "features", ["station", "ts", "split"], ["current", *NAMES, "y"], digits=9))
def build_features(spark, sf_dir):
    """I1-I6."""
    return rounded(feature_table(spark, sf_dir)[0], 9)


@query(
    f"WITH {DENSE}, w AS (SELECT station, ts, row_number() OVER {_BY} - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM dense) "
    f"SELECT station, ts, {_SPLIT} FROM w"
)
def chronological_split(spark, sf_dir):
    """I5 of the dense rows."""
    return features.chronological_split(dense(spark, sf_dir), "ts", STATION).select("station", "ts", "split")


@query(f"WITH {FEATURES} SELECT station, split, count(*) AS rows, min(ts) AS start, max(ts) AS \"end\" FROM features GROUP BY 1, 2")
def split_summary(spark, sf_dir):
    """I17."""
    return features.split_summary(feature_table(spark, sf_dir)[0], "ts", STATION)


BASELINES = f"""{FEATURES},
    parts AS (SELECT *, {_SPLIT} FROM (SELECT station, ts, nox_gt, row_number() OVER {_BY} - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM dense)),
    constant AS (SELECT station, split, max(CASE WHEN ts = last_ts - INTERVAL {HORIZON} HOURS THEN nox_gt END) AS baseline
        FROM (SELECT *, max(ts) OVER (PARTITION BY station, split) AS last_ts FROM parts) GROUP BY 1, 2)"""


def constants(series: DataFrame) -> DataFrame:
    parts = features.chronological_split(series, "ts", STATION)
    return evaluate.constant_baseline(parts, "ts", "nox_gt", ["station", "split"])


@query(final(BASELINES, "constant", ["station", "split"], ["baseline"]))
def baseline_constant(spark, sf_dir):
    """I14."""
    return rounded(constants(dense(spark, sf_dir)))


def judged(spark, sf_dir) -> DataFrame:
    """Feature rows with persistence (`current`) and the constant baseline of their split."""
    rows, series = feature_table(spark, sf_dir)
    return rows.join(constants(series), ["station", "split"])


JUDGED = f"{BASELINES}, judged AS (SELECT f.*, c.baseline FROM features f JOIN constant c ON f.station = c.station AND f.split = c.split)"


def errors_sql(pred: str) -> str:
    return (
        f"count(*) AS n, avg(abs(y - {pred})) AS mae, sqrt(avg((y - {pred}) * (y - {pred}))) AS rmse, "
        f"200 * avg(abs(y - {pred}) / (CASE WHEN abs(y) + abs({pred}) = 0 THEN 1e-12 ELSE abs(y) + abs({pred}) END)) AS smape, "
        f"1 - sum((y - {pred}) * (y - {pred})) / (var_pop(y) * count(y)) AS r2"
    )


@query(
    final(
        f"{JUDGED}, e AS (SELECT station, split, {errors_sql('current')} FROM judged GROUP BY 1, 2)",
        "e", ["station", "split", "n"], ["mae", "rmse", "smape", "r2"], digits=8,
    )
)
def forecast_metrics(spark, sf_dir):
    """I15 of persistence."""
    rows, _ = feature_table(spark, sf_dir)
    return rounded(evaluate.forecast_metrics(rows, "y", "current", ["station", "split"]), 8)


@query(
    final(
        f"{JUDGED}, d AS (SELECT station, split, abs(y - baseline) - abs(y - current) AS d FROM judged), "
        "t AS (SELECT station, split, count(d) AS n_samples, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS t_statistic FROM d GROUP BY 1, 2)",
        "t", ["station", "split", "n_samples"], ["t_statistic"], digits=8,
    )
)
def paired_tstat(spark, sf_dir):
    """The statistic of I16: persistence against the constant."""
    return rounded(evaluate.paired_difference(judged(spark, sf_dir), "y", "current", "baseline", ["station", "split"]), 8)


@query()
def paired_ttest(spark, sf_dir):
    """I16 with its p-value."""
    return rounded(evaluate.paired_ttest(judged(spark, sf_dir), "y", "current", "baseline", ["station", "split"]), 8)


def one_lag(spark, sf_dir) -> DataFrame:
    """Validation and test rows with the forecast of a line through the last value, and the constant baseline."""
    rows = judged(spark, sf_dir)
    fitted = models.fit_linear(rows, ["nox_lag1"], "y", STATION, [("linear", None)])
    return models.predict_linear(rows, fitted, ["nox_lag1"], STATION).filter("split <> 'train'")


@query(
    final(
        f"{JUDGED}, line AS (SELECT station, regr_slope(y, nox_lag1) AS b, regr_intercept(y, nox_lag1) AS a FROM features "
        "WHERE split <> 'test' GROUP BY 1), p AS (SELECT j.*, a + b * nox_lag1 AS prediction FROM judged j JOIN line l ON j.station = l.station "
        f"WHERE split <> 'train'), e AS (SELECT station, split, {errors_sql('prediction')}, avg(abs(y - baseline)) AS mae_baseline, "
        "sqrt(avg((y - baseline) * (y - baseline))) AS rmse_baseline, "
        "avg(abs(y - baseline) - abs(y - prediction)) / (stddev_samp(abs(y - baseline) - abs(y - prediction)) / sqrt(count(*))) AS t_statistic "
        "FROM p GROUP BY 1, 2)",
        "e", ["station", "split", "n"],
        ["mae", "rmse", "smape", "r2", "mae_baseline", "rmse_baseline", "t_statistic", "mae_baseline - mae AS mae_gain", "rmse_baseline - rmse AS rmse_gain"],
        digits=6,
    )
)
def model_metrics(spark, sf_dir):
    """I15, I16, I23 of a fitted model on validation and test: errors, baseline errors, significance and gain."""
    document = evaluate.model_metrics(one_lag(spark, sf_dir), "y", "prediction", "baseline", ["station", "split"])
    return rounded(document.drop("p_value", "significant"), 6)


@query()
def model_metrics_selected(spark, sf_dir):
    """The same document, p-values included, of each station's selected model on all features."""
    rows = judged(spark, sf_dir)
    fitted = settle(models.fit_linear(rows, NAMES, "y", STATION))
    predicted = models.predict_linear(rows, fitted, NAMES, STATION).filter("split <> 'train'")
    return rounded(evaluate.model_metrics(predicted, "y", "prediction", "baseline", ["station", "split"]), 6)


def gains(spark, sf_dir) -> DataFrame:
    rows = judged(spark, sf_dir)
    base = evaluate.forecast_metrics(rows, "y", "baseline", ["station", "split"]).select(
        "station", "split", F.col("mae").alias("mae_baseline"), F.col("rmse").alias("rmse_baseline")
    )
    return evaluate.forecast_metrics(rows, "y", "current", ["station", "split"]).join(base, ["station", "split"])


@query(
    final(
        f"{JUDGED}, p AS (SELECT station, split, {errors_sql('current')} FROM judged GROUP BY 1, 2), "
        f"b AS (SELECT station, split, {errors_sql('baseline')} FROM judged GROUP BY 1, 2), "
        "g AS (SELECT p.station, p.split, b.mae - p.mae AS mae_gain, b.rmse - p.rmse AS rmse_gain FROM p JOIN b "
        "ON p.station = b.station AND p.split = b.split)",
        "g", ["station", "split"], ["mae_gain", "rmse_gain"], digits=8,
    )
)
def improvement(spark, sf_dir):
    """I23."""
    return rounded(evaluate.improvement(gains(spark, sf_dir)).select("station", "split", "mae_gain", "rmse_gain"), 8)


@query(
    f"WITH {JUDGED}, r AS (SELECT 'persistence-' || station AS run_id, 'persistence' AS algorithm, sqrt(avg((y - current) ** 2)) AS test_rmse "
    "FROM judged WHERE split = 'test' GROUP BY station UNION ALL SELECT 'constant-' || station, 'constant', sqrt(avg((y - baseline) ** 2)) "
    "FROM judged WHERE split = 'test' GROUP BY station) SELECT run_id, algorithm, round(test_rmse, 8) AS test_rmse FROM r "
    "WHERE test_rmse > 0 ORDER BY test_rmse, run_id LIMIT 1"
)
def best_run(spark, sf_dir):
    """I18 over the baseline runs of every station."""
    tested = gains(spark, sf_dir).filter("split = 'test'")

    def run(name, rmse):
        label = F.concat(F.lit(f"{name}-"), F.col("station").cast("string"))
        return tested.select(*evaluate.run_record(label, F.lit(name), {"test_rmse": F.col(rmse)}))

    best = evaluate.best_run(run("persistence", "rmse").unionByName(run("constant", "rmse_baseline")))
    return rounded(
        best.select("run_id", F.col("params")["algorithm"].alias("algorithm"), F.col("metrics")["test_rmse"].alias("test_rmse")), 8
    )


@query(
    final(
        f"{DENSE}, e AS (SELECT station, max(ts) AS t1 FROM dense GROUP BY 1), "
        "a AS (SELECT d.station, d.ts + INTERVAL 6 HOURS AS ts, nox_gt AS persistence FROM dense d JOIN e ON d.station = e.station AND d.ts > t1 - INTERVAL 6 HOURS), "
        "b AS (SELECT d.station, d.ts + INTERVAL 24 HOURS AS ts, nox_gt AS daily FROM dense d JOIN e ON d.station = e.station "
        "AND d.ts > t1 - INTERVAL 24 HOURS AND d.ts <= t1 - INTERVAL 15 HOURS), "
        "m AS (SELECT coalesce(a.station, b.station) AS station, coalesce(a.ts, b.ts) AS ts, persistence, daily FROM a FULL JOIN b ON a.station = b.station AND a.ts = b.ts)",
        "m", ["station", "ts"], ["persistence", "daily"],
    )
)
def merge_forecasts(spark, sf_dir):
    """Six hours of persistence with nine of the day before."""
    series = dense(spark, sf_dir)
    ends = features.series_bounds(series, "ts", STATION).drop("t0")
    rows = series.join(ends, STATION)

    def shifted(since, until, ahead, name):
        span = (F.col("ts") > F.col("t1") - F.expr(f"INTERVAL {since} HOURS")) & (F.col("ts") <= F.col("t1") - F.expr(f"INTERVAL {until} HOURS"))
        return rows.filter(span).select("station", (F.col("ts") + F.expr(f"INTERVAL {ahead} HOURS")).alias("ts"), F.col("nox_gt").alias(name))

    return rounded(evaluate.merge_forecasts([shifted(6, 0, 6, "persistence"), shifted(24, 15, 24, "daily")], "ts", STATION))


def one_feature(spark, sf_dir, algorithm, alpha=None) -> DataFrame:
    rows = lineitem(spark, sf_dir).select(
        "l_returnflag", "l_quantity", F.col("l_extendedprice").alias("y"), F.lit("train").alias("split")
    )
    fitted = models.fit_linear(rows, ["l_quantity"], "y", ["l_returnflag"], [(algorithm, alpha)])
    return rounded(fitted.select("l_returnflag", "algorithm", "intercept", F.col("coef")[0].alias("slope")), 5)


def slope_sql(algorithm: str, slope: str) -> str:
    return (
        "WITH s AS (SELECT l_returnflag, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS vx, "
        "covar_pop(l_extendedprice, l_quantity) AS cxy, count(*) AS n FROM lineitem GROUP BY 1), "
        f"f AS (SELECT *, {slope} AS slope FROM s) SELECT l_returnflag, '{algorithm}' AS algorithm, "
        "round(my - slope * mx, 5) AS intercept, round(slope, 5) AS slope FROM f"
    )


@query(slope_sql("linear", "cxy / vx"))
def fit_linear_volume(spark, sf_dir):
    """Least squares per group over every line item."""
    return one_feature(spark, sf_dir, "linear")


@query(slope_sql("linear", "cxy / vx"))
def fit_linear_saved(spark, sf_dir):
    """The same models, saved and loaded."""
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4()}"
    models.save_table(one_feature(spark, sf_dir, "linear"), path)
    return models.load_table(spark, path)


@query(slope_sql("ridge", "cxy / (vx * (1 + 1000.0::DOUBLE / n))"))
def fit_ridge_volume(spark, sf_dir):
    """I8."""
    return one_feature(spark, sf_dir, "ridge", 1000.0)


@query(slope_sql("lasso", "sign(cxy) * greatest(abs(cxy / sqrt(vx)) - 100, 0) / sqrt(vx)"))
def fit_lasso_volume(spark, sf_dir):
    """I9."""
    return one_feature(spark, sf_dir, "lasso", 100.0)


@query()
def select_model(spark, sf_dir):
    """Nine candidates per station from one pass, refitted on train + val."""
    fitted = models.fit_linear(feature_table(spark, sf_dir)[0], NAMES, "y", STATION)
    return rounded(fitted.select("station", "algorithm", "alpha", "val_rmse", "test_rmse", "test_r2", "intercept"), 6)


@query()
def select_linear_volume(spark, sf_dir):
    """I7-I11 over every line item: price from the other measures, split by ship date."""
    rows = lineitem(spark, sf_dir).withColumn(
        "split",
        F.when(F.col("l_shipdate") < "2000-01-01", "train").when(F.col("l_shipdate") < "2001-01-01", "val").otherwise("test"),
    )
    inputs = [c for c in MEASURES if c != "l_extendedprice"]
    fitted = models.fit_linear(rows, inputs, "l_extendedprice")
    return rounded(fitted.select("algorithm", "alpha", "val_rmse", "test_rmse", "test_r2", "intercept"), 4)


@query()
def fit_boosted(spark, sf_dir):
    """Boosted trees on all stations, scored on the test part."""
    rows = settle(feature_table(spark, sf_dir)[0])
    best = boosting.select_boosted(rows, NAMES, "y")
    tested = best.predict(rows.filter("split = 'test'"))
    return rounded(evaluate.forecast_metrics(tested, "y", "prediction", STATION), 6)


def linear_serving(spark, sf_dir):
    rows, series = feature_table(spark, sf_dir)
    fitted = settle(models.fit_linear(rows, NAMES, "y", STATION))
    return series, lambda df: models.predict_linear(df, fitted, NAMES, STATION)


@query()
def forecast_direct(spark, sf_dir):
    """I19."""
    series, serve = linear_serving(spark, sf_dir)
    return rounded(predict.forecast_direct(series, serve, "ts", STATION), 6)


@query()
def forecast_latest(spark, sf_dir):
    """I20."""
    series, serve = linear_serving(spark, sf_dir)
    return rounded(predict.forecast_latest(series, serve, "ts", STATION), 6)


@query()
def fit_seasonal_ar(spark, sf_dir):
    """The chosen order of every station."""
    fitted, _ = seasonal.fit_seasonal_ar(dense(spark, sf_dir), "ts", "nox_gt", STATION)
    return rounded(fitted.select("station", "candidate", "orders", "sigma", "val_rmse"), 6)


@query()
def forecast_interval(spark, sf_dir):
    """Six hours with their 95 % band."""
    fitted, ends = seasonal.fit_seasonal_ar(dense(spark, sf_dir), "ts", "nox_gt", STATION)
    return rounded(seasonal.forecast(fitted.withColumn("steps", F.lit(HORIZON)), ends, STATION, "ts"), 6)
