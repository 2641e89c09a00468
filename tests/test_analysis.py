"""Quantiles, statistics, outliers, features, models and forecasts against numpy and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skywell.functions.quantiles import exact_quantiles
from skywell.functions.tdist import two_sided_p
from skywell.operators import boosting, evaluate, explore, features, live, models, outliers, predict, seasonal

START = dt.datetime(2024, 1, 1)


def hours(spark, values, key=None, name="nox_gt"):
    rows = [(START + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"ts timestamp_ntz, {name} double")
    return df if key is None else df.withColumn("k", F.lit(key))


@pytest.mark.parametrize("accuracy", [5, 50, 20_000])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy):
    """One group holds most rows and one value a third of them; brackets are wide and narrow."""
    rng = np.random.default_rng(0)
    hot = np.where(rng.random(3000) < 0.34, 7.0, rng.normal(size=3000))
    groups = {"hot": hot, "few": rng.random(4), "one": np.array([3.0]), "two": np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("few", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.k: r for r in exact_quantiles(df, ["x"], probs, ["k"], accuracy).collect()}
    for k, vs in groups.items():
        assert got[k].n == len(vs)
        np.testing.assert_allclose(got[k].q, np.quantile(vs, probs), rtol=1e-12)
    whole = exact_quantiles(df, ["x"], probs, (), accuracy).first()
    np.testing.assert_allclose(whole.q, np.quantile(np.concatenate(list(groups.values())), probs), rtol=1e-12)


# Published t statistics, sample sizes and p-values.
@pytest.mark.parametrize("t, n, p", [(16.072038957020684, 1403, 1.7721852309607882e-53), (42.21932446370631, 1399, 8.366858145951911e-252)])
def test_t_pvalues_far_in_the_tail(t, n, p):
    assert two_sided_p(t, n - 1) == pytest.approx(p, rel=1e-9)


def test_t_pvalue_edges():
    assert two_sided_p(0.0, 5) == 1.0
    assert two_sided_p(1.0, 1) == pytest.approx(0.5)
    assert two_sided_p(float("inf"), 5) == 0.0
    assert two_sided_p(float("nan"), 5) is None and two_sided_p(1.0, 0) is None


def test_description_equals_pandas(spark):
    values = pd.Series(np.random.default_rng(1).gamma(2.0, size=200))
    r = explore.describe_columns(hours(spark, values), ["nox_gt"]).first()
    assert r.skewness == pytest.approx(values.skew())
    assert r.kurtosis == pytest.approx(values.kurtosis())
    flat = explore.describe_columns(hours(spark, [2.0] * 5), ["nox_gt"]).first()
    assert (flat.skewness, flat.kurtosis, flat["std"], flat.iqr) == (0.0, 0.0, 0.0, 0.0)


def test_fdr_is_monotone_and_clipped(spark):
    p = [0.01, 0.04, 0.03, 0.9, 0.8, 1.0]
    got = [r.q for r in explore.fdr_bh(spark.createDataFrame([(x,) for x in p], "p double")).orderBy("p").collect()]
    assert got == pytest.approx([0.06, 0.08, 0.08, 1.0, 1.0, 1.0])


def test_short_windows_cannot_flag(spark):
    """With n values a sample z-score cannot exceed (n - 1) / sqrt(n)."""
    df = hours(spark, [1.0] * 9 + [1000.0])
    assert outliers.zscore_outliers(df, ["nox_gt"], "ts", 3.0, ddof=1).count() == 0
    assert outliers.zscore_outliers(hours(spark, [1.0] * 8 + [1000.0]), ["nox_gt"], "ts", 1.0).count() == 0  # under ten
    assert outliers.zscore_outliers(hours(spark, [5.0] * 20), ["nox_gt"], "ts", 0.1).count() == 0  # no spread


def test_method_dispatch_refuses(spark):
    df = hours(spark, range(20))
    with pytest.raises(ValueError):
        outliers.detect_outliers(df, "iqr", ["nox_gt"], "ts", multivariate=True)


def test_forest_finds_planted_rows(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(2000, 3))
    points[:10] += 12
    rows = [(i, START, *map(float, p)) for i, p in enumerate(points)] + [(9999, START, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, a double, b double, c double").repartition(5)
    found = outliers.forest_outliers(df, ["a", "b", "c"], "ts", "id", 0.05, ids=["id"]).collect()
    assert len(found) == 100
    assert {r.id for r in sorted(found, key=lambda r: r.score)[:10]} == set(range(10))
    again = outliers.forest_outliers(df.repartition(3), ["a", "b", "c"], "ts", "id", 0.05, ids=["id"])
    assert {r.id for r in again.collect()} == {r.id for r in found}
    assert outliers.forest_outliers(df.limit(5), ["a", "b"], "ts", "id").count() == 0


def test_latest_rows_per_key_with_a_hot_key(spark):
    rows = [(("hot" if i % 3 else f"k{i % 7}"), START + dt.timedelta(minutes=i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n long").repartition(7)
    got = live.latest_rows(df, 50, "ts", "n", ["k"]).toPandas()
    want = pd.DataFrame(rows, columns=["k", "ts", "n"]).sort_values("ts", ascending=False).groupby("k").head(50)
    assert set(zip(got.k, got.n)) == set(zip(want.k, want.n))
    assert live.latest_rows(df, 10, "ts", "n").agg(F.min("n")).first()[0] == 2990


def test_split_sizes(spark):
    """The published part sizes of 9357 hourly rows."""
    df = spark.range(9357).select(F.timestamp_add("HOUR", F.col("id"), F.lit(START).cast("timestamp_ntz")).alias("ts"))
    got = {r.split: r.n for r in features.chronological_split(df, "ts").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 6549, "val": 1403, "test": 1405}
    purged = features.chronological_split(df, "ts", purge=6).groupBy("split").count()
    assert {r.split: r["count"] for r in purged.collect()} == {"train": 6543, "val": 1397, "test": 1405}
    assert features.time_slice(df, "ts", "2024-01-01 01:00:00", "2024-01-01 03:00:00").count() == 3


@pytest.mark.parametrize("width_days", [3, 7, 1000])
def test_features_equal_pandas(spark, width_days):
    rng = np.random.default_rng(4)
    n = 500
    s = pd.Series(rng.random(n), index=pd.date_range(START, periods=n, freq="h"))
    df = hours(spark, s).withColumn("co_gt", F.col("nox_gt") * 2)
    got = features.build_features(df, "ts", width=width_days * 86_400).toPandas().sort_values("ts")
    assert len(got) == n - 48 - 6
    at = slice(48, n - 6)
    for lag in (1, 18, 48):
        np.testing.assert_allclose(got[f"nox_lag{lag}"], s.shift(lag).iloc[at])
    np.testing.assert_allclose(got.nox_mean_24h, s.shift(1).rolling(24, min_periods=6).mean().iloc[at])
    np.testing.assert_allclose(got.y, s.shift(-6).iloc[at])
    assert "no2_lag1" not in got.columns


def parts_of(spark, x, y, split, key=None):
    rows = [(*map(float, a), float(b), s) for a, b, s in zip(x, y, split)]
    names = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "y"]) + ", split string")
    return (df if key is None else df.withColumn("k", F.lit(key))), names


def test_linear_family_equals_direct_solution(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 4)) * [1, 10, 0.1, 1000] + [0, 100, 5, 1e6]
    y = x @ [2.0, -0.3, 4.0, 0.001] + rng.normal(size=600) + 50
    split = ["train"] * 400 + ["val"] * 100 + ["test"] * 100
    parts, names = parts_of(spark, x, y, split)
    train, both = slice(0, 400), slice(0, 500)

    def solve(rows, algorithm, alpha):
        a, b = x[rows], y[rows]
        mean, dev = a.mean(axis=0), a.std(axis=0)
        z, c = (a - mean) / dev, b - b.mean()
        if algorithm == "linear":
            beta = np.linalg.lstsq(z, c, rcond=None)[0]
        else:
            beta = np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ c)
        return lambda q: (q - mean) / dev @ beta + b.mean()

    for algorithm, alpha in [("linear", None), ("ridge", 10.0)]:
        m = models.fit_linear(parts, names, candidates=[(algorithm, alpha)])
        r = m.first()
        want = solve(train, algorithm, alpha)(x[400:500])
        assert r.val_rmse == pytest.approx(np.sqrt(np.mean((want - y[400:500]) ** 2)), rel=1e-8)
        final = solve(both, algorithm, alpha)(x[500:])
        got = models.predict_linear(parts.filter("split = 'test'"), m, names).orderBy("x0").toPandas()
        np.testing.assert_allclose(got.prediction, final[np.argsort(x[500:, 0])], rtol=1e-7)
        assert r.test_rmse == pytest.approx(np.sqrt(np.mean((final - y[500:]) ** 2)), rel=1e-7)

    alpha = 0.05
    r = models.fit_linear(parts.filter("split = 'train'"), names, candidates=[("lasso", alpha)]).first()
    a, b = x[train], y[train]
    z, dev = (a - a.mean(axis=0)) / a.std(axis=0), a.std(axis=0)
    beta = np.array(r.coef) * dev
    pull = z.T @ (b - b.mean() - z @ beta) / len(b)  # optimality of the lasso
    for g, w in zip(pull, beta):
        assert abs(g) <= alpha + 1e-7 if w == 0 else g == pytest.approx(alpha * np.sign(w), abs=1e-7)


def test_selection_takes_the_first_of_equals_per_key(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(90, 2))
    split = ["train"] * 60 + ["val"] * 20 + ["test"] * 10
    one, names = parts_of(spark, x, x @ [1.0, 2.0], split, "a")
    two, _ = parts_of(spark, x, x @ [-3.0, 0.5] + 4, split, "b")
    m = models.fit_linear(one.unionByName(two), names, keys=["k"], candidates=[("linear", None), ("ridge", 0.0), ("ridge", 10.0)])
    got = {r.k: r for r in m.collect()}
    assert got["a"].algorithm == got["b"].algorithm == "linear" or got["a"].val_rmse < 1e-6
    np.testing.assert_allclose(got["b"].coef, [-3.0, 0.5], atol=1e-8)
    assert len(got["a"].candidates) == 3


def test_boosted_beats_the_mean_and_survives_saving(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.random(size=(300, 2))
    parts, names = parts_of(spark, x, np.where(x[:, 0] > 0.5, 10.0, 0.0) + x[:, 1], ["train"] * 200 + ["val"] * 50 + ["test"] * 50)
    best = boosting.select_boosted(parts, names, candidates=[(3, 0.1, 2), (10, 0.3, 3)])
    test = parts.filter("split = 'test'")
    score = evaluate.forecast_metrics(best.predict(test), "y", "prediction").first()
    assert score.r2 > 0.8
    best.save(str(tmp_path / "m"))
    again = evaluate.forecast_metrics(boosting.Boosted.load(str(tmp_path / "m")).predict(test), "y", "prediction").first()
    assert again.rmse == pytest.approx(score.rmse)


def test_boosting_by_level_equals_boosting_in_one_task(spark):
    """The jobs merge what the blocks add up to the same trees, whatever the blocks; so does plain code over sorted values."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, size=(240, 3)).astype(float)
    parts, names = parts_of(spark, x, np.round(np.sin(x[:, 0] / 6) * 8 + (x[:, 1] > 20) * x[:, 2]), ["train"] * 180 + ["val"] * 60)
    settings = [(2, 0.5, 3), (12, 0.25, 2)]
    whole = boosting.select_boosted(parts, names, candidates=settings)
    cut = boosting.select_boosted(parts.repartition(4), names, candidates=settings, block_rows=70)
    assert whole.params == cut.params and whole.val_rmse == pytest.approx(cut.val_rmse)
    for a, b in zip(whole.trees, cut.trees, strict=True):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut)
        np.testing.assert_allclose(a.value, b.value, atol=1e-9)
    y = np.array([r.y for r in parts.orderBy("y").select("y").collect()])
    assert whole.base == pytest.approx(y.mean())
    # the first split of the refit, by trying every cut of every feature
    rows = parts.select(*names, "y").toPandas()
    off, best = rows.y - rows.y.mean(), (0.0, None)
    for i, c in enumerate(names):
        for edge in whole.edges[i]:
            left = rows[c] <= edge
            if 0 < left.sum() < len(rows):
                gain = sum(off[side].sum() ** 2 / (side.sum() + 1.0) for side in (left, ~left)) - off.sum() ** 2 / (len(rows) + 1.0)
                if gain > best[0] + 1e-9:
                    best = (gain, (i, edge))
    first = whole.trees[0]
    assert (int(first.feature[0]), whole.edges[first.feature[0]][first.cut[0]]) == best[1]


def test_metric_edges(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0), (None, 5.0)], "y double, p double")
    r = evaluate.forecast_metrics(df, "y", "p").first()
    assert (r.n, r.mae, r.smape) == (2, 0.5, pytest.approx(200 * (1 / 3) / 2))
    t = evaluate.paired_ttest(df.limit(1).withColumn("b", F.lit(1.0)), "y", "p", "b").first()
    assert t.t_statistic is None and t.p_value is None and not t.significant


def test_best_run_ignores_failed_and_zero(spark):
    rows = [("a", "FINISHED", {"test_rmse": 140.2}), ("b", "FAILED", {"test_rmse": 1.0}), ("c", "FINISHED", {"test_rmse": 0.0}),
            ("d", "FINISHED", {"test_rmse": 138.8}), ("e", "FINISHED", {})]
    runs = spark.createDataFrame(rows, "run_id string, status string, metrics map<string,double>")
    assert evaluate.best_run(runs).first().run_id == "d"


def test_direct_forecast_uses_aligned_anchors(spark):
    """A model that returns lag 6 turns anchor t - (6 - k) into the value at t + k - 12."""
    values = np.random.default_rng(9).random(200)
    series = hours(spark, values, "a").unionByName(hours(spark, values[:40], "short"))
    serve = lambda df: df.withColumn("prediction", F.col("nox_lag6"))
    got = predict.forecast_direct(series, serve, "ts", ["k"], exogenous=()).orderBy("ts").collect()
    assert [r.step for r in got] == [1, 2, 3, 4, 5, 6]  # the short series is refused
    assert got[0].ts == START + dt.timedelta(hours=200)
    np.testing.assert_allclose([r.prediction for r in got], values[[199 - 5 + k - 6 for k in range(6)]])
    late = predict.forecast_latest(series, serve, "ts", ["k"], exogenous=()).orderBy("ts").collect()
    assert [r.prediction for r in late[:5]] == [None] * 5 and late[5].prediction == pytest.approx(values[193])


def test_seasonal_model_follows_a_daily_cycle(spark):
    rng = np.random.default_rng(10)
    n = 24 * 60
    noise = rng.normal(size=n)
    ar = np.zeros(n)
    for i in range(1, n):
        ar[i] = 0.7 * ar[i - 1] + noise[i]
    cycle = 100 + 20 * np.sin(2 * np.pi * np.arange(n) / 24)
    df = hours(spark, cycle + ar, "a").unionByName(hours(spark, 3 * cycle + ar, "b"))
    fitted, ends = seasonal.fit_seasonal_ar(df, "ts", keys=["k"])
    rows = {r.k: r for r in fitted.collect()}
    assert set(rows) == {"a", "b"} and 0.8 < rows["a"].sigma < 1.5
    out = seasonal.forecast(fitted.withColumn("steps", F.lit(24)), ends, ["k"], "ts").filter("k = 'a'").orderBy("ts").toPandas()
    end = int(n * 0.7) + int(n * 0.15)
    assert out.ts.iloc[0] == START + dt.timedelta(hours=end)  # stamped from the model's own end
    truth = (cycle + ar)[end:end + 24]
    assert np.sqrt(np.mean((out["mean"] - truth) ** 2)) < 3.5
    assert np.mean((out.lo <= truth) & (truth <= out.hi)) >= 0.8
    width = (out.hi - out.lo).to_numpy()
    assert (np.diff(width) > -1e-9).all()


def test_serving_reaches_as_far_as_its_lags(spark):
    """A dense series of 400 hours has six anchors whatever its longest lag is."""
    rows = [(START + dt.timedelta(hours=i), float(i % 37), float(i % 11), float(i % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, nox_gt double, co_gt double, no2_gt double")
    for lags in ((1, 24), (1, 24, 120), (200,)):
        got = predict.serving_rows(df, "ts", lags=lags).orderBy("step").collect()
        assert [r.step for r in got] == [1, 2, 3, 4, 5, 6]
        assert all(r[f"nox_lag{lags[-1]}"] == float((393 + i - lags[-1] + 1) % 37) for i, r in enumerate(got))


def test_forecast_of_a_short_series_comes_without_values(spark):
    rows = [(k, START + dt.timedelta(hours=i), float(i % 24) + 0.1 * (i % 7)) for k, n in (("long", 600), ("short", 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, nox_gt double")
    fitted, _ = seasonal.fit_seasonal_ar(df.filter("k = 'long'"), "ts", "nox_gt", ["k"])
    lagged = seasonal.seasonal_rows(df, "ts", "nox_gt", ["k"])
    both = fitted.unionByName(fitted.withColumn("k", F.lit("short"))).withColumn("steps", F.lit(3))
    got = seasonal.forecast(both, seasonal.tails(lagged, "ts", ["k"]), ["k"], "ts").collect()
    assert sorted((r.k, r["mean"] is None or r["mean"] != r["mean"]) for r in got) == [("long", False)] * 3 + [("short", True)] * 3


def test_serving_a_series_of_another_step(spark):
    """A quarter-hour series: anchors, reach and stamps go by its own step."""
    rows = [(START + dt.timedelta(minutes=15 * i), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, nox_gt double")
    got = predict.serving_rows(df, "ts", step=900, exogenous=()).orderBy("step").collect()
    assert [r.step for r in got] == [1, 2, 3, 4, 5, 6]
    assert [r.ts for r in got] == [rows[-1][0] + dt.timedelta(minutes=15 * k) for k in range(1, 7)]
    assert [r.nox_lag1 for r in got] == [float(199 - 6 + k - 1) for k in range(1, 7)]
    last = predict.forecast_latest(df, lambda t: t.withColumn("prediction", F.lit(1.0)), "ts", step=900, exogenous=()).orderBy("ts").collect()
    assert [r.ts for r in last] == [r.ts for r in got] and [r.prediction for r in last] == [None] * 5 + [1.0]
