"""Dependence, drift and episodes against numpy and plain code."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skywell.functions.tdist import two_sided_p
from skywell.operators import dependence, drift

START = dt.datetime(2024, 1, 1)


def series(spark, values, name="v", key=None):
    rows = [(key, START + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"k string, ts timestamp_ntz, {name} double")


def waves(n, seed=1):
    r = np.random.default_rng(seed)
    x = np.zeros(n)
    for t in range(2, n):
        x[t] = 0.6 * x[t - 1] - 0.3 * x[t - 2] + r.normal()
    return x


def test_acf_and_pacf_equal_numpy(spark):
    x = waves(300)
    df = series(spark, x, key="a").unionByName(series(spark, [5.0] * 20, key="b"))
    got = {r.lag: r.acf for r in dependence.autocorrelation(df, ["v"], ["k"], "ts", 10, width=20 * 3600).filter("k = 'a'").collect()}
    d = x - x.mean()
    want = [1.0, *(d[k:] @ d[:-k] / (d @ d) for k in range(1, 11))]
    np.testing.assert_allclose([got[k] for k in range(11)], want, atol=1e-10)
    rows = dependence.partial_autocorrelation(df, ["v"], ["k"], "ts", 10, width=20 * 3600).collect()
    assert {r.k for r in rows} == {"a"}  # a constant has no memory to speak of
    for r in rows:  # the last coefficient of the Yule-Walker equations of each order
        toeplitz = np.array([[want[abs(i - j)] for j in range(r.lag)] for i in range(r.lag)])
        assert r.pacf == pytest.approx(np.linalg.solve(toeplitz, want[1 : r.lag + 1])[-1], abs=1e-9)


def test_lagged_sums_skip_gaps(spark):
    x = [1.0, None, 4.0, 2.0, None, 7.0, 3.0]
    df = series(spark, x).filter("v IS NOT NULL OR ts = '2024-01-01 01:00:00'")  # one hour null, one absent
    r = dependence.lagged_sums(df, ["v"], ["k"], "ts", 2, width=3 * 3600).first()
    d = [None if v is None else v - 17.0 / 5 for v in x]
    want = [sum(d[i] * d[i - k] for i in range(k, 7) if d[i] is not None and d[i - k] is not None) for k in range(3)]
    assert (r.n, r["mean"]) == (5, pytest.approx(3.4)) and r.sums == pytest.approx(want)


def test_decomposition_adds_up_and_finds_the_season(spark):
    t = np.arange(24 * 20)
    daily = np.sin(2 * math.pi * t / 24) * 5
    df = series(spark, 10 + 0.01 * t + daily)
    rows = dependence.decompose(df, "v", ["k"], "ts", width=3 * 86_400).orderBy("ts").collect()
    assert len(rows) == len(t) and all(r.trend is None for r in rows[:12] + rows[-12:])
    for r, i in zip(rows[12:-12], t[12:-12]):
        assert r.trend + r.season + r.residual == pytest.approx(r.value)
        assert (r.trend, r.season) == (pytest.approx(10 + 0.01 * i), pytest.approx(daily[i], abs=1e-6))


def test_diebold_mariano_equals_plain_code(spark):
    r = np.random.default_rng(4)
    y, n, h = r.normal(size=200), 200, 3
    a, b = y + r.normal(size=n), y + 1.3 * r.normal(size=n)
    rows = [(START + dt.timedelta(hours=i), float(y[i]), float(a[i]), float(b[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y double, a double, b double")
    got = dependence.diebold_mariano(df, "y", "a", "b", [], "ts", h, width=30 * 3600).first()
    d = (y - a) ** 2 - (y - b) ** 2
    e = d - d.mean()
    v = (e @ e + 2 * sum((1 - k / h) * (e[k:] @ e[:-k]) for k in range(1, h))) / n
    want = d.mean() / math.sqrt(v / n) * math.sqrt((n + 1 - 2 * h + h * (h - 1) / n) / n)
    assert got.statistic == pytest.approx(want) and got.p_value == pytest.approx(two_sided_p(want, n - 1))
    same = dependence.diebold_mariano(df, "y", "a", "a", [], "ts", h).first()
    assert same.statistic is None and same.p_value is None


def test_kolmogorov_smirnov(spark):
    r = np.random.default_rng(5)
    a, b = r.normal(size=150).round(1), r.normal(0.5, size=90).round(1)
    rows = [("k", float(v), late) for x, late in ((a, False), (b, True)) for v in x] + [("one", 1.0, False), ("k", None, True)]
    df = spark.createDataFrame(rows, "k string, v double, late boolean")
    got = {x.k: x for x in drift.ks_drift(df, "v", F.col("late"), ["k"], widths=(0.7, 3)).collect()}
    points = np.unique(np.concatenate((a, b)))
    want = max(abs((a <= p).mean() - (b <= p).mean()) for p in points)
    assert got["k"].distance == pytest.approx(want) and (got["k"].n_before, got["k"].n_after) == (150, 90)
    assert got["one"].distance is None and got["one"].p_value is None
    one = spark.range(1).select(*[drift.kolmogorov_p(F.lit(x)).alias(f"p{i}") for i, x in enumerate((0.1, 0.8276, 1.3581, 1.6276, 3.0))]).first()
    np.testing.assert_allclose(list(one), [1.0, 0.5, 0.05, 0.01, 3e-8], rtol=3e-2)  # published points of the distribution


def test_stability_of_equal_and_moved_periods(spark):
    rows = [(float(i % 100), late) for i in range(2000) for late in (False, True)]
    same = spark.createDataFrame(rows, "v double, late boolean")
    moved = same.withColumn("v", F.when(F.col("late"), F.col("v") + 30).otherwise(F.col("v")))
    assert drift.population_stability(same, "v", F.col("late"), []).first().psi == pytest.approx(0.0)
    assert drift.population_stability(moved, "v", F.col("late"), []).first().psi > 0.25


def test_correlation_breaks_where_the_sign_turns(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=24 * 30)
    y = np.where(np.arange(24 * 30) < 24 * 25, x, -x) + 0.3 * r.normal(size=24 * 30)
    rows = [(START + dt.timedelta(hours=i), float(x[i]), float(y[i])) for i in range(len(x))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double, y double")
    got = drift.correlation_breaks(df, "x", "y", [], "ts", days=3).orderBy("day").collect()
    assert got[-1].broken and got[-1].n == 72 and got[-1].correlation == pytest.approx(np.corrcoef(x[-72:], y[-72:])[0, 1])
    assert got[-1].z < 0 and not any(g.broken for g in got if g.z is not None and abs(g.z) <= 3)


def test_episodes_span_buckets(spark):
    values = [1, 25, 26, None, 27, 45, 60, 60, 1, 1, None]
    df = series(spark, values, "c6h6_gt", "a").unionByName(series(spark, [5.0], "c6h6_gt", "b"))
    got = [(r.k, r.level, r.start.hour, r.end.hour, r.readings, r.peak) for r in
           drift.alert_episodes(df, "c6h6_gt", ["k"], "ts", widths=(2 * 3600, 2)).orderBy("k", "start").collect()]
    assert got == [("a", "normal", 0, 0, 1, 1.0), ("a", "caution", 1, 4, 3, 27.0), ("a", "alert", 5, 5, 1, 45.0),
                   ("a", "critical", 6, 7, 2, 60.0), ("a", "normal", 8, 9, 2, 1.0), ("b", "normal", 0, 0, 1, 5.0)]


def test_bootstrap_intervals_cover_the_mean_and_repeat(spark):
    r = np.random.default_rng(7)
    rows = []
    for k in range(60):  # series with memory of a few hours, mean 3
        x = np.convolve(r.normal(size=24 * 40 + 5), np.ones(6) / 6, "valid") + 3
        rows += [(k, START + dt.timedelta(hours=i), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    got = dependence.bootstrap_mean(df, "v", ["k"], "ts", replicates=300).collect()
    covered = sum(g.low <= 3 <= g.high for g in got)
    assert 50 <= covered <= 60 and all(g.low < g["mean"] < g.high and g.n == 960 for g in got)
    again = dependence.bootstrap_mean(df.repartition(7), "v", ["k"], "ts", replicates=300).collect()
    assert sorted((g.k, round(g.low, 9)) for g in got) == sorted((g.k, round(g.low, 9)) for g in again)
    assert dependence.bootstrap_mean(df.limit(0), "v", [], "ts", replicates=10).count() == 0
