"""How a series depends on its past: autocorrelation, decomposition, comparison of forecasts.

Every sum over lagged pairs is taken in one pass over time buckets with a halo as wide as the longest
lag, so a long series is many tasks; what follows works on a few numbers per series.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skywell.functions.attach import attach, melt
from skywell.functions.scalars import epoch_seconds
from skywell.functions.tdist import t_pvalue
from skywell.operators.ordered import DAY, HOUR, halo

WIDTH = 30 * DAY


def lagged_sums(df: DataFrame, cols, keys, ts: str, lags: int, step: int = HOUR, width: int = WIDTH) -> DataFrame:
    """Per key and channel: `n`, `mean`, and `sums`, the sums of products of deviations by lag from 0 to `lags`.

    A pair counts where both values are known, exactly `k` steps apart; gaps need no rows.
    """
    keys, cols = list(keys), list(cols)
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])
    centred = attach(df.select(*keys, ts, *cols), means, keys, "_mean").select(
        *keys, ts, *[(F.col(c) - F.col(f"_mean.{c}")).alias(c) for c in cols], F.col("_mean")
    )
    cut = halo(centred, ts, lags * step, 0, max(width, lags * step)).withColumn("_t", epoch_seconds(ts))
    own = W.partitionBy(*keys, "_bucket").orderBy("_t")

    def before(c: str, k: int) -> Column:
        return F.first(c).over(own.rangeBetween(-k * step, -k * step))

    pairs = cut.withColumns({f"_p_{c}": F.array(*[F.col(c) * (before(c, k) if k else F.col(c)) for k in range(lags + 1)]) for c in cols})
    core = pairs.filter("_core")
    wide = core.groupBy(*keys).agg(*[
        F.struct(
            F.count(c).alias("n"), F.max(f"_mean.{c}").alias("mean"),
            F.array(*[F.coalesce(F.sum(F.col(f"_p_{c}")[k]), F.lit(0.0)) for k in range(lags + 1)]).alias("sums"),
        ).alias(c) for c in cols
    ])
    return melt(wide, cols, lambda c: [F.col(f"{c}.n").alias("n"), F.col(f"{c}.mean").alias("mean"), F.col(f"{c}.sums").alias("sums")], keys)


def autocorrelation(df: DataFrame, cols, keys, ts: str, lags: int = 48, step: int = HOUR, width: int = WIDTH) -> DataFrame:
    """Key, channel, `lag`, `acf` and whether it passes the 95 % band of a series without memory."""
    sums = lagged_sums(df, cols, keys, ts, lags, step, width)
    rows = sums.select(*keys, "channel", "n", F.posexplode("sums").alias("lag", "s"), F.col("sums")[0].alias("s0"))
    acf = F.when(F.col("s0") > 0, F.col("s") / F.col("s0"))
    return rows.select(*keys, "channel", "lag", acf.alias("acf"), "n", (F.abs(acf) * F.sqrt("n") > 1.96).alias("significant"))


def partial_coefficients(acf: np.ndarray) -> np.ndarray:
    """Partial autocorrelations of lags 1 and up from autocorrelations of lags 0 and up (Durbin-Levinson)."""
    out, phi, left = [], np.zeros(0), 1.0
    for k in range(1, len(acf)):
        if not left > 1e-12:
            out.append(np.nan)
            continue
        last = (acf[k] - phi @ acf[k - 1 : 0 : -1]) / left if k > 1 else acf[1]
        phi = np.append(phi - last * phi[::-1], last)
        left *= 1.0 - last * last
        out.append(last)
    return np.array(out)


def partial_autocorrelation(df: DataFrame, cols, keys, ts: str, lags: int = 48, step: int = HOUR, width: int = WIDTH) -> DataFrame:
    """Key, channel, `lag` from 1 and `pacf`; one short array per series is worked on."""
    keys = list(keys)
    sums = lagged_sums(df, cols, keys, ts, lags, step, width).filter(F.col("sums")[0] > 0)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [partial_coefficients(np.asarray(s, float) / s[0]) for s in b["sums"]]
            yield b[[*keys, "channel"]].assign(pacf=made)

    kinds = "".join(f"`{k}` {dict(df.dtypes)[k]}, " for k in keys)
    found = sums.select(*keys, "channel", "sums").mapInPandas(solve, f"{kinds}channel string, pacf array<double>")
    rows = found.select(*keys, "channel", F.posexplode("pacf").alias("_i", "pacf"))
    return rows.select(*keys, "channel", (F.col("_i") + 1).alias("lag"), F.when(~F.isnan("pacf"), F.col("pacf")).alias("pacf"))


def decompose(df: DataFrame, col: str, keys, ts: str, period: int = 24, step: int = HOUR, width: int = WIDTH) -> DataFrame:
    """Trend, season and residual of an even-period series: `trend + season + residual` is the value.

    The trend is the two-sided moving average over a period, its two ends weighted half, null within half a period of an
    end or a gap. The season of a phase is the mean of what the trend leaves there, less the mean over
    all phases.
    """
    keys, half = list(keys), period // 2
    cut = halo(df.select(*keys, ts, col), ts, half * step, half * step, max(width, period * step)).withColumn("_t", epoch_seconds(ts))
    own = W.partitionBy(*keys, "_bucket").orderBy("_t")
    inner = own.rangeBetween(-(half - 1) * step, (half - 1) * step)
    ends = [F.first(col).over(own.rangeBetween(k * step, k * step)) for k in (-half, half)]
    whole = F.count(col).over(inner) == period - 1
    cut = cut.withColumn("trend", F.when(whole, (F.sum(col).over(inner) + 0.5 * ends[0] + 0.5 * ends[1]) / period))
    phase = F.pmod(F.floor(F.col("_t") / step), F.lit(period))
    rows = cut.filter("_core").withColumn("_phase", phase)
    phases = rows.groupBy(*keys, "_phase").agg(F.avg(F.col(col) - F.col("trend")).alias("m"))
    level = phases.groupBy(*keys).agg(F.avg("m").alias("level"))
    phases = attach(phases, level, keys, "_l").select(*keys, "_phase", (F.col("m") - F.col("_l.level")).alias("season"))
    rows = attach(rows, phases, [*keys, "_phase"], "_s").withColumn("season", F.col("_s.season"))
    return rows.select(*keys, ts, F.col(col).alias("value"), "trend", "season", (F.col(col) - F.col("trend") - F.col("season")).alias("residual"))


def diebold_mariano(df: DataFrame, actual: str, one: str, two: str, keys, ts: str, horizon: int, step: int = HOUR, width: int = WIDTH) -> DataFrame:
    """Whether two forecasts `horizon` steps ahead err alike in squares, per key: `n`, `mean_difference`, `statistic`, `p_value`.

    The variance of the mean loss difference has Bartlett weights up to `horizon - 1` lags; the statistic
    has the small-sample correction and is read against Student's t.
    """
    keys = list(keys)
    loss = (F.col(actual) - F.col(one)) ** 2 - (F.col(actual) - F.col(two)) ** 2
    rows = df.select(*keys, ts, loss.alias("loss")).filter("loss IS NOT NULL")
    sums = lagged_sums(rows, ["loss"], keys, ts, max(horizon - 1, 0), step, width)
    n = F.col("n").cast("double")
    weights = [1.0, *(2.0 * (1.0 - k / horizon) for k in range(1, horizon))]
    variance = sum((F.col("sums")[k] * w for k, w in enumerate(weights)), F.lit(0.0)) / n
    small = F.sqrt((n + 1 - 2 * horizon + F.lit(horizon * (horizon - 1)) / n) / n)
    found = sums.withColumn("statistic", F.when(variance > 0, F.col("mean") / F.sqrt(variance / n) * small))
    return found.select(*keys, "n", F.col("mean").alias("mean_difference"), "statistic", t_pvalue(F.col("statistic"), F.col("n") - 1).alias("p_value"))


# The chances that a Poisson variable of mean 1 is at most 0, 1, 2, ...
POISSON = [0.36787944117, 0.73575888234, 0.91969860292, 0.98101184312, 0.99634015317, 0.99940581518, 0.99991675885, 0.99998975080]


def bootstrap_mean(
    df: DataFrame, value: str, keys, ts: str, block: int = DAY, replicates: int = 1000, level: float = 0.95, seed: int = 42,
) -> DataFrame:
    """A confidence interval of a series' mean that respects its memory: `n`, `mean`, `low`, `high` per key.

    Stretches of `block` seconds are drawn whole. In each replicate a stretch counts as often as a Poisson number drawn from
    a hash of key, stretch and replicate says, so a lost executor draws the same again and no row is copied: the
    data is summed by stretch once, and tasks combine replicates before they are shuffled.
    """
    keys = list(keys)
    stretch = F.floor(epoch_seconds(ts) / F.lit(block)).alias("_stretch")
    sums = df.filter(F.col(value).isNotNull()).groupBy(*keys, stretch).agg(F.sum(value).alias("_s"), F.count("*").alias("_n"))
    drawn = sums.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    u = F.pmod(F.xxhash64(*keys, "_stretch", "_r", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    weight = sum((F.when(u > p, 1).otherwise(0) for p in POISSON), F.lit(0))
    means = drawn.groupBy(*keys, "_r").agg((F.sum(F.col("_s") * weight) / F.nullif(F.sum(F.col("_n") * weight), F.lit(0))).alias("m"))
    ends = [(1 - level) / 2, (1 + level) / 2]
    limits = means.groupBy(*keys).agg(F.percentile("m", F.array(*[F.lit(e) for e in ends])).alias("q"))
    whole = sums.groupBy(*keys).agg(F.sum("_n").alias("n"), (F.sum("_s") / F.sum("_n")).alias("mean"))
    if not keys:
        return whole.withColumn("_q", limits.scalar()).filter("n > 0").select("n", "mean", F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"))
    return attach(whole, limits, keys, "_q").select(*keys, "n", "mean", F.col("_q.q")[0].alias("low"), F.col("_q.q")[1].alias("high"))
