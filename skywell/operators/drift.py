"""Whether a later period differs from an earlier one, and episodes of raised levels."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skywell.functions.attach import attach
from skywell.functions.quantiles import exact_quantiles
from skywell.operators.ordered import DAY, Before, LastBefore, running
from skywell.schema import ALERT_LEVELS, LEVEL_NAMES

TERMS = 50  # of the Kolmogorov series
LEAST_SHARE = 1e-4  # a bin without rows counts as this share


def kolmogorov_p(x: Column) -> Column:
    """The chance that the scaled distance of two equal distributions passes `x`."""
    series = sum((F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * x * x) for k in range(1, TERMS + 1)), F.lit(0.0))
    return F.when(x < 0.2, 1.0).when(x.isNotNull(), F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_drift(df: DataFrame, value: str, later: Column, keys, widths=(1.0, 1000)) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per key: `n_before`, `n_after`, `distance`, `p_value`.

    Rows are first counted by distinct value. The running counts go by buckets of the value's range (`widths`: of
    a bucket, and how many buckets make a coarser one), so no key's values meet in one task.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_x"), F.coalesce(later, F.lit(False)).alias("_after"))
    counts = rows.groupBy(*keys, "_x").agg(F.count(F.when(~F.col("_after"), 1)).alias("_a"), F.count(F.when(F.col("_after"), 1)).alias("_b"))
    totals = rows.groupBy(*keys).agg(F.count(F.when(~F.col("_after"), 1)).alias("a"), F.count(F.when(F.col("_after"), 1)).alias("b"))
    upto = running(counts, keys, "_x", {"_ca": Before(F.col("_a")), "_cb": Before(F.col("_b"))}, widths)
    upto = attach(upto, totals, keys, "_n")
    gap = F.abs((F.col("_ca") + F.col("_a")) / F.col("_n.a") - (F.col("_cb") + F.col("_b")) / F.col("_n.b"))
    both = (F.col("_n.a") > 0) & (F.col("_n.b") > 0)
    found = upto.groupBy(*keys).agg(F.max("_n.a").alias("n_before"), F.max("_n.b").alias("n_after"), F.max(F.when(both, gap)).alias("distance"))
    scale = F.sqrt(F.col("n_before") * F.col("n_after") / (F.col("n_before") + F.col("n_after")))
    return found.withColumn("p_value", kolmogorov_p(scale * F.col("distance")))


def population_stability(df: DataFrame, value: str, later: Column, keys, bins: int = 10) -> DataFrame:
    """The population stability index per key over bins that each hold an equal share of the earlier period: `psi`."""
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("x"), F.coalesce(later, F.lit(False)).alias("_after"))
    edges = exact_quantiles(rows.filter(~F.col("_after")), ["x"], [i / bins for i in range(1, bins)], keys).select(*keys, "q")
    placed = attach(rows, edges, keys, "_e")
    bin_ = F.size(F.filter("_e.q", lambda e: e < F.col("x")))
    placed = placed.filter(F.col("_e.q").isNotNull()).groupBy(*keys, bin_.alias("bin")).agg(
        F.count(F.when(~F.col("_after"), 1)).alias("a"), F.count(F.when(F.col("_after"), 1)).alias("b")
    )
    by_bin = F.map_from_entries(F.collect_list(F.struct("bin", F.struct("a", "b"))))  # at most `bins` rows of a key
    whole = placed.groupBy(*keys).agg(by_bin.alias("m"), F.sum("a").alias("na"), F.sum("b").alias("nb")).filter("nb > 0")

    def term(i):
        p, q = (F.greatest(F.coalesce(F.col("m")[F.lit(i)][c], F.lit(0)) / F.col(n), F.lit(LEAST_SHARE)) for c, n in (("a", "na"), ("b", "nb")))
        return (q - p) * F.log(q / p)

    return whole.select(*keys, F.col("na").alias("n_before"), F.col("nb").alias("n_after"), sum((term(i) for i in range(bins)), F.lit(0.0)).alias("psi"))


def correlation_breaks(df: DataFrame, one: str, two: str, keys, ts: str, days: int = 7, limit: float = 3.0, least: int = 10) -> DataFrame:
    """Days at whose end the correlation over the last `days` days is far from that of the whole series.

    Sums are kept per key and day, about the series' means; windows add up days. Fisher's z of both must differ by
    `limit` standard deviations: `day`, `n`, `correlation`, `baseline`, `z`, `broken`.
    """
    keys = list(keys)
    known = df.filter(F.col(one).isNotNull() & F.col(two).isNotNull()).select(*keys, F.to_date(ts).alias("day"), F.col(one).alias("x"), F.col(two).alias("y"))
    means = known.groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    moved = attach(known, means, keys, "_m").select(*keys, "day", (F.col("x") - F.col("_m.x")).alias("x"), (F.col("y") - F.col("_m.y")).alias("y"))
    parts = {"n": F.lit(1), "x": F.col("x"), "y": F.col("y"), "xx": F.col("x") ** 2, "yy": F.col("y") ** 2, "xy": F.col("x") * F.col("y")}
    daily = moved.groupBy(*keys, "day").agg(*[F.sum(e).alias(f"_{c}") for c, e in parts.items()])
    number = F.date_diff("day", F.lit("1970-01-01").cast("date"))
    last = W.partitionBy(*keys).orderBy(number).rangeBetween(1 - days, 0)

    def correlation(s):
        over = F.sqrt((s("n") * s("xx") - s("x") ** 2) * (s("n") * s("yy") - s("y") ** 2))
        return F.when(over > 0, (s("n") * s("xy") - s("x") * s("y")) / over)

    base = daily.groupBy(*keys).agg(*[F.sum(f"_{c}").alias(c) for c in parts])
    base = base.select(*keys, correlation(lambda c: F.col(c)).alias("r"))
    rolled = daily.select(*keys, "day", *[F.sum(f"_{c}").over(last).alias(c) for c in parts])
    rolled = attach(rolled, base, keys, "_b").withColumn("correlation", correlation(lambda c: F.col(c))).withColumn("baseline", F.col("_b.r"))
    z = (F.atanh("correlation") - F.atanh("baseline")) * F.sqrt(F.col("n") - 3)
    rolled = rolled.withColumn("z", F.when((F.col("n") >= least) & (F.abs("correlation") < 1) & (F.abs("baseline") < 1), z))
    return rolled.select(*keys, "day", "n", "correlation", "baseline", "z", F.coalesce(F.abs("z") > limit, F.lit(False)).alias("broken"))


def alert_level(col: str, levels=ALERT_LEVELS) -> Column:
    """0 to 3: normal, caution, alert, critical; null for an unknown value."""
    return sum((F.when(F.col(col) > t, 1).otherwise(0) for t in levels[col]), F.when(F.col(col).isNotNull(), 0))


def alert_episodes(df: DataFrame, col: str, keys, ts: str, widths=(30 * DAY, 1000), levels=ALERT_LEVELS) -> DataFrame:
    """Stretches of readings at one level: `channel`, `level`, `start`, `end`, `readings`, `peak`. Unknown values are passed over.

    The level before a reading, and the number of changes before it, are carried over time buckets, so an episode may span any
    number of them.
    """
    keys = list(keys)
    rows = df.filter(F.col(col).isNotNull()).select(*keys, ts, F.col(col).alias("_v"), alert_level(col, levels).alias("_level"))
    rows = running(rows, keys, ts, {"_was": LastBefore(F.col("_level"))}, widths).drop("_at")
    rows = rows.withColumn("_new", F.when(F.col("_was") == F.col("_level"), 0).otherwise(1))
    rows = running(rows, keys, ts, {"_before": Before(F.col("_new"))}, widths).withColumn("_episode", F.col("_before") + F.col("_new"))
    found = rows.groupBy(*keys, "_episode", "_level").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("readings"), F.max("_v").alias("peak")
    )
    name = F.element_at(F.array(*[F.lit(n) for n in LEVEL_NAMES]), F.col("_level") + 1)
    return found.select(*keys, F.lit(col).alias("channel"), name.alias("level"), "start", "end", "readings", "peak")
