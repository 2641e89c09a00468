"""Summaries, patterns and correlations."""

from itertools import combinations

from pyspark.sql import DataFrame, Window as W, functions as F

from skywell.functions.attach import attach, melt, null_safe_join
from skywell.functions.quantiles import exact_quantiles
from skywell.functions.scalars import count_where, weekday
from skywell.functions.tdist import t_pvalue


def _sample_skew(n, g):
    """Sample-corrected skewness from the population one; 0 for constant data."""
    return F.when(n >= 3, F.coalesce(F.nanvl(g, F.lit(0.0)), F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2))


def _sample_kurtosis(n, g):
    bulge = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6)
    return F.when(n >= 4, F.when(g.isNull() | F.isnan(g), 0.0).otherwise(bulge))


def moment_summary(df: DataFrame, cols, keys=()) -> DataFrame:
    """Everything in H1 that one aggregation gives: `(keys, channel, n, mean, std, …)`."""
    keys = list(keys)
    wide = df.groupBy(*keys).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.stddev_pop(c).alias("std_pop"),
                F.var_samp(c).alias("variance"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                F.skewness(c).alias("g1"),
                F.kurtosis(c).alias("g2"),
            ).alias(c)
            for c in cols
        ]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"{c}.*")) for c in cols])
    return wide.select(*keys, F.inline(entries)).filter("n > 0")


def describe_columns(df: DataFrame, cols, keys=()) -> DataFrame:
    """H1, H3: count, centre, spread, quartiles, shape and variation per channel."""
    keys = list(keys)
    n = F.col("n")
    base = moment_summary(df, cols, keys)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], keys).select(
        *keys, "channel", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    return null_safe_join(base, quartiles, [*keys, "channel"]).select(
        *keys, "channel", n.alias("count"), "mean", "median", "std", "variance", "min", "max", "q1", "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        _sample_skew(n, F.col("g1")).alias("skewness"),
        _sample_kurtosis(n, F.col("g2")).alias("kurtosis"),
        (F.col("max") - F.col("min")).alias("value_range"),
        F.when(F.col("mean") != 0, F.col("std") / F.col("mean") * 100).otherwise(0.0).alias("cv_percent"),
    )


def quartile_fences(df: DataFrame, cols, keys=(), reach: float = 1.5) -> DataFrame:
    """Wide fences: per group and channel a struct of count, quartiles and bounds."""
    keys = list(keys)
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], keys)
    q1, q3 = F.col("q")[0], F.col("q")[2]
    fence = F.struct(
        F.col("n").alias("n"), q1.alias("q1"), F.col("q")[1].alias("median"), q3.alias("q3"),
        (q1 - reach * (q3 - q1)).alias("low"), (q3 + reach * (q3 - q1)).alias("high"),
    )
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("channel") == c, fence)).alias(c) for c in cols])


def box_stats(df: DataFrame, cols, keys=()) -> DataFrame:
    """H2: quartiles, whisker ends (the outermost values inside the fences) and outlier counts."""
    keys = list(keys)
    fences = quartile_fences(df, cols, keys)
    rows = attach(df.select(*keys, *cols), fences, keys, "_f")

    def inside(c):
        return (F.col(c) >= F.col(f"_f.{c}.low")) & (F.col(c) <= F.col(f"_f.{c}.high"))

    wide = rows.groupBy(*keys).agg(
        *[
            F.struct(
                F.max(f"_f.{c}.n").alias("count"),
                F.max(f"_f.{c}.q1").alias("q1"),
                F.max(f"_f.{c}.median").alias("median"),
                F.max(f"_f.{c}.q3").alias("q3"),
                F.min(F.when(inside(c), F.col(c))).cast("double").alias("whisker_low"),
                F.max(F.when(inside(c), F.col(c))).cast("double").alias("whisker_high"),
                count_where(~inside(c)).alias("outliers"),
            ).alias(c)
            for c in cols
        ]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"{c}.*")) for c in cols])
    return wide.select(*keys, F.inline(entries)).filter("count > 0")


def box_outliers(df: DataFrame, cols, keys=(), ids=()) -> DataFrame:
    """H2: the values that a box view draws as points, those outside the fences."""
    keys = list(keys)
    rows = attach(df.select(*keys, *ids, *cols), quartile_fences(df, cols, keys), keys, "_f")

    def fields(c):
        f = F.col(f"_f.{c}")
        beyond = (F.col(c) < f["low"]) | (F.col(c) > f["high"])
        return [F.when(beyond, F.col(c)).cast("double").alias("value")]

    return melt(rows, cols, fields, [*keys, *ids], F.col("value").isNotNull())


# Weekday labels, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def temporal_patterns(df: DataFrame, cols, ts: str, parts=("hour", "weekday", "month"), keys=()) -> DataFrame:
    """Channel means by hour of day, weekday and month in one pass over the data."""
    keys = list(keys)
    make = {"hour": F.hour(ts), "weekday": weekday(ts), "month": F.month(ts)}
    rows = df.select(*keys, *cols, *[make[p].cast("bigint").alias(f"_{p}") for p in parts])
    marks = [F.when(F.grouping(f"_{p}") == 0, p) for p in parts]
    wide = rows.groupingSets(
        [[*[F.col(k) for k in keys], F.col(f"_{p}")] for p in parts],
        *[F.col(k) for k in keys], *[F.col(f"_{p}") for p in parts],
    ).agg(
        F.coalesce(*marks).alias("pattern"),
        *[F.struct(F.avg(c).alias("mean"), F.count(c).alias("n")).alias(f"_v_{c}") for c in cols],
    )
    wide = wide.withColumn("part", F.coalesce(*[F.col(f"_{p}") for p in parts]))
    return melt(wide, cols, lambda c: [F.col(f"_v_{c}.mean").alias("mean"), F.col(f"_v_{c}.n").alias("n")],
                [*keys, "pattern", "part"])


def weekday_label(part):
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), (part + 1).cast("int"))


def correlation_matrix(df: DataFrame, cols, keys=()) -> DataFrame:
    """Pearson correlation of each pair over complete rows; the upper triangle."""
    keys = list(keys)
    pairs = list(combinations(cols, 2))
    wide = df.dropna(subset=list(cols)).groupBy(*keys).agg(
        F.count("*").alias("n"),
        # A constant channel has no correlation; the built-in corr would fail the query on it.
        *[
            F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"_{i}")
            for i, (x, y) in enumerate(pairs)
        ],
    )
    entries = F.array(
        *[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{i}").alias("corr")) for i, (x, y) in enumerate(pairs)]
    )
    return wide.filter("n > 1").select(*keys, "n", F.inline(entries))


def full_matrix(upper: DataFrame) -> DataFrame:
    """Both triangles of an upper-triangle result, for display; the diagonal is 1 by definition."""
    flipped = upper.withColumnsRenamed({"x": "_y", "y": "_x"}).withColumnsRenamed({"_x": "x", "_y": "y"})
    return upper.unionByName(flipped)


def with_pvalues(corr: DataFrame) -> DataFrame:
    """H8: two-sided Pearson p-value of each pair."""
    r, dof = F.col("corr"), F.col("n") - 2
    t = F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(r * F.sqrt(dof / (1 - r * r)))
    return corr.withColumn("p", t_pvalue(t, dof))


def fdr_bh(tests: DataFrame, p: str = "p", family=(), order=()) -> DataFrame:
    """H9: Benjamini-Hochberg q-values within each family of tests."""
    family = list(family)
    ranked = W.partitionBy(*family).orderBy(F.col(p), *order)
    upward = W.partitionBy(*family).orderBy(F.col("_rank").desc())
    size = F.count(p).over(W.partitionBy(*family))
    return (
        tests.filter(F.col(p).isNotNull())
        .withColumn("_rank", F.row_number().over(ranked))
        .withColumn("_raw", F.col(p) * size / F.col("_rank"))
        .withColumn("q", F.least(F.min("_raw").over(upward.rowsBetween(W.unboundedPreceding, 0)), F.lit(1.0)))
        .drop("_rank", "_raw")
    )


def standardize(df: DataFrame, cols, keys=(), fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0. `fit` gives the statistics."""
    keys = list(keys)
    stats = (df if fit is None else fit).groupBy(*keys).agg(
        *[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]
    )

    def scaled(c):
        dev = F.col(f"_s.{c}.s")
        return (F.col(c) - F.col(f"_s.{c}.m")) / F.when(dev == 0, F.lit(1.0)).otherwise(dev)

    return attach(df, stats, keys, "_s").withColumns({c: scaled(c) for c in cols}).drop("_s")


def outlier_profile(df: DataFrame, cols, keys=()) -> DataFrame:
    """Per channel the numbers behind the outlier views.

    The largest |z| lies at the minimum or the maximum, so no further pass is needed.
    """
    keys = list(keys)
    fences = melt(quartile_fences(df, cols, keys), cols, lambda c: [F.col(f"{c}.low").alias("low"), F.col(f"{c}.high").alias("high")], keys)
    reach = F.greatest(F.col("mean") - F.col("min"), F.col("max") - F.col("mean"))
    return null_safe_join(moment_summary(df, cols, keys), fences, [*keys, "channel"]).select(
        *keys, "channel", F.col("n").alias("count"), "min", "max", "mean", "std",
        F.when(F.col("std") > 0, reach / F.col("std")).alias("max_z"),
        F.col("low").alias("iqr_low"), F.col("high").alias("iqr_high"),
    )
