"""Imputation and the regular time grid."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skywell.functions.attach import attach
from skywell.functions.quantiles import exact_quantiles
from skywell.functions.scalars import epoch_seconds, from_epoch
from skywell.operators.ordered import HOUR, POSITION, SERIES_WIDTHS, FirstAfter, LastBefore, running
from skywell.session import settle


def dedupe_time(df: DataFrame, keys, ts: str, tiebreak: str) -> DataFrame:
    """One row per `(keys, ts)`, the one with the smallest tiebreak."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in [*keys, ts]]
    return (
        df.groupBy(*keys, ts)
        .agg(F.min_by(F.struct(*rest), F.col(tiebreak)).alias("_row"))
        .select(*keys, ts, "_row.*")
        .select(*df.columns)
    )


def ffill(df: DataFrame, cols, keys, order, widths) -> DataFrame:
    """Carry the last known value forward; `widths` as in `running`, `()` only for bounded groups."""
    found = running(df, keys, order, {f"_last_{c}": LastBefore(F.col(c)) for c in cols}, widths, gaps=True)
    return found.withColumns({c: F.coalesce(F.col(c), F.col(f"_last_{c}")) for c in cols}).drop(
        POSITION, *[f"_last_{c}" for c in cols]
    )


def fill_mean(df: DataFrame, cols, keys, bounded: bool = False) -> DataFrame:
    """The group's mean for what is still missing.

    `bounded` groups (micro-batches) are averaged in a window, which shares the partitioning of
    the fill before it; others by a map-side combined aggregation.
    """
    if bounded:
        own = W.partitionBy(*keys)
        return df.withColumns({c: F.coalesce(F.col(c), F.avg(c).over(own)) for c in cols})
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])
    return attach(df, means, keys, "_mean").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_mean.{c}")) for c in cols}
    ).drop("_mean")


def neighbours(cols, located: bool, at: Column | None = None) -> dict:
    """What `running` must find to interpolate: the known value before and after each row."""

    def known(c):
        v = F.col(c).cast("double")
        return v if located else F.when(v.isNotNull(), F.struct(v.alias("v"), at.alias("at")))

    return {f"_p_{c}": LastBefore(known(c), located) for c in cols} | {
        f"_n_{c}": FirstAfter(known(c), located) for c in cols
    }


def between(before: Column, after: Column, at: Column, reach: int | None) -> Column:
    """The line through two known points at `at`; level after the last one, NULL before the first.

    `reach` is how far past the known point before it a gap is filled.
    """
    share = (at - before["at"]) / (after["at"] - before["at"])
    value = F.when(after["at"].isNull(), before["v"]).otherwise(before["v"] + (after["v"] - before["v"]) * share)
    return value if reach is None else F.when((at - before["at"]) <= reach, value)


def interpolate(
    df: DataFrame, cols, keys, order, by: str = "time", limit: int | None = None, step: int = HOUR, *, widths,
) -> DataFrame:
    """Linear interpolation between known neighbours, by row position or by time.

    Leading gaps stay; trailing gaps repeat the last value. `limit` fills only the first rows
    of each gap; with `by="time"` it counts grid steps, so rows must lie on a regular grid. `widths`
    as in `running`, `()` only for bounded groups.
    """
    if by not in ("row", "time"):
        raise ValueError("by must be 'row' or 'time'")
    rows = by == "row"
    at = F.col(POSITION) if rows else epoch_seconds(order)
    reach = None if limit is None else limit * (1 if rows else step)
    found = running(df, keys, order, neighbours(cols, rows, None if rows else at), widths, gaps=True)
    return found.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), between(F.col(f"_p_{c}"), F.col(f"_n_{c}"), at, reach)) for c in cols}
    ).drop(POSITION, *[f"_p_{c}" for c in cols], *[f"_n_{c}" for c in cols])


def regular_grid(
    df: DataFrame, cols, keys, ts: str, step: int = HOUR, widths=SERIES_WIDTHS, fill: int = 0
) -> DataFrame:
    """C4: one row per step from each series' first to last time; off-grid rows are dropped.

    Each present row also emits the missing steps up to its successor, so no grid is joined
    and no series is expanded in one task. `fill` interpolates the first steps of each gap in
    the same pass (C5): the known neighbours of a missing step are those of the row emitting it.
    """
    keys = list(keys)
    first = df.groupBy(*keys).agg(F.min(ts).alias("t0"))
    on_grid = (
        attach(df.select(*keys, ts, *cols), first, keys, "_first")
        .withColumn("_t", epoch_seconds(ts))
        .filter((F.col("_t") - epoch_seconds("_first.t0")) % step == 0)
        .drop("_first")
    )
    wanted = neighbours(cols, False, F.col("_t")) if fill else {}
    found = running(on_grid, keys, ts, {"_next": FirstAfter(F.col("_t")), **wanted}, widths)
    last_step = F.coalesce(F.col("_next") - step, F.col("_t"))
    rows = found.withColumn("_s", F.explode(F.sequence(F.col("_t"), last_step, F.lit(step).cast("bigint"))))
    here = F.col("_s") == F.col("_t")

    def value(c):
        own = F.when(here, F.col(c))
        if not fill:
            return own
        v = F.col(c).cast("double")
        mine = F.when(v.isNotNull(), F.struct(v.alias("v"), F.col("_t").alias("at")))
        before = F.coalesce(mine, F.col(f"_p_{c}"))
        return F.coalesce(own, between(before, F.col(f"_n_{c}"), F.col("_s"), fill * step))

    return rows.select(*keys, from_epoch("_s").alias(ts), *[value(c).alias(c) for c in cols])


def seasonal_fill(df: DataFrame, cols, keys, ts: str, k: float = 1.5, fit: DataFrame | None = None) -> DataFrame:
    """Fill with the hour-of-day mean held within k standard deviations, then the median.

    `fit` is the part the means are learnt from (default: `df` itself).
    """
    keys = list(keys)
    source = df if fit is None else fit
    by_hour = source.groupBy(*keys, F.hour(ts).alias("_hour")).agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]
    )
    medians = (
        exact_quantiles(source, cols, [0.5], keys)
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("channel") == c, F.col("q")[0])).alias(c) for c in cols])
    )
    rows = attach(df.withColumn("_hour", F.hour(ts)), by_hour, [*keys, "_hour"], "_h")
    rows = attach(rows, medians, keys, "_med")

    def filled(c):
        mean, dev = F.col(f"_h.m_{c}"), F.col(f"_h.s_{c}")
        banded = F.least(F.greatest(mean, mean - k * dev), mean + k * dev)
        return F.coalesce(F.col(c), banded, F.col(f"_med.{c}"))

    return rows.withColumns({c: filled(c) for c in cols}).drop("_hour", "_h", "_med")


def load_series(df: DataFrame, cols, keys, ts: str, tiebreak: str, fit=None, widths=SERIES_WIDTHS) -> DataFrame:
    """A13 with B8 and C4-C7: a dense hourly series ready for feature building.

    `fit` narrows the gridded series to the part that seasonal means may be learnt from. The
    deduplicated and the gridded series are written once to the checkpoint folder, since each
    later step reads them more than once; both are far smaller than the raw readings.
    """
    once = settle(dedupe_time(df.filter(F.col(ts).isNotNull()), keys, ts, tiebreak))
    dense = settle(regular_grid(once, cols, keys, ts, widths=widths, fill=3))
    return seasonal_fill(dense, cols, keys, ts, fit=None if fit is None else fit(dense))
