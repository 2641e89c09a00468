"""Ordered work on long series, without one task per series.

A window over `partitionBy(key).orderBy(ts)` puts a whole series in one task. Here a series is
cut into time buckets; each bucket is a group of its own, and what crosses a bucket edge is
carried over a summary with one row per bucket (`running`) or copied in as a halo (`halo`).
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skywell.functions.scalars import epoch_seconds
from skywell.session import settle

HOUR, DAY = 3600, 86_400
# Seconds per bucket, then buckets per second-level bucket.
SERIES_WIDTHS = (30 * DAY, 1000)


def fitted_widths(df: DataFrame, keys, ts: str, rows: int = 250_000, widest: int = 30 * DAY) -> tuple[int, int]:
    """Bucket sizes for raw readings of unknown density: the busiest bucket holds about `rows`.

    Counts per key and hour are combined map-side; only the largest of them returns.
    """
    hours = df.groupBy(*keys, F.floor(epoch_seconds(ts) / HOUR).alias("_hour")).agg(F.count("*").alias("n"))
    busiest = hours.agg(F.max("n")).first()[0] or 1
    return max(1, min(widest, rows * HOUR // busiest)), 1000


@dataclass(frozen=True)
class Before:
    """Sum of `expr` over the rows before this one (0 if none)."""

    expr: Column


@dataclass(frozen=True)
class LastBefore:
    """Last non-null `expr` before this row.

    With `located`, a struct of that value `v` and its row position `at`.
    """

    expr: Column
    located: bool = False


@dataclass(frozen=True)
class FirstAfter:
    """First non-null `expr` after this row; `located` as in `LastBefore`."""

    expr: Column
    located: bool = False


POSITION = "_at"


def order_number(df: DataFrame, order: str) -> Column:
    """The order column as a number: seconds for timestamps, itself otherwise."""
    return epoch_seconds(order) if df.schema[order].dataType.typeName().startswith("timestamp") else F.col(order)


def _found(value: Column, at: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(value.alias("v"), at.alias("at")))


def _moved(located: Column, by: Column) -> Column:
    return F.when(located.isNotNull(), F.struct(located["v"].alias("v"), (located["at"] + by).alias("at")))


def _within(df: DataFrame, keys, order, wanted: dict, weight: Column) -> DataFrame:
    """`running` with one window per key; `wanted` structs are located relative to their row."""
    up = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    down = W.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order]).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn(POSITION, F.coalesce(F.sum(weight).over(up), F.lit(0)))

    def over(w):
        e = _moved(w.expr, F.col(POSITION)) if getattr(w, "located", False) else w.expr
        if isinstance(w, Before):
            return F.coalesce(F.sum(e).over(up), F.lit(0))
        return F.last(e, ignorenulls=True).over(up if isinstance(w, LastBefore) else down)

    return df.withColumns({n: over(w) for n, w in wanted.items()})


def _across(df: DataFrame, keys, order, wanted: dict, widths, weight: Column, gaps: bool = False) -> DataFrame:
    if not widths:
        return _within(df, keys, order, wanted, weight)
    bucket = f"_b{len(widths)}"
    rows = df.withColumn(bucket, F.floor(order_number(df, order[0]) / F.lit(widths[0])))
    inner = _within(rows, [*keys, bucket], order, wanted, weight)
    if gaps:
        inner = settle(inner.withColumns({n: F.when(w.expr.isNull(), F.col(n)) for n, w in wanted.items()}))
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])

    def edge(w):
        if isinstance(w, Before):
            return F.sum(w.expr)
        e = _moved(w.expr, F.col(POSITION)) if w.located else w.expr
        return (F.max_by if isinstance(w, LastBefore) else F.min_by)(e, F.when(w.expr.isNotNull(), place))

    edges = inner.groupBy(*keys, bucket).agg(
        F.sum(weight).alias("_t_n"), *[edge(w).alias(f"_t_{n}") for n, w in wanted.items()]
    )
    edges = settle(edges) if gaps else edges
    upper = {f"_c_{n}": replace(w, expr=F.col(f"_t_{n}")) for n, w in wanted.items()}
    carried = _across(edges, keys, [bucket], upper, widths[1:], F.col("_t_n")).select(
        *keys, bucket, F.col(POSITION).alias("_offset"), *upper
    )

    def merged(n, w):
        if isinstance(w, Before):
            return F.col(n) + F.col(f"_c_{n}")
        own = _moved(F.col(n), F.col("_offset")) if w.located else F.col(n)
        return F.coalesce(own, F.col(f"_c_{n}"))

    return (
        inner.join(carried, [*keys, bucket], "left")
        .withColumns({n: merged(n, w) for n, w in wanted.items()})
        .withColumn(POSITION, F.col(POSITION) + F.col("_offset"))
        .drop(bucket, "_offset", *upper)
    )


def running(df: DataFrame, keys, order, wanted: dict, widths=(), gaps: bool = False) -> DataFrame:
    """Add the `wanted` columns, each reaching any distance back or ahead within the key.

    Also adds `_at`, the row's position within its key. `widths` are the bucket sizes from fine
    to coarse; with none, one window per key is used, which fits keys whose groups are bounded
    (a micro-batch, a bucket). `order` names the column that is bucketed, followed by any
    tie-breaks that make the order unique within a key. With widths, `df` is read twice:
    once for the one-row-per-bucket summary, once for the rows. With `gaps`, what is found is wanted
    only where a row's own value is null: rows are then made and windowed a single time and written, which is cheap, as
    most of them have nothing to find.
    """
    raw = {
        n: replace(w, expr=_found(w.expr, F.lit(0))) if getattr(w, "located", False) else w
        for n, w in wanted.items()
    }
    order = [order] if isinstance(order, str) else list(order)
    # One struct of the keys is never NULL, so bucket edges join by plain equality and the join
    # finds both sides already partitioned.
    # Without buckets nothing is joined, and the keys themselves leave the rows as later windows over them want them.
    own = ["_key"] if keys and widths else list(keys)
    rows = df.withColumn("_key", F.struct(*keys)) if keys and widths else df
    return _across(rows, own, order, raw, tuple(widths), F.lit(1), gaps).select(*df.columns, POSITION, *wanted)


def halo(df: DataFrame, ts: str, back: int, ahead: int, width: int) -> DataFrame:
    """Copy rows within `back` / `ahead` seconds of a bucket edge into the neighbouring bucket.

    Adds `_bucket` and `_core`; a window per `(key, _bucket)` that looks no further than the
    halo is exact on the `_core` rows. The copies are a share of (back + ahead) / width.
    """
    if max(back, ahead) > width:
        raise ValueError("the halo must not be wider than a bucket")
    t = epoch_seconds(ts)
    own = F.floor(t / F.lit(width))
    into_next = F.when((own + 1) * width - t <= back, own + 1)
    into_previous = F.when(t - own * width < ahead, own - 1)
    buckets = F.array_compact(F.array(own, into_next, into_previous))
    return df.withColumn("_bucket", F.explode(buckets)).withColumn("_core", F.col("_bucket") == own)
