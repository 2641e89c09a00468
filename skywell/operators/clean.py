"""Flattening, typing, quarantine and imputation of sensor messages."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skywell.functions.attach import melt
from skywell.functions.scalars import count_where, null_sentinel, outside, parse_locale_number
from skywell.operators.grid import between, fill_mean, neighbours
from skywell.operators.ordered import POSITION, LastBefore, running
from skywell.schema import AVERAGED, CARRIED, CLEAN_RANGES, INTERPOLATED, SENSORS, SENTINEL, VIEW_RANGES


def flatten_messages(df: DataFrame) -> DataFrame:
    """B1: nested message to 18 flat columns; any other top-level column is kept."""
    nested = {"timestamp", "date", "time", "sensor_data", "metadata"}
    return df.select(
        *[c for c in df.columns if c not in nested],
        "timestamp", "date", "time", "sensor_data.*", "metadata.source", "metadata.simulation",
    )


def time_exclusion(ts: str) -> Column:
    """Why a text timestamp cannot be used, or NULL."""
    text = F.trim(F.col(ts))
    date_only = (F.length(text) == 10) & (F.length(F.replace(text, F.lit("-"))) == 8)
    return F.when(date_only, "timestamp_incomplete").when(
        text.try_cast("timestamp_ntz").isNull(), "timestamp_invalid"
    )


def type_columns(df: DataFrame) -> DataFrame:
    """Typed columns, with `exclusion_reason` set where the row cannot be used at all.

    Sentinels become NULL. A row whose sensors are all sentinels is `completely_empty`.
    """
    raw = df.withColumns({"exclusion_reason": time_exclusion("timestamp"), **{c: parse_locale_number(c) for c in SENSORS}})
    empty = reduce(lambda a, b: a & b, [F.coalesce(F.col(c) == SENTINEL, F.lit(False)) for c in SENSORS])
    return raw.withColumn(
        "exclusion_reason", F.coalesce(F.col("exclusion_reason"), F.when(empty, "completely_empty"))
    ).withColumns({"timestamp": F.trim("timestamp").try_cast("timestamp_ntz"), **{c: null_sentinel(c) for c in SENSORS}})


def only(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet a condition over many columns.

    Each row emits itself or nothing. A filter would do the same, but the optimizer then restates
    a condition over k renamed columns in 2^k ways when the result is joined.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*df.columns)))))


def in_ranges(ranges=CLEAN_RANGES) -> Column:
    """True when no value leaves its range; one test per column, so each can be pushed down."""
    return reduce(lambda a, b: a & b, [~outside(c, low, high) for c, (low, high) in ranges.items()])


def count_sentinels(df: DataFrame, sentinel: float = SENTINEL) -> DataFrame:
    """Cells that hold the missing-value marker."""
    cells = reduce(lambda a, b: a + b, [count_where(F.col(c) == sentinel) for c in SENSORS])
    return df.agg(cells.alias("sentinel_cells"))


def range_text(low, high) -> str:
    # Fixed value: the notation of the quarantine details.
    return f"[{'−∞' if low is None else low}, " + ("∞)" if high is None else f"{high}]")


def range_exclusion(ranges=CLEAN_RANGES) -> Column:
    """The first column whose value leaves its range, or NULL."""
    return F.coalesce(
        *[F.when(outside(c, low, high), f"{c}_out_of_range") for c, (low, high) in ranges.items()]
    )


def exclusion_details(reason: str, ranges=CLEAN_RANGES) -> Column:
    # The texts stored next to each exclusion reason.
    texts = {
        "timestamp_incomplete": "Timestamp missing time component (YYYY-MM-DD)",
        "timestamp_invalid": "Unparseable timestamp format",
        "completely_empty": "All values are missing sentinel values",
        **{
            f"{c}_out_of_range": f"{c} outside range {range_text(low, high)}"
            for c, (low, high) in ranges.items()
        },
    }
    out = F.lit(None).cast("string")
    for name, text in texts.items():
        out = F.when(F.col(reason) == name, text).otherwise(out)
    return out


def impute(df: DataFrame, scope, order, widths) -> DataFrame:
    """C1-C3 by column group, from one ordered pass. `scope` bounds what a fill may see: a series, or a micro-batch.

    `widths` are the buckets a long series is cut into; `()` only where a scope is a bounded micro-batch.
    """
    scope = list(scope)
    wanted = {f"_last_{c}": LastBefore(F.col(c)) for c in CARRIED} | neighbours(INTERPOLATED, located=True)
    found = running(df, scope, order, wanted, widths, gaps=True)
    filled = found.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_last_{c}")) for c in CARRIED}
        | {
            c: F.coalesce(F.col(c), between(F.col(f"_p_{c}"), F.col(f"_n_{c}"), F.col(POSITION), None))
            for c in INTERPOLATED
        }
    ).drop(POSITION, *wanted)
    return fill_mean(filled, CARRIED + INTERPOLATED + AVERAGED, scope, bounded=not widths)


def classify_exclusions(df: DataFrame, ranges=CLEAN_RANGES) -> DataFrame:
    """B2-B7 on flat messages without imputation: every row with its reason and details."""
    typed = type_columns(df)
    return typed.withColumn(
        "exclusion_reason", F.coalesce(F.col("exclusion_reason"), range_exclusion(ranges))
    ).withColumn("exclusion_details", exclusion_details("exclusion_reason", ranges))


def exclusion_summary(classified: DataFrame) -> DataFrame:
    """Excluded rows per reason and their share of all rows."""
    counts = classified.groupBy("exclusion_reason").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())  # over a dozen reasons, not over rows
    return counts.withColumn("rate", F.col("n") / total).filter(F.col("exclusion_reason").isNotNull())


def filter_last(df: DataFrame, ts: str, span: str | None) -> DataFrame:
    """Rows within `span` (such as '7 days') of the latest time, both ends included.

    The bound is computed inside the subquery, so the scan receives it as a plain literal.
    """
    present = df.filter(F.col(ts).isNotNull())
    if span is None:
        return present
    return present.filter(F.col(ts) >= df.agg(F.max(ts) - F.expr(f"INTERVAL {span}")).scalar())


def filter_view(df: DataFrame, ts: str, label: str) -> DataFrame:
    """B10 by the name of an exploratory view; an unknown name is refused."""
    days = VIEW_RANGES[label]
    return filter_last(df, ts, None if days is None else f"{days} DAYS")


def align_columns(df: DataFrame, names: list[str], dtype: str = "double") -> DataFrame:
    """Exactly these columns, in this order; absent ones are NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(dtype).alias(c) for c in names])


def long_series(df: DataFrame, cols, ts: str, keys=()) -> DataFrame:
    """One row per time and channel."""
    return melt(df, cols, lambda c: [F.col(c).cast("double").alias("value")], [*keys, ts])
