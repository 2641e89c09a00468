"""Scalar column expressions; all of them stay inside whole-stage codegen."""

from pyspark.sql import Column, functions as F

from skywell.schema import SENTINEL

NUMBER_PATTERN = r"(-?\d+(?:\.\d+)?)"  # fixed value: the first numeric token of a text


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def count_where(condition: Column) -> Column:
    """Rows that meet a condition.

    `count_if` would name each condition in a projection of its own, and the optimizer then
    restates a score over k such conditions in 2^k ways.
    """
    return F.count(F.when(condition, F.lit(1)))


def parse_locale_number(c) -> Column:
    """Text with a decimal comma to double; the first numeric token, or NULL."""
    token = F.regexp_extract(F.replace(as_col(c).cast("string"), F.lit(","), F.lit(".")), NUMBER_PATTERN, 1)
    return token.try_cast("double")


def null_sentinel(c, sentinel: float = SENTINEL) -> Column:
    """The missing-value marker to NULL."""
    return F.when(as_col(c) != sentinel, as_col(c))


def weekday(ts) -> Column:
    """Monday is 0."""
    return F.weekday(as_col(ts))


def season(month) -> Column:
    """Meteorological season of a month number."""
    m = as_col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .when(m.isNotNull(), "Autumn")
    )


def comfort_index(temperature, humidity) -> Column:
    """100 at 22 degrees and 50 % humidity, falling off linearly."""
    warm = F.lit(1.0) - F.abs(as_col(temperature) - 22.0) / 30.0
    damp = F.lit(1.0) - F.abs(as_col(humidity) - 50.0) / 50.0
    return (warm * 0.6 + damp * 0.4) * 100.0


def cyclic(part, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = as_col(part) * (F.lit(2.0) * F.pi()) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def outside(c, low, high) -> Column:
    """True when a value lies outside a closed range; NULL counts as inside."""
    v = as_col(c)
    tests = ([v < low] if low is not None else []) + ([v > high] if high is not None else [])
    hit = F.lit(False)
    for t in tests:
        hit = hit | F.coalesce(t, F.lit(False))
    return hit


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {})".format(ts))


def from_epoch(seconds) -> Column:
    """The zone-less timestamp of whole seconds since 1970."""
    return F.expr(f"timestampadd(SECOND, {seconds}, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
