"""Range, consistency and completeness checks, row scores and batch verdicts."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skywell.functions.scalars import as_col, count_where, outside
from skywell.schema import VALID_RANGES


def _sum(parts) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


# Names and descriptions of the consistency checks.
CONSISTENCY = {
    "nox_no2_consistency": ("NOx should be >= NO2", lambda: F.col("nox_gt") < F.col("no2_gt")),
    "temp_humidity_consistency": (
        "Very low temperature with high humidity",
        lambda: (F.col("temperature") < 0) & (F.col("relative_humidity") > 90),
    ),
    "all_parameters_zero": (
        "All air quality parameters are zero",
        lambda: (F.col("co_gt") == 0) & (F.col("nox_gt") == 0) & (F.col("c6h6_gt") == 0),
    ),
}


def range_profile(df: DataFrame, rules=VALID_RANGES, by=()) -> DataFrame:
    """Per column, values below and above its range, and its extremes; one pass."""
    wide = df.groupBy(*by).agg(
        *[
            F.struct(
                count_where(F.col(c) < low).alias("below_min"),
                count_where(F.col(c) > high).alias("above_max"),
                F.min(c).alias("min_value"),
                F.max(c).alias("max_value"),
            ).alias(c)
            for c, (low, high) in rules.items()
        ]
    )
    entries = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(f"{c}.*")) for c in rules])
    return wide.select(*by, F.inline(entries)).withColumn(
        "total_violations", F.col("below_min") + F.col("above_max")
    )


def consistency_profile(df: DataFrame, by=()) -> DataFrame:
    """Rows that fail each cross-field check; checks without failures are not listed."""
    wide = df.groupBy(*by).agg(*[count_where(test()).alias(n) for n, (_, test) in CONSISTENCY.items()])
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.lit(text).alias("description"), F.col(n).alias("violations"))
            for n, (text, _) in CONSISTENCY.items()
        ]
    )
    return wide.select(*by, F.inline(entries)).filter("violations > 0")


def completeness(df: DataFrame, columns=None, by=()) -> DataFrame:
    """Share of non-null cells."""
    columns = columns or [c for c in df.columns if c not in by]
    return (
        df.groupBy(*by)
        .agg(_sum([count_where(F.col(c).isNull()) for c in columns]).alias("missing_cells"),
             (F.count("*") * len(columns)).alias("total_cells"))
        .withColumn(
            "score",
            F.when(F.col("total_cells") > 0, (F.col("total_cells") - F.col("missing_cells")) / F.col("total_cells"))
            .otherwise(0.0),
        )
    )


def quality_score(columns, rules=VALID_RANGES) -> Column:
    """1 less penalties for missing cells, range violations and NOx below NO2."""
    missing = _sum([as_col(c).isNull().cast("int") for c in columns]) / F.lit(len(columns)) * 0.3
    score = F.lit(1.0) - missing
    for c, (low, high) in rules.items():
        score = score - outside(c, low, high).cast("int") * 0.2
    score = score - _flag(F.col("nox_gt") < F.col("no2_gt")) * 0.1
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def with_quality_score(df: DataFrame, ignore=(), rules=VALID_RANGES) -> DataFrame:
    """E4 over all columns of the table except bookkeeping ones."""
    return df.withColumn("quality_score", quality_score([c for c in df.columns if c not in ignore], rules))


def _distribution(score: Column) -> dict[str, Column]:
    # Class limits of the quality score.
    return {
        "excellent": count_where(score >= 0.9),
        "good": count_where((score >= 0.7) & (score < 0.9)),
        "fair": count_where((score >= 0.5) & (score < 0.7)),
        "poor": count_where(score < 0.5),
    }


def quality_distribution(df: DataFrame, by=()) -> DataFrame:
    """E5."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _distribution(F.col("quality_score")).items()])


def verdict(scored, rules=VALID_RANGES) -> list[Column]:
    """E6 as aggregates: counts of records and violations, completeness over the columns `scored`, mean score and its classes."""
    missing = _sum([count_where(F.col(c).isNull()) for c in scored])
    cells = F.count("*") * len(scored)
    score = F.col("quality_score")
    return [
        F.count("*").alias("total_records"),
        count_where(score >= 0.7).alias("valid_records"),
        _sum(
            [count_where(F.col(c) < low) + count_where(F.col(c) > high) for c, (low, high) in rules.items()]
        ).alias("range_violations"),
        _sum([(count_where(test()) > 0).cast("int") for _, test in CONSISTENCY.values()]).cast("bigint")
        .alias("consistency_violations"),
        F.when(F.count("*") > 0, (cells - missing) / cells).otherwise(0.0).alias("completeness_score"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("average_quality_score"),
        *[c.alias(n) for n, c in _distribution(score).items()],
    ]


def scored_columns(df: DataFrame, ignore=()) -> list[str]:
    return [c for c in df.columns if c not in [*ignore, "quality_score"]]


def validate(df: DataFrame, by=(), ignore=(), rules=VALID_RANGES) -> DataFrame:
    """One verdict row per group from one aggregation; an empty table gives zeros.

    `df` must carry `quality_score`; completeness covers the columns that were scored.
    """
    violations = F.struct(
        *[
            F.struct(
                count_where(F.col(c) < low).alias("below_min"),
                count_where(F.col(c) > high).alias("above_max"),
                F.min(c).alias("min_value"),
                F.max(c).alias("max_value"),
            ).alias(c)
            for c, (low, high) in rules.items()
        ]
    )
    return df.groupBy(*by).agg(*verdict(scored_columns(df, [*by, *ignore]), rules), violations.alias("range_details"))
