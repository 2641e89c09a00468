"""The batch body of the ingest job: messages in, clean and excluded rows out."""

from pyspark.sql import DataFrame, functions as F

from skywell.operators.clean import (
    exclusion_details, impute, in_ranges, only, range_exclusion, type_columns,
)
from skywell.operators.derive import add_derived
from skywell.operators.quality import with_quality_score
from skywell.schema import CLEAN_RANGES, DERIVED_COLUMNS, FLAT_COLUMNS


def judge(typed: DataFrame, scope, order, widths, ranges=CLEAN_RANGES) -> tuple[DataFrame, DataFrame]:
    """Impute and range-check typed messages: rows to keep, and rows with a reason.

    Unusable rows leave before imputation; range checks see imputed values.
    """
    reason = F.col("exclusion_reason")
    filled = impute(only(typed, reason.isNull()).drop("exclusion_reason"), scope, order, widths)
    # A filter, as nothing is joined here: it reads sensors of a row only as long as they are all missing.
    refused = typed.filter(reason.isNotNull()).unionByName(
        only(filled.withColumn("exclusion_reason", range_exclusion(ranges)), reason.isNotNull())
    )
    kept = only(filled, in_ranges(ranges))
    return kept, refused.withColumn("exclusion_details", exclusion_details("exclusion_reason", ranges))


def process_batch(flat: DataFrame, scope, order, widths, ranges=CLEAN_RANGES) -> tuple[DataFrame, DataFrame]:
    """The clean table's rows, derived and scored, and the quarantined rows."""
    return process_typed(type_columns(flat), scope, order, widths, ranges)


def process_typed(typed: DataFrame, scope, order, widths, ranges=CLEAN_RANGES) -> tuple[DataFrame, DataFrame]:
    """`process_batch` of what `type_columns` gave, which is read more than once."""
    kept, refused = judge(typed, scope, order, widths, ranges)
    extra = [c for c in typed.columns if c not in [*FLAT_COLUMNS, "exclusion_reason"]]
    clean = with_quality_score(add_derived(kept, "timestamp", scope, bounded=not widths), ignore=extra)
    return (
        clean.select(*extra, *FLAT_COLUMNS, *DERIVED_COLUMNS, "quality_score"),
        refused.select(*extra, *FLAT_COLUMNS, "exclusion_reason", "exclusion_details"),
    )
