"""Trip cleaning (D-1) and its audit (D-2).

Rules, in this order: drop exact duplicate rows; drop rows with a
non-positive distance or fare; canonical payment label; missing discount -> 0;
flag trips without a driver.

Fixed values: audit step names as in the reference:
  1 Remove exact duplicate rows
  2 Remove invalid fare or distance
  3 Standardize payment method labels
  4 Impute missing discounts
  5 Flag unknown drivers
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import rules as RU

# The action text of each step.
AUDIT_ACTIONS = (
    "Dropped duplicate records after retaining the first occurrence.",
    "Dropped records with distance_km <= 0 or fare <= 0; neither value can be inferred reliably.",
    "Converted lowercase 'upi' to the canonical category 'UPI'.",
    "Filled missing discount with 0.0 because discounts are monetary adjustments and no discount is the conservative default.",
    "Retained trips with a missing driver_id for demand/customer analysis and added is_driver_linked; "
    "exclude these rows from driver-level analysis.",
)
AUDIT_STEPS = (
    "Remove exact duplicate rows",
    "Remove invalid fare or distance",
    "Standardize payment method labels",
    "Impute missing discounts",
    "Flag unknown drivers",
)


def invalid_measure(cols: Sequence[str], null_policy: str = "keep"):
    """Row predicate of the removal rule.  ``keep``: a null measure survives
    (pandas); ``drop``: a null measure is removed (Spark scripts), G-1."""
    if null_policy == "keep":
        return RU.non_positive_any(cols)
    if null_policy == "drop":
        return ~RU.positive_all(cols)
    raise ValueError(f"null_policy must be 'keep' or 'drop', not {null_policy!r}")


def clean_trips(trips: DataFrame, measures: Sequence[str] = ("distance_km", "fare"),
                null_policy: str = "keep", payment_col: str = "payment_method",
                discount_col: str = "discount", driver_col: str = "driver_id",
                flag_col: str = "is_driver_linked") -> DataFrame:
    """Cleaned trips: dedup -> positive filter -> labels -> impute -> flag.

    The duplicate removal hashes all columns (one shuffle); a row copied many
    times collapses in the map-side partial aggregate.  The row filter is
    deterministic, so Catalyst pushes it below the shuffle.
    """
    return clean_distinct(trips.dropDuplicates(), measures, null_policy, payment_col, discount_col,
                          driver_col, flag_col)


MULTIPLICITY = "_m"


def distinct_with_multiplicity(trips: DataFrame) -> DataFrame:
    """Distinct rows plus how often each occurred (column ``_m``): the one
    shuffle that the cleaned trips, the audit and the summary all need."""
    return trips.groupBy(*trips.columns).agg(F.count(F.lit(1)).alias(MULTIPLICITY))


def clean_distinct(distinct: DataFrame, measures: Sequence[str] = ("distance_km", "fare"),
                   null_policy: str = "keep", payment_col: str = "payment_method",
                   discount_col: str = "discount", driver_col: str = "driver_id",
                   flag_col: str = "is_driver_linked") -> DataFrame:
    """The cleaning rules after de-duplication, on a distinct frame (with or
    without the ``_m`` multiplicity column)."""
    d = distinct.drop(MULTIPLICITY) if MULTIPLICITY in distinct.columns else distinct
    keep = RU.positive_or_null(measures) if null_policy == "keep" else ~invalid_measure(measures, null_policy)
    return (d.where(keep)
            .withColumn(payment_col, RU.canonical_label(payment_col, RU.PAYMENT_CANONICAL))
            .withColumn(discount_col, F.coalesce(F.col(discount_col), F.lit(0.0)))
            .withColumn(flag_col, RU.presence_flag(driver_col)))


def _audit_counts(trips: DataFrame, measures, null_policy: str) -> DataFrame:
    """One pass: distinct rows with their multiplicity, then one aggregate of
    every rule counted on the survivors of the earlier rules.  ``trips`` may
    already be the output of ``distinct_with_multiplicity``."""
    distinct = trips if MULTIPLICITY in trips.columns else distinct_with_multiplicity(trips)
    bad = invalid_measure(measures, null_policy)
    ok = ~bad
    return distinct.agg(
        F.sum("_m").cast("bigint").alias("source_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        F.count_if(bad).cast("bigint").alias("invalid_rows"),
        F.count_if(ok & (F.col("payment_method") == F.lit("upi"))).cast("bigint").alias("upi_rows"),
        F.count_if(ok & F.col("discount").isNull()).cast("bigint").alias("missing_discount"),
        F.count_if(ok & F.col("driver_id").isNull()).cast("bigint").alias("missing_driver"),
        F.count_if(ok & F.col("rating").isNull()).cast("bigint").alias("missing_rating"),
        F.count_if(ok & F.col("cancellation_reason").isNull()).cast("bigint").alias("missing_reason"),
    )


def cleaning_summary(trips: DataFrame, measures=("distance_km", "fare"), null_policy: str = "keep") -> DataFrame:
    """The nine summary fields of the cleaning job, one row (D-2, S-10)."""
    c = _audit_counts(trips, measures, null_policy)
    cleaned = F.col("distinct_rows") - F.col("invalid_rows")
    return c.select(
        "source_rows",
        cleaned.alias("cleaned_rows"),
        (F.col("source_rows") - F.col("distinct_rows")).alias("duplicate_rows_removed"),
        F.col("invalid_rows").alias("invalid_fare_or_distance_rows_removed"),
        F.col("upi_rows").alias("payment_labels_standardized"),
        F.col("missing_discount").alias("missing_discounts_imputed"),
        F.col("missing_driver").alias("trips_without_driver_id_flagged"),
        F.col("missing_rating").alias("unrated_trips_retained"),
        F.col("missing_reason").alias("null_cancellation_reasons_retained"),
    )


def cleaning_audit(trips: DataFrame, measures=("distance_km", "fare"), null_policy: str = "keep") -> DataFrame:
    """Per step: affected records and rows remaining (D-2), from one pass."""
    c = _audit_counts(trips, measures, null_policy)
    left_after_dedup = F.col("distinct_rows")
    left_after_filter = F.col("distinct_rows") - F.col("invalid_rows")
    steps = [
        (AUDIT_STEPS[0], F.col("source_rows") - F.col("distinct_rows"), left_after_dedup),
        (AUDIT_STEPS[1], F.col("invalid_rows"), left_after_filter),
        (AUDIT_STEPS[2], F.col("upi_rows"), left_after_filter),
        (AUDIT_STEPS[3], F.col("missing_discount"), left_after_filter),
        (AUDIT_STEPS[4], F.col("missing_driver"), left_after_filter),
    ]
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(name).alias("step"), F.lit(AUDIT_ACTIONS[i]).alias("action"),
                 affected.cast("bigint").alias("affected_records"),
                 remaining.cast("bigint").alias("rows_remaining"))
        for i, (name, affected, remaining) in enumerate(steps)
    ])
    return c.select(F.inline(rows))
