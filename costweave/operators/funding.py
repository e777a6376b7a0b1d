"""Activity-based funding: weighted activity times price, against patient cost."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.schemas import MONEY, RUN, TOTAL, WEIGHT
from costweave.session import lookup

GROUP_COLUMNS = [
    "activity_group_code",
    "service_stream",
    "synthetic_base_weight",
    "high_length_of_stay_trim_days",
    "synthetic_outlier_nwau_per_day",
]


def adjustment_factors(rules: DataFrame) -> dict[str, Decimal]:
    """Factors from the adjustment table over the defaults; text factors are skipped."""
    numeric = rules.select("adjustment_code", F.col("factor").try_cast("decimal(7,6)").alias("f"))
    known = F.col("f").isNotNull() & F.col("adjustment_code").isin(*K.ADJUSTMENT_FACTORS)
    # one row for each known code
    found = numeric.filter(known).groupBy("adjustment_code").agg(F.min("f"), F.max("f")).collect()
    if several := sorted(code for code, low, high in found if low != high):
        raise ValueError(f"adjustment codes with more than one factor: {', '.join(several)}")
    return {**K.ADJUSTMENT_FACTORS, **{code: low for code, low, _ in found}}


def _adjustments() -> dict[str, Column]:
    """When each adjustment applies."""
    return {
        "INDIGENOUS": F.col("indigenous_status") == "Y",
        "REMOTE": F.col("remoteness_area") == "Remote",
        "PAEDIATRIC": (F.col("age_years") < 18) & (F.col("service_stream") == "Admitted acute"),
        "SAME_DAY": (F.col("care_type") == "Same-day") & (F.col("activity_group_code") == "AG04"),
    }


def _factor(factors: Mapping[str, Decimal]) -> Column:
    """Exact product of the factors that apply (scale 24, never rounded here)."""
    product = None
    for code, applies in _adjustments().items():
        one = F.lit(Decimal("1.000000")).cast("decimal(7,6)")
        part = F.when(applies, F.lit(factors[code]).cast("decimal(7,6)")).otherwise(one)
        product = part if product is None else product * part
    return product


def _long_stay_days() -> Column:
    stay, trim = F.col("length_of_stay"), F.col("high_length_of_stay_trim_days")
    return F.greatest(F.lit(0), stay.cast("int") - trim.cast("int"))


def weighted_activity(
    encounters: DataFrame, groups: DataFrame, factors: Mapping[str, Decimal] = K.ADJUSTMENT_FACTORS
) -> DataFrame:
    """Encounters with funding group, exact factor, outlier and unrounded weight."""
    funded = lookup(groups.select(*GROUP_COLUMNS)).withColumn("funded", F.lit(True))
    return (
        encounters.join(funded, "activity_group_code", "left")
        .withColumn("funded", F.col("funded").isNotNull())
        .withColumn("factor", F.when(F.col("funded"), _factor(factors)))
        .withColumn("long_stay_days", F.when(F.col("funded"), _long_stay_days()))
        .withColumn(
            "outlier_nwau", F.col("long_stay_days") * F.col("synthetic_outlier_nwau_per_day")
        )
        .withColumn(
            "nwau", F.col("synthetic_base_weight") * F.col("factor") + F.col("outlier_nwau")
        )
    )


def funding_comparison(
    costs: DataFrame,
    groups: DataFrame,
    price: Decimal = K.BASE_PRICE,
    factors: Mapping[str, Decimal] = K.ADJUSTMENT_FACTORS,
) -> DataFrame:
    """Cost against estimated funding per encounter.

    ``costs`` carries the encounter's clinical attributes, so the join back to
    the encounter table is not needed. Groups without a weight stay in review.
    """
    nwau = F.col("nwau").cast(MONEY)
    amount = (nwau * F.lit(price).cast(MONEY)).cast(MONEY)
    return weighted_activity(costs, groups, factors).select(
        RUN,
        "reporting_month",
        "encounter_id",
        "facility",
        "service_line",
        "care_type",
        "activity_group_code",
        "total_patient_cost",
        "synthetic_base_weight",
        F.col("factor").cast(WEIGHT).alias("synthetic_adjustment_factor"),
        nwau.alias("synthetic_nwau"),
        amount.alias("synthetic_funding_amount"),
        (F.col("total_patient_cost") - amount).cast(MONEY).alias("cost_funding_variance"),
        F.when(F.col("funded"), "FUNDED").otherwise("UNFUNDED_REVIEW").alias("funding_status"),
        F.when(F.col("funded"), K.NOTE_FUNDED).otherwise(K.NOTE_UNFUNDED).alias("review_note"),
    )


def encounter_funding(
    encounters: DataFrame,
    groups: DataFrame,
    price: Decimal = K.BASE_PRICE,
    factors: Mapping[str, Decimal] = K.ADJUSTMENT_FACTORS,
) -> DataFrame:
    """Funding extract per encounter with the adjustments spelled out.

    Funding uses the unrounded weight and is rounded to cents; the comparison
    above prices the weight rounded to six decimals.
    """
    notes = [
        F.when(applies, K.ADJUSTMENT_NOTES[code]) for code, applies in _adjustments().items()
    ]
    long_stay = F.when(
        F.col("long_stay_days") > 0,
        F.concat(
            F.lit("Synthetic long-stay outlier: "),
            F.col("long_stay_days").cast("string"),
            F.lit(" days"),
        ),
    )
    spelled = F.coalesce(
        F.nullif(F.concat_ws("; ", *notes, long_stay), F.lit("")),
        F.lit(K.NOTE_BASE_WEIGHT_ONLY),
    )
    return weighted_activity(encounters, groups, factors).select(
        RUN,
        "encounter_id",
        "episode_month",
        "activity_group_code",
        "service_stream",
        F.col("synthetic_base_weight").alias("base_weight"),
        F.round("factor", 6).cast(WEIGHT).alias("demographic_adjustment_factor"),
        F.round("outlier_nwau", 6).cast(MONEY).alias("long_stay_outlier_nwau"),
        F.round("nwau", 6).cast(MONEY).alias("final_synthetic_nwau"),
        F.lit(price).cast("decimal(19,2)").alias("synthetic_base_price"),
        F.round(F.col("nwau") * F.lit(price).cast("decimal(12,2)"), 2)
        .cast("decimal(19,2)")
        .alias("estimated_synthetic_funding"),
        F.when(F.col("funded"), "CALCULATED").otherwise("UNFUNDED_REVIEW").alias("funding_status"),
        F.when(F.col("funded"), spelled).otherwise(K.NOTE_UNSUPPORTED_GROUP).alias("funding_note"),
    )


def monthly_funding_control(funding: DataFrame) -> DataFrame:
    """Encounters, weighted activity and funding per episode month."""
    calculated = F.col("funding_status") == "CALCULATED"
    funded = F.count(F.when(calculated, 1))
    return funding.groupBy("episode_month").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        funded.alias("funded_encounter_count"),
        (F.count(F.lit(1)) - funded).alias("unfunded_review_count"),
        F.coalesce(F.sum(F.when(calculated, F.col("final_synthetic_nwau"))), F.lit(0))
        .cast(TOTAL)
        .alias("total_synthetic_nwau"),
        F.coalesce(F.sum(F.when(calculated, F.col("estimated_synthetic_funding"))), F.lit(0))
        .cast("decimal(38,2)")
        .alias("total_estimated_synthetic_funding"),
    )


def funding_summary(comparison: DataFrame) -> DataFrame:
    """Totals per funding status."""
    sums = [
        "total_patient_cost",
        "synthetic_nwau",
        "synthetic_funding_amount",
        "cost_funding_variance",
    ]
    return comparison.groupBy(RUN, "funding_status").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        *[F.sum(c).cast(TOTAL).alias(c) for c in sums],
    )
