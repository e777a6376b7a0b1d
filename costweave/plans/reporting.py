"""Reporting layer: star-schema dimensions and facts as lazy frames.

Facts cover every run unless ``run`` is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.functions.columns import count_when, safe_ratio, side_by_side
from costweave.operators.quality import ISSUE_COLUMNS
from costweave.schemas import MONEY, RUN, TOTAL
from costweave.session import lookup


def _of_run(df: DataFrame, run: int | None) -> DataFrame:
    return df if run is None else df.filter(F.col(RUN) == run)


def dim_month(periods: DataFrame) -> DataFrame:
    label = F.concat("financial_year", F.lit(" P"), F.format_string("%02d", F.col("period_number").cast("int")))
    return periods.select(
        "reporting_month",
        "period_start",
        "period_end",
        "financial_year",
        "period_number",
        label.alias("period_label"),
    )


def dim_facility(encounters: DataFrame, run: int | None = None) -> DataFrame:
    return _of_run(encounters, run).select("facility").distinct()


def dim_service_line(service_lines: DataFrame) -> DataFrame:
    return service_lines.select(
        "service_line", F.col("description").alias("service_line_description")
    )


def dim_care_type(care_types: DataFrame) -> DataFrame:
    return care_types.select("care_type", F.col("description").alias("care_type_description"))


def dim_activity_group(groups: DataFrame) -> DataFrame:
    return groups.select(
        "activity_group_code",
        "activity_group_name",
        "default_service_line",
        "default_care_type",
        "official_classification_flag",
    )


def dim_cost_category(pools: DataFrame) -> DataFrame:
    return pools.select("cost_category").filter(F.col("cost_category").isNotNull()).distinct()


CLINICAL = [
    "length_of_stay",
    "age_years",
    "indigenous_status",
    "remoteness_area",
    "high_complexity_flag",
    "hospital_acquired_complication_flag",
]


def fact_patient_cost(
    costs: DataFrame, encounters: DataFrame | None = None, run: int | None = None
) -> DataFrame:
    """Amounts, shares of the total and clinical attributes.

    Cost rows built here already carry the attributes; pass ``encounters`` for
    cost tables that do not.
    """
    facts = _of_run(costs, run)
    if encounters is not None:
        keys = [RUN, "encounter_id"]
        facts = facts.join(encounters.select(*keys, *CLINICAL), keys)
    total = "total_patient_cost"
    return facts.select(
        RUN,
        "reporting_month",
        "encounter_id",
        "facility",
        "service_line",
        "care_type",
        "activity_group_code",
        "direct_cost_amount",
        "indirect_cost_amount",
        "overhead_cost_amount",
        total,
        *[
            safe_ratio(f"{part}_cost_amount", total).alias(f"{part}_cost_share")
            for part in ("direct", "indirect", "overhead")
        ],
        "cost_status",
        "high_cost_flag",
        "review_note",
        *CLINICAL,
    )


def fact_abf_comparison(comparison: DataFrame, run: int | None = None) -> DataFrame:
    return _of_run(comparison, run).withColumn(
        "cost_funding_variance_pct",
        safe_ratio("cost_funding_variance", "synthetic_funding_amount"),
    )


def fact_reconciliation(rows: DataFrame, run: int | None = None) -> DataFrame:
    total = F.col("reconciliation_level") == "TOTAL"
    return _of_run(rows, run).withColumns(
        {
            "reconciliation_difference_pct": safe_ratio("reconciliation_difference", "gl_amount"),
            "reconciliation_level_label": F.when(total, "Total reconciliation").otherwise(
                "Cost-pool reconciliation"
            ),
        }
    )


def fact_data_quality_issue(
    issues: DataFrame, results: DataFrame, rules: DataFrame, run: int | None = None
) -> DataFrame:
    """Issues with their rule and its outcome. Rules and results are few per run."""
    named = lookup(
        rules.select(
            "validation_rule_id", "rule_name", "rule_category", "severity", "blocking_flag"
        )
    )
    status = results.select(RUN, "validation_rule_id", "validation_status")
    return (
        _of_run(issues, run)
        .join(lookup(status), [RUN, "validation_rule_id"])
        .join(named, "validation_rule_id")
        .select(
            *ISSUE_COLUMNS[:2],
            "rule_name",
            "rule_category",
            "severity",
            "blocking_flag",
            "validation_status",
            *ISSUE_COLUMNS[2:],
        )
    )


# --- sanity checks over the facts -------------------------------------------------


def view_counts(patient_cost: DataFrame, comparison: DataFrame) -> DataFrame:
    """Rows and distinct encounters of both encounter facts."""

    def counts(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("encounter_id").alias("distinct_encounters"),
        ).withColumn("view_name", F.lit(name))

    return counts("vw_fact_patient_cost", patient_cost).unionByName(
        counts("vw_fact_abf_comparison", comparison)
    )


def cost_tie_out(patient_cost: DataFrame, comparison: DataFrame) -> DataFrame:
    """Both facts hold the same encounters and the same cost."""
    left = patient_cost.agg(
        F.count(F.lit(1)).alias("patient_cost_rows"),
        F.sum("total_patient_cost").cast(TOTAL).alias("patient_cost_total"),
    )
    right = comparison.agg(
        F.count(F.lit(1)).alias("abf_rows"),
        F.sum("total_patient_cost").cast(TOTAL).alias("abf_patient_cost_total"),
    )
    return side_by_side(left, right).withColumn(
        "difference",
        (F.col("patient_cost_total") - F.col("abf_patient_cost_total")).cast(TOTAL),
    )


def issue_totals(issues: DataFrame) -> DataFrame:
    return issues.agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.sum(F.coalesce("financial_impact", F.lit(0).cast(MONEY)))
        .cast(TOTAL)
        .alias("financial_impact"),
    )


# --- management summaries ------------------------------------------------------------


def service_line_composition(costs: DataFrame) -> DataFrame:
    """Cost parts, their shares and encounters per service line."""
    parts = ["direct_cost_amount", "indirect_cost_amount", "overhead_cost_amount"]
    return (
        costs.groupBy(RUN, "service_line")
        .agg(
            F.count(F.lit(1)).alias("encounter_count"),
            *[F.sum(c).cast(TOTAL).alias(c) for c in [*parts, "total_patient_cost"]],
        )
        .withColumns({c.replace("amount", "share"): safe_ratio(c, "total_patient_cost") for c in parts})
    )


def activity_group_summary(costs: DataFrame) -> DataFrame:
    """Cost, volume and average cost per activity group."""
    return costs.groupBy(RUN, "activity_group_code").agg(
        F.sum("total_patient_cost").cast(TOTAL).alias("total_patient_cost"),
        F.count(F.lit(1)).alias("encounter_count"),
        (F.sum("total_patient_cost") / F.count(F.lit(1))).cast(MONEY).alias("average_cost"),
    )


def high_cost_by_group(costs: DataFrame) -> DataFrame:
    """Flagged encounters and their cost per care type and activity group."""
    flagged = F.col("high_cost_flag") == "Y"
    cost = "total_patient_cost"
    return costs.groupBy(RUN, "care_type", "activity_group_code").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        count_when(flagged).alias("high_cost_count"),
        F.coalesce(F.sum(F.when(flagged, F.col(cost))), F.lit(0)).cast(TOTAL).alias("high_cost_amount"),
    )
