"""Month-on-month movement and the materiality of unallocated cost.

Both are described by the costing design and not part of its stored procedures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import safe_ratio
from costweave.schemas import MONEY, POOL_AMOUNT, RUN, TOTAL


def monthly_variance(costs: DataFrame, by: list[str]) -> DataFrame:
    """Cost, activity and unit cost per month with the change on the month before.

    Material when the cost moved by at least the dollar and the share threshold.
    The window runs over monthly totals, never over encounters.
    """
    monthly = costs.groupBy(RUN, *by, "reporting_month").agg(
        F.sum("total_patient_cost").cast(POOL_AMOUNT).alias("total_cost"),
        F.count(F.lit(1)).alias("encounter_count"),
    )
    w = Window.partitionBy(RUN, *by).orderBy("reporting_month")
    follows = F.lag("reporting_month").over(w) == F.add_months("reporting_month", -1)

    def before(c: str) -> Column:
        return F.when(follows, F.lag(c).over(w))

    change = F.col("total_cost") - F.col("prior_cost")
    share = safe_ratio("cost_change", "prior_cost")
    material = (F.abs("cost_change") >= F.lit(K.MATERIAL_AMOUNT)) & (
        F.abs("cost_change_share") >= F.lit(K.MATERIAL_SHARE)
    )
    return (
        monthly.withColumn(
            "unit_cost", (F.col("total_cost") / F.col("encounter_count")).cast(MONEY)
        )
        .withColumns(
            {
                "prior_cost": before("total_cost"),
                "prior_count": before("encounter_count"),
                "prior_unit_cost": before("unit_cost"),
            }
        )
        .withColumn("cost_change", change.cast(POOL_AMOUNT))
        .withColumn("cost_change_share", share)
        .withColumn("count_change", F.col("encounter_count") - F.col("prior_count"))
        .withColumn(
            "unit_cost_change", (F.col("unit_cost") - F.col("prior_unit_cost")).cast(MONEY)
        )
        .withColumn("material_flag", F.when(material, "Y").otherwise("N"))
    )


def unallocated_materiality(unallocated: DataFrame, monthly_ledger: DataFrame) -> DataFrame:
    """Level per month and reason: the higher of the dollar and the share test."""
    amounts = unallocated.groupBy(RUN, "reporting_month", "unallocated_reason").agg(
        F.sum("unallocated_amount").cast(TOTAL).alias("unallocated_amount")
    )
    size = F.abs("unallocated_amount")
    share = F.abs(F.col("ledger_share"))

    def rank(value: Column, position: int) -> Column:
        result = F.lit(0)
        for level, limits in enumerate(K.UNALLOCATED_LEVELS, start=1):
            result = F.when(value >= F.lit(limits[position]), level).otherwise(result)
        return result

    labels = F.array(*[F.lit(v) for v in ("Low", *[level[0] for level in K.UNALLOCATED_LEVELS])])
    return (
        amounts.join(monthly_ledger, [RUN, "reporting_month"], "left")
        .withColumn(
            "ledger_share",
            safe_ratio(*[F.col(c).cast(POOL_AMOUNT) for c in ("unallocated_amount", "signed_gl_total")]),
        )
        .withColumn(
            "materiality",
            F.element_at(
                labels,
                F.greatest(rank(size, 1), F.coalesce(rank(share, 2), F.lit(0))) + 1,
            ),
        )
    )
