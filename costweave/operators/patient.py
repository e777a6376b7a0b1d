"""Patient-level cost and the high-cost comparison within cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import zero_if_null
from costweave.operators.allocate import driver_rates, pool_rates
from costweave.operators.drivers import DRIVER_KEY, driver_totals, pre_overhead_drivers
from costweave.operators.percentiles import group_percentile
from costweave.schemas import MONEY, RUN, TOTAL
from costweave.session import lookup

EPISODE_MONTH, ALL_MONTHS = "episode_month", "all_months"
COHORT = ["care_type", "activity_group_code"]


def cost_base(
    encounters: DataFrame,
    direct: DataFrame,
    indirect: DataFrame,
    attribution: str = EPISODE_MONTH,
) -> DataFrame:
    """Encounters with direct and indirect cost before overhead.

    ``direct`` and ``indirect`` are sums per encounter and month. With
    ``episode_month`` only the month of the episode counts, so a stay's later
    months stay out (``attribution_gap`` reports them); ``all_months`` adds them.
    """
    keys = [RUN, "encounter_id"]
    if attribution == EPISODE_MONTH:
        keys.append("reporting_month")
    elif attribution == ALL_MONTHS:
        direct = direct.groupBy(*keys).agg(F.sum("assigned_amount").alias("assigned_amount"))
        indirect = indirect.groupBy(*keys).agg(
            F.sum("allocated_amount").alias("allocated_amount")
        )
    else:
        raise ValueError(f"unknown attribution {attribution!r}")
    direct_cost = zero_if_null("assigned_amount").cast(MONEY)
    indirect_cost = zero_if_null("allocated_amount").cast(MONEY)
    return (
        encounters.withColumnRenamed("episode_month", "reporting_month")
        .join(direct.select(*keys, "assigned_amount"), keys, "left")
        .join(indirect.select(*keys, "allocated_amount"), keys, "left")
        .withColumns(
            {"direct_cost_amount": direct_cost, "indirect_cost_amount": indirect_cost}
        )
        .withColumn(
            "pre_overhead_cost",
            (F.col("direct_cost_amount") + F.col("indirect_cost_amount")).cast(MONEY),
        )
        .drop("assigned_amount", "allocated_amount")
    )


def overhead_rates(pools: DataFrame, base: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """Overhead pools priced per dollar of pre-overhead cost. ``base`` is stored."""
    keys = [*DRIVER_KEY, *apart]
    return pool_rates(pools, driver_totals(pre_overhead_drivers(base, apart), keys), K.OVERHEAD, keys)


def patient_level_cost(base: DataFrame, rates: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """One row per encounter with direct, indirect, overhead and total cost.

    ``rates`` is the staged result of ``overhead_rates``. Every encounter has one
    overhead driver, so pricing it here replaces an allocation table, its
    shuffle and the join back.
    """
    overhead_driver = (F.col("cost_pool_code") == K.OVERHEAD_POOL) & (
        F.col("allocation_driver") == K.OVERHEAD_DRIVER
    )
    keys = [RUN, "reporting_month", *apart]
    monthly = driver_rates(rates.filter(overhead_driver), keys)
    # months without overhead are kept by an outer join, months are few by nature
    priced = base.join(lookup(monthly), keys, "left")
    overhead = F.when(
        F.col("pre_overhead_cost") > 0, F.col("pre_overhead_cost") * F.col("allocation_rate")
    )
    return (
        priced.withColumn("overhead_cost_amount", zero_if_null(overhead.cast(MONEY)))
        .withColumn(
            "total_patient_cost",
            (F.col("pre_overhead_cost") + F.col("overhead_cost_amount")).cast(MONEY),
        )
        .withColumn("cost_status", F.lit("FINAL"))
        .drop("allocation_rate", "pre_overhead_cost")
    )


def flag_high_cost(
    costs: DataFrame,
    p: float = K.HIGH_COST_PERCENTILE,
    min_cohort: int = K.MIN_COHORT,
) -> DataFrame:
    """Flag encounters at or above the cohort percentile. ``costs`` is stored."""
    limits = group_percentile(costs, [RUN, *COHORT], "total_patient_cost", p, "p")
    stable = F.col("cohort_count") >= min_cohort
    high = F.col("total_patient_cost").cast("double") >= F.col("p")
    note = (
        F.when(~stable, K.NOTE_SMALL_COHORT.format(n=min_cohort))
        .when(
            high,
            F.concat(
                F.lit(K.NOTE_HIGH_COST),
                F.col("cohort_count").cast("string"),
                F.lit("; p95="),
                F.col("p").cast("decimal(19,2)").cast("string"),
            ),
        )
    )
    return (
        costs.join(limits, [RUN, *COHORT], "left")
        .withColumn("high_cost_flag", F.when(stable & high, "Y").otherwise("N"))
        .withColumn("review_note", note)
        .drop("cohort_count", "p")
    )


def attribution_gap(indirect: DataFrame, costs: DataFrame) -> DataFrame:
    """Allocated cost per run that the patient rows do and do not carry."""
    allocated = indirect.groupBy(RUN).agg(
        F.sum("allocated_amount").cast(TOTAL).alias("allocated_amount")
    )
    carried = costs.groupBy(RUN).agg(
        F.sum("indirect_cost_amount").cast(TOTAL).alias("attributed_amount")
    )
    return allocated.join(carried, RUN, "left").withColumn(
        "unattributed_amount",
        (F.col("allocated_amount") - zero_if_null("attributed_amount")).cast(TOTAL),
    )


def high_cost_summary(costs: DataFrame) -> DataFrame:
    """Encounters and cost per flag."""
    return costs.groupBy(RUN, "high_cost_flag").agg(
        F.count(F.lit(1)).alias("encounter_count"),
        F.sum("total_patient_cost").cast(TOTAL).alias("total_patient_cost"),
    )


def most_expensive(costs: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` dearest flagged encounters; ties broken by encounter id."""
    return (
        costs.filter(F.col("high_cost_flag") == "Y")
        .orderBy(F.desc("total_patient_cost"), "encounter_id")
        .limit(k)
        .select(
            "encounter_id", *COHORT, "total_patient_cost", "high_cost_flag", "review_note"
        )
    )
