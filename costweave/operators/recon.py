"""Reconciliation of the ledger with everything costing did with it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import total_when, zero_if_null
from costweave.operators.pools import POOL_KEY
from costweave.schemas import RUN, TOTAL

PARTS = [
    "direct_assigned_amount",
    "indirect_allocated_amount",
    "overhead_allocated_amount",
    "unallocated_amount",
    "excluded_amount",
]
AMOUNTS = ["gl_amount", *PARTS]
COLUMNS = [
    RUN,
    "reconciliation_level",
    "reporting_month",
    "facility",
    "cost_centre_id",
    "cost_pool_code",
    "cost_category",
    *AMOUNTS,
    "reconciliation_difference",
    "reconciliation_status",
    "review_note",
]
DIRECT_KEY = [RUN, "reporting_month", "cost_centre_id", "natural_account"]


def difference() -> Column:
    result = F.col("gl_amount")
    for part in PARTS:
        result = result - F.col(part)
    return result.cast(TOTAL)


def within(tolerance: Decimal = K.TOLERANCE) -> Column:
    return F.abs("reconciliation_difference") <= F.lit(tolerance)


def _unallocated_parts() -> list[Column]:
    excluded = F.col("resolution_status") == "EXCLUDED"
    amount = "unallocated_amount"
    return [
        total_when(~excluded, amount).alias("unallocated_amount"),
        total_when(excluded, amount).alias("excluded_amount"),
    ]


def direct_by_pool(pools: DataFrame, direct: DataFrame, keys: list[str] = DIRECT_KEY) -> DataFrame:
    """Direct cost per pool. Items are summed first; only totals meet the pools."""
    totals = (
        direct.withColumnRenamed("service_month", "reporting_month")
        .groupBy(*keys)
        .agg(F.sum("assigned_amount").alias("direct_assigned_amount"))
    )
    return pools.select(*POOL_KEY).join(totals, keys).select(*POOL_KEY, "direct_assigned_amount")


def shared_direct_keys(pools: DataFrame, keys: list[str] = DIRECT_KEY) -> DataFrame:
    """Direct keys that more than one pool claims: direct cost counted twice there."""
    return (
        pools.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("pool_count"))
        .filter(F.col("pool_count") > 1)
    )


def reconcile_pools(
    pools: DataFrame,
    direct: DataFrame,
    allocated: DataFrame,
    unallocated: DataFrame,
    tolerance: Decimal = K.TOLERANCE,
    direct_keys: list[str] = DIRECT_KEY,
) -> DataFrame:
    """One row per pool: where its ledger amount went, and PASS within tolerance.

    ``allocated`` holds (pool, treatment, allocated_amount) for both stages. The
    parts are united and grouped once on the pool key instead of joined thrice.
    """
    zero = F.lit(0).cast(TOTAL)

    def part(df: DataFrame, amounts: dict[str, Column]) -> DataFrame:
        return df.select(
            *POOL_KEY, *[amounts.get(c, zero).cast(TOTAL).alias(c) for c in PARTS]
        )

    amount, treatment = F.col("allocated_amount"), F.col("costing_treatment")
    excluded = F.col("resolution_status") == "EXCLUDED"
    open_amount = F.col("unallocated_amount")
    parts = (
        part(
            direct_by_pool(pools, direct, direct_keys),
            {"direct_assigned_amount": F.col("direct_assigned_amount")},
        )
        .unionByName(
            part(
                allocated,
                {
                    "indirect_allocated_amount": F.when(treatment == K.INDIRECT, amount).otherwise(zero),
                    "overhead_allocated_amount": F.when(treatment == K.OVERHEAD, amount).otherwise(zero),
                },
            )
        )
        .unionByName(
            part(
                unallocated.filter(F.col("source_record_type") == "COST_POOL"),
                {
                    "unallocated_amount": F.when(~excluded, open_amount).otherwise(zero),
                    "excluded_amount": F.when(excluded, open_amount).otherwise(zero),
                },
            )
        )
        .groupBy(*POOL_KEY)
        .agg(*[F.sum(c).alias(c) for c in PARTS])
    )
    return (
        pools.join(parts, POOL_KEY, "left")
        .withColumn("gl_amount", F.col("source_gl_amount"))
        .withColumns({c: zero_if_null(c).cast(TOTAL) for c in PARTS})
        .withColumn("reconciliation_level", F.lit("COST_POOL"))
        .withColumn("reconciliation_difference", difference())
        .withColumn(
            "reconciliation_status", F.when(within(tolerance), "PASS").otherwise("REVIEW")
        )
        .withColumn(
            "review_note",
            F.when(F.col("pool_status") == K.REVIEW, F.col("review_note")).when(
                ~within(tolerance), K.NOTE_POOL_DIFFERENCE
            ),
        )
        .select(*COLUMNS)
    )


def reconcile_unmatched(unallocated: DataFrame) -> DataFrame:
    """Unallocated cost without a pool, as rows with no ledger amount."""
    zero = F.lit(0).cast(TOTAL)
    return (
        unallocated.filter(F.col("source_record_type") != "COST_POOL")
        .groupBy(
            RUN, "reporting_month", "facility", "cost_centre_id", "cost_pool_code", "cost_category"
        )
        .agg(*_unallocated_parts())
        .withColumns({c: zero for c in AMOUNTS if c not in ("unallocated_amount", "excluded_amount")})
        .withColumns(
            {
                "reconciliation_level": F.lit("COST_POOL"),
                "reconciliation_difference": difference(),
                "reconciliation_status": F.lit("REVIEW"),
                "review_note": F.lit(K.NOTE_NO_POOL),
            }
        )
        .select(*COLUMNS)
    )


def reconcile_total(rows: DataFrame, tolerance: Decimal = K.TOLERANCE) -> DataFrame:
    """One TOTAL row per run over its pool rows; carries the earliest month."""
    missing = F.lit(None).cast("string")
    return (
        rows.filter(F.col("reconciliation_level") == "COST_POOL")
        .groupBy(RUN)
        .agg(
            F.min("reporting_month").alias("reporting_month"),
            *[F.sum(c).cast(TOTAL).alias(c) for c in AMOUNTS],
        )
        .withColumns(
            {
                "reconciliation_level": F.lit("TOTAL"),
                "facility": missing,
                "cost_centre_id": missing,
                "cost_pool_code": missing,
                "cost_category": missing,
                "reconciliation_difference": difference(),
                "review_note": F.lit(K.NOTE_TOTAL),
            }
        )
        .withColumn(
            "reconciliation_status", F.when(within(tolerance), "PASS").otherwise("REVIEW")
        )
        .select(*COLUMNS)
    )


def reconciliation_summary(rows: DataFrame) -> DataFrame:
    """Rows, distinct categories and pools, and sums per level."""
    return rows.groupBy(RUN, "reconciliation_level").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("cost_category").alias("cost_category_count"),
        F.countDistinct("cost_pool_code").alias("cost_pool_count"),
        *[F.sum(c).cast(TOTAL).alias(c) for c in [*AMOUNTS, "reconciliation_difference"]],
    )
