"""The ledger of cost that no encounter received, with the reason why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import clean_text
from costweave.operators.drivers import DRIVER_KEY
from costweave.operators.pools import POOL_KEY
from costweave.schemas import MONEY, RUN, TOTAL


def reason_from_note(note: Column) -> Column:
    return (
        F.when(note.startswith("Cost centre is not mapped"), "UNMAPPED_COST_CENTRE")
        .when(note.startswith("Natural account is not mapped"), "UNMAPPED_ACCOUNT")
        .otherwise("REVIEW")
    )


def _entries(df: DataFrame, reason: Column, resolution: str, note: Column) -> DataFrame:
    return df.select(
        *POOL_KEY,
        "cost_category",
        reason.alias("unallocated_reason"),
        F.col("source_gl_amount").alias("unallocated_amount"),
        F.lit("COST_POOL").alias("source_record_type"),
        F.concat_ws("|", *POOL_KEY[1:]).alias("source_record_id"),
        F.lit(resolution).alias("resolution_status"),
        note.alias("review_note"),
    )


def review_pools(pools: DataFrame) -> DataFrame:
    """Pools without a centre or account mapping."""
    note = F.col("review_note")
    return _entries(
        pools.filter(F.col("pool_status") == K.REVIEW), reason_from_note(note), "OPEN", note
    )


def excluded_pools(pools: DataFrame) -> DataFrame:
    """Pools the account mapping keeps out of patient costing."""
    return _entries(
        pools.filter(F.col("pool_status") == K.EXCLUDED),
        F.lit("EXCLUDED_ADJUSTMENT"),
        "EXCLUDED",
        F.coalesce("review_note", F.lit("Cost pool excluded from patient-level costing.")),
    )


def zero_driver_pools(
    pools: DataFrame,
    totals: DataFrame,
    keys: list[str] = DRIVER_KEY,
    treatments: tuple[str, ...] = (K.INDIRECT,),
) -> DataFrame:
    """Ready pools with money but no valid driver unit.

    Covers indirect pools; add ``Overhead`` to ``treatments`` to report overhead
    pools without a denominator as well.
    """
    return (
        pools.filter(
            (F.col("pool_status") == K.READY)
            & F.col("costing_treatment").isin(*treatments)
            & (F.col("source_gl_amount") != 0)
        )
        .join(totals.select(*keys, "total_driver_units"), keys, "left")
        .withColumn(
            "total_driver_units",
            F.coalesce("total_driver_units", F.lit(0)).cast(MONEY),
        )
        .filter(F.col("total_driver_units") == 0)
    )


def failed_direct(rejected: DataFrame) -> DataFrame:
    """Landed direct items that were not staged, at the amount they landed with."""
    landed = F.col("landed")
    return rejected.select(
        RUN,
        landed["service_month"].try_cast("date").alias("reporting_month"),
        F.lit(None).cast("string").alias("facility"),
        clean_text(landed["cost_centre_id"], 30).alias("cost_centre_id"),
        clean_text(landed["natural_account"], 20).alias("natural_account"),
        F.lit("DIRECT_COST").alias("cost_pool_code"),
        F.lit("Direct Cost").alias("cost_category"),
        F.lit("FAILED_DIRECT_ASSIGNMENT").alias("unallocated_reason"),
        landed["amount"].try_cast(MONEY).alias("unallocated_amount"),
        F.lit("DIRECT_COST").alias("source_record_type"),
        clean_text(landed["direct_cost_id"], 30).alias("source_record_id"),
        F.lit("OPEN").alias("resolution_status"),
        F.lit(K.NOTE_FAILED_DIRECT).alias("review_note"),
    )


def unallocated_costs(
    pools: DataFrame, zero_driver: DataFrame, rejected_direct: DataFrame
) -> DataFrame:
    """All four kinds of unallocated cost in one frame."""
    zero = _entries(
        zero_driver, F.lit("ZERO_DRIVER_POOL"), "OPEN", F.lit(K.NOTE_ZERO_DRIVER)
    )
    return (
        review_pools(pools)
        .unionByName(excluded_pools(pools))
        .unionByName(zero)
        .unionByName(failed_direct(rejected_direct))
    )


def reason_summary(unallocated: DataFrame) -> DataFrame:
    """Rows and amount per reason."""
    return unallocated.groupBy(RUN, "unallocated_reason").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("unallocated_amount").cast(TOTAL).alias("unallocated_amount"),
    )
