"""Cost pools: ledger spend grouped by month, facility, centre, account and pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import first_of
from costweave.operators.mapping import Mapping, map_ledger
from costweave.schemas import POOL_AMOUNT, RUN, TOTAL

LEDGER_GRAIN = [RUN, "reporting_month", "facility", "cost_centre_id", "natural_account"]
POOL_KEY = [*LEDGER_GRAIN, "cost_pool_code"]


def pool_status(unclear: Column, treatment: Column) -> Column:
    """Without a clear mapping under review, else excluded by treatment, else ready."""
    return (
        F.when(unclear, K.REVIEW)
        .when(treatment == K.EXCLUDE, K.EXCLUDED)
        .otherwise(K.READY)
    )


def pool_note(treatment: Column) -> Column:
    """Missing centre, then missing account, then versions that contest them, then exclusion."""
    return (
        F.when(~F.col("centre_found"), K.NOTE_NO_CENTRE)
        .when(~F.col("account_found"), K.NOTE_NO_ACCOUNT)
        .when(F.col("centre_contested"), K.NOTE_CONTESTED_CENTRE)
        .when(F.col("rule_contested"), K.NOTE_CONTESTED_RULE)
        .when(treatment == K.EXCLUDE, K.NOTE_EXCLUDED)
    )


def cost_pools(ledger: DataFrame, mapping: Mapping) -> DataFrame:
    """One row per pool with transaction count, ledger amount, driver and status.

    The ledger is summed to its own grain before any lookup, so a cost centre
    that holds most transactions collapses inside the map tasks and the
    reference joins see only the aggregate. A pool whose centre or rule is contested in
    a month is kept for review in that month; every other pool is costed.
    """
    grain = ledger.groupBy(*LEDGER_GRAIN).agg(
        F.count(F.lit(1)).alias("n"), F.sum("signed_amount").alias("amount")
    )
    unclear = ~F.col("centre_found") | ~F.col("account_found") | F.col("centre_contested") | F.col("rule_contested")
    mapped = map_ledger(grain, mapping).select(
        *LEDGER_GRAIN,
        first_of("cost_pool_code", F.lit(K.UNMAPPED_POOL)).alias("cost_pool_code"),
        first_of("cost_category", F.lit(K.UNMAPPED_CATEGORY)).alias("cost_category"),
        first_of("costing_treatment", F.lit(K.REVIEW_TREATMENT)).alias("costing_treatment"),
        first_of("allocation_driver", "default_driver", F.lit(K.REVIEW_DRIVER)).alias(
            "allocation_driver"
        ),
        "n",
        "amount",
        pool_status(unclear, F.col("costing_treatment")).alias("pool_status"),
        pool_note(F.col("costing_treatment")).alias("review_note"),
    )
    # Already clustered by the ledger grain: this second grouping moves nothing.
    return mapped.groupBy(
        *POOL_KEY,
        "cost_category",
        "costing_treatment",
        "allocation_driver",
        "pool_status",
        "review_note",
    ).agg(
        F.sum("n").alias("source_transaction_count"),
        F.sum("amount").cast(POOL_AMOUNT).alias("source_gl_amount"),
    )


def ledger_totals(ledger: DataFrame, *by: str) -> DataFrame:
    """Signed ledger total per month, or per month and cost centre."""
    return ledger.groupBy(*(by or ("reporting_month",))).agg(
        F.sum("signed_amount").cast(TOTAL).alias("signed_gl_total")
    )


def pool_summary(pools: DataFrame) -> DataFrame:
    """Pools and ledger amount per status."""
    return pools.groupBy(RUN, "pool_status").agg(
        F.count(F.lit(1)).alias("pool_count"),
        F.sum("source_gl_amount").cast(TOTAL).alias("source_gl_amount"),
    )
