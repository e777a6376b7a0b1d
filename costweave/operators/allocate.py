"""Direct assignment and the allocation kernel shared by indirect and overhead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave import constants as K
from costweave.functions.columns import quoted, stacked
from costweave.operators.drivers import DRIVER_KEY, ENCOUNTER_MONTH
from costweave.operators.pools import POOL_KEY
from costweave.schemas import MONEY, RUN, TOTAL
from costweave.session import lookup_join


def assign_direct(direct: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """Every staged direct item belongs to its encounter."""
    return direct.select(
        RUN,
        "direct_cost_id",
        "encounter_id",
        "service_month",
        "cost_centre_id",
        "natural_account",
        *apart,
        "direct_cost_type",
        "quantity",
        F.col("amount").alias("assigned_amount"),
        F.lit(K.ASSIGNED).alias("assignment_status"),
        F.lit(None).cast("string").alias("review_note"),
    )


def pool_rates(
    pools: DataFrame, totals: DataFrame, treatment: str, keys: list[str] = DRIVER_KEY
) -> DataFrame:
    """Ready pools of one treatment with the unrounded price of a driver unit.

    Both inputs are aggregates. Stage the result: its size decides how the
    drivers are joined.
    """
    ready = pools.filter(
        (F.col("pool_status") == K.READY) & (F.col("costing_treatment") == treatment)
    )
    return (
        ready.join(totals.filter(F.col("total_driver_units") > 0), keys)
        .select(
            *dict.fromkeys([*POOL_KEY, *keys]),
            "costing_treatment",
            "source_gl_amount",
            "total_driver_units",
            (F.col("source_gl_amount") / F.col("total_driver_units")).alias("allocation_rate"),
        )
    )


def driver_rates(rates: DataFrame, keys: list[str] = DRIVER_KEY) -> DataFrame:
    """Pool rates summed per driver key: one row for every encounter row to meet."""
    return rates.groupBy(*keys).agg(F.sum("allocation_rate").alias("allocation_rate"))


def allocate(
    rates: DataFrame,
    drivers: DataFrame,
    keys: list[str] = DRIVER_KEY,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Allocation detail, one row per pool and eligible encounter driver.

    This is the audit listing. Costing itself uses ``allocate_units``, whose size
    does not depend on how many pools share a driver. ``carried`` names columns of
    either side that the rows keep: what is known of a driver or a pool is cheaper to
    add before they meet. Whole units are multiplied without their six zeros, which
    gives the same product from smaller numbers.
    """
    units = F.col("driver_units")
    whole = units.try_cast("decimal(18,0)")
    amount = F.coalesce(
        F.col("_whole_units") * F.col("allocation_rate"), units * F.col("allocation_rate")
    )
    valid = drivers.filter(F.col("driver_status") == K.VALID)
    return lookup_join(
        valid.select(
            *keys,
            "encounter_id",
            "driver_units",
            F.when(whole == units, whole).alias("_whole_units"),
            *[c for c in carried if c in drivers.columns],
        ),
        rates,
        keys,
        "encounter_id",
    ).select(
        *POOL_KEY,
        "allocation_driver",
        "costing_treatment",
        "encounter_id",
        F.col("driver_units").alias("encounter_driver_units"),
        "total_driver_units",
        F.col("allocation_rate").cast(MONEY).alias("allocation_rate"),
        amount.cast(MONEY).alias("allocated_amount"),
        F.lit(K.ALLOCATED).alias("allocation_status"),
        *carried,
    )


def allocate_units(
    rates: DataFrame, drivers: DataFrame, keys: list[str] = DRIVER_KEY
) -> DataFrame:
    """Allocation per encounter driver: units times the summed rate of its pools.

    ``rates`` is the result of ``driver_rates``. Linear in the drivers; the
    drivers are not moved while the rates fit a broadcast.
    """
    valid = drivers.filter(F.col("driver_status") == K.VALID)
    joined = lookup_join(
        valid.select(*dict.fromkeys([*keys, *ENCOUNTER_MONTH]), "driver_units"),
        rates,
        keys,
        "encounter_id",
    )
    return joined.select(
        *dict.fromkeys([*ENCOUNTER_MONTH, *keys]),
        F.col("driver_units").alias("encounter_driver_units"),
        (F.col("driver_units") * F.col("allocation_rate")).cast(MONEY).alias("allocated_amount"),
    )


def allocated_by_pool(
    rates: DataFrame, allocations: DataFrame, keys: list[str] = DRIVER_KEY
) -> DataFrame:
    """What each pool really gave away: its rate times the units that were reached.

    Units are summed from the allocations, not taken from the denominator, so a
    lost or repeated allocation row shows up as a difference.
    """
    reached = allocations.groupBy(*keys).agg(
        F.sum("encounter_driver_units").alias("reached_units")
    )
    return given_away(rates, reached, keys)


def reached_units(
    monthly_rates: DataFrame,
    resource: DataFrame,
    encounters: DataFrame,
    measures=K.MEASURE_POOLS,
    counts=K.COUNT_POOLS,
    apart: Sequence[str] = (),
) -> DataFrame:
    """Units that met a rate, per driver key, summed from the rows that are priced.

    Measures stay columns until the months are summed, as in ``indirect_by_encounter``.
    """
    month = [RUN, "reporting_month", *apart]
    names = ["cost_pool_code", "allocation_driver", "reached_units"]

    def summed(rows: DataFrame, parts: list[tuple[str, str, str]]) -> DataFrame:
        """``parts`` holds pool, driver and the units of a row, null where not valid."""
        sums = [
            F.expr(f"CAST(SUM(IF({pool} IS NOT NULL, {units}, NULL)) AS DECIMAL(38,6)) AS units_{pool}")
            for pool, _, units in parts
        ]
        reshaped = stacked([[quoted(pool), quoted(driver), f"units_{pool}"] for pool, driver, _ in parts], names)
        return rows.groupBy(*month).agg(*sums).select(*month, reshaped).filter("reached_units IS NOT NULL")

    used = resource.select(
        RUN, F.col("service_month").alias("reporting_month"), "encounter_id", *apart, *measures
    )
    counted = encounters.select(
        RUN, F.col("episode_month").alias("reporting_month"), "encounter_id", *apart, "care_type"
    )
    return summed(
        lookup_join(used, monthly_rates.drop(*counts), month, "encounter_id"),
        [(pool, m, f"IF({m} > 0, CAST({m} AS DECIMAL(19,6)), NULL)") for m, pool in measures.items()],
    ).unionByName(
        summed(
            lookup_join(counted, monthly_rates.select(*month, *counts), month, "encounter_id"),
            [
                (pool, K.COUNT_DRIVER, "1" if care is None else f"IF(care_type = {quoted(care)}, 1, NULL)")
                for pool, care in counts.items()
            ],
        )
    )


def given_away(rates: DataFrame, reached: DataFrame, keys: list[str] = DRIVER_KEY) -> DataFrame:
    """Per pool its rate times the units it reached."""
    return rates.join(reached, keys).select(
        *POOL_KEY,
        "costing_treatment",
        (F.col("allocation_rate") * F.col("reached_units"))
        .cast(TOTAL)
        .alias("allocated_amount"),
    )


def by_encounter_month(amounts: DataFrame, amount: str, month: str = "reporting_month") -> DataFrame:
    """Sum per encounter and month. A hot encounter is combined before the shuffle."""
    return amounts.groupBy(
        RUN, F.col(month).alias("reporting_month"), "encounter_id"
    ).agg(F.sum(amount).cast(MONEY).alias(amount))


def allocated_pools(pools: DataFrame, allocations: DataFrame) -> DataFrame:
    """Ready indirect pools that have at least one allocation row."""
    return pools.filter(
        (F.col("pool_status") == K.READY) & (F.col("costing_treatment") == K.INDIRECT)
    ).join(allocations.select(*DRIVER_KEY).distinct(), DRIVER_KEY, "left_semi")


def rates_by_month(
    rates: DataFrame, measures=K.MEASURE_POOLS, counts=K.COUNT_POOLS, apart: Sequence[str] = ()
) -> DataFrame:
    """Driver rates as one wide row per month and ``apart``, a column per pool."""
    pairs = [(pool, measure) for measure, pool in measures.items()]
    pairs += [(pool, K.COUNT_DRIVER) for pool in counts]
    return rates.groupBy(RUN, "reporting_month", *apart).agg(
        *[
            F.expr(
                f"SUM(IF(cost_pool_code = {quoted(pool)} AND allocation_driver = {quoted(driver)}, "
                f"allocation_rate, NULL)) AS {pool}"
            )
            for pool, driver in pairs
        ]
    )


def indirect_by_encounter(
    monthly_rates: DataFrame,
    resource: DataFrame,
    encounters: DataFrame,
    measures=K.MEASURE_POOLS,
    counts=K.COUNT_POOLS,
    apart: Sequence[str] = (),
) -> DataFrame:
    """Indirect cost per encounter and month straight from the sources.

    Equal to summing ``allocate_units`` over ``encounter_drivers``, product by
    product, but each resource row is priced once as a row of measures instead
    of being unpivoted first. ``monthly_rates`` is a staged ``rates_by_month``.
    """

    def priced(units: str, pool: str, kind: str = "decimal(10,0)") -> str:
        """Null without a valid unit or without a rate."""
        valid = f"CAST(IF({units} > 0, {units}, NULL) AS {kind})"
        return f"CAST({valid} * {pool} AS DECIMAL(19,6))"

    # whole units give the same product without six zeros, from smaller numbers
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    kinds = {
        m: "decimal(10,0)" if isinstance(resource.schema[m].dataType, whole) else "decimal(19,6)"
        for m in measures
    }

    def totalled(df: DataFrame, parts: list[str]) -> DataFrame:
        amount = " + ".join(f"COALESCE({part}, 0)" for part in parts)
        return df.filter(f"COALESCE({', '.join(parts)}) IS NOT NULL").selectExpr(
            *ENCOUNTER_MONTH, f"CAST({amount} AS DECIMAL(19,6)) AS allocated_amount"
        )

    month = [RUN, "reporting_month", *apart]
    used = resource.select(
        RUN, F.col("service_month").alias("reporting_month"), "encounter_id", *apart, *measures
    )
    from_measures = totalled(
        lookup_join(used, monthly_rates.drop(*counts), month, "encounter_id"),
        [priced(m, pool, kinds[m]) for m, pool in measures.items()],
    )
    counted = encounters.select(
        RUN, F.col("episode_month").alias("reporting_month"), "encounter_id", *apart, "care_type"
    )
    from_counts = totalled(
        lookup_join(counted, monthly_rates.select(*month, *counts), month, "encounter_id"),
        [
            priced("1" if care is None else f"IF(care_type = {quoted(care)}, 1, NULL)", pool)
            for pool, care in counts.items()
        ],
    )
    return by_encounter_month(from_measures.unionByName(from_counts), "allocated_amount")
