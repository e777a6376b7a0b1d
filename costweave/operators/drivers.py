"""Allocation drivers: how many units each encounter brings to each pool."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import quoted, stacked
from costweave.schemas import RUN
from costweave.session import lookup

DRIVER_KEY = [RUN, "reporting_month", "cost_pool_code", "allocation_driver"]
ENCOUNTER_MONTH = [RUN, "reporting_month", "encounter_id"]


def unpivot_measures(
    resource: DataFrame, measures: MappingType[str, str] = K.MEASURE_POOLS, apart: Sequence[str] = ()
) -> DataFrame:
    """Each resource row becomes one row per (pool, driver, units).

    ``apart`` names columns that keep pools apart, such as the facility; rows carry them.
    """
    rows = [
        [quoted(pool), quoted(measure), f"CAST({measure} AS DECIMAL(19,6))"]
        for measure, pool in measures.items()
    ]
    return resource.select(
        RUN,
        F.col("service_month").alias("reporting_month"),
        "encounter_id",
        *apart,
        stacked(rows, ["cost_pool_code", "allocation_driver", "driver_units"]),
    )


def count_drivers(
    encounters: DataFrame,
    pools: MappingType[str, str | None] = K.COUNT_POOLS,
    apart: Sequence[str] = (),
) -> DataFrame:
    """One unit per encounter in its episode month for each pool it qualifies for."""
    qualified = ", ".join(
        quoted(pool) if care is None else f"IF(care_type = {quoted(care)}, {quoted(pool)}, NULL)"
        for pool, care in pools.items()
    )
    return encounters.selectExpr(
        RUN,
        "episode_month AS reporting_month",
        "encounter_id",
        *apart,
        f"explode(array({qualified})) AS cost_pool_code",
        f"{quoted(K.COUNT_DRIVER)} AS allocation_driver",
        "CAST(1 AS DECIMAL(19,6)) AS driver_units",
    ).filter("cost_pool_code IS NOT NULL")


def _with_status(drivers: DataFrame, zero_note: str) -> DataFrame:
    units = F.col("driver_units")
    return drivers.withColumns(
        {
            "driver_status": F.when(units > 0, K.VALID).otherwise(K.EXCLUDED),
            "review_note": F.when(units == 0, zero_note),
        }
    )


def encounter_drivers(
    resource: DataFrame,
    encounters: DataFrame,
    measures: MappingType[str, str] = K.MEASURE_POOLS,
    counts: MappingType[str, str | None] = K.COUNT_POOLS,
    apart: Sequence[str] = (),
) -> DataFrame:
    """All pre-overhead drivers. Two narrow passes, no shuffle."""
    return _with_status(
        unpivot_measures(resource, measures, apart).unionByName(
            count_drivers(encounters, counts, apart)
        ),
        K.NOTE_ZERO_UNITS,
    )


def pre_overhead_drivers(cost_base: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """Direct plus indirect cost of each encounter as the overhead driver."""
    return _with_status(
        cost_base.select(
            *ENCOUNTER_MONTH,
            *apart,
            F.lit(K.OVERHEAD_POOL).alias("cost_pool_code"),
            F.lit(K.OVERHEAD_DRIVER).alias("allocation_driver"),
            F.col("pre_overhead_cost").alias("driver_units"),
        ),
        K.NOTE_NO_PRE_OVERHEAD,
    )


def driver_totals(drivers: DataFrame, keys: list[str] = DRIVER_KEY) -> DataFrame:
    """Valid units per pool and driver. Few keys: combined inside the map tasks."""
    return (
        drivers.filter(F.col("driver_status") == K.VALID)
        .groupBy(*keys)
        .agg(F.sum("driver_units").alias("total_driver_units"))
    )


def source_driver_totals(
    resource: DataFrame,
    encounters: DataFrame,
    measures: MappingType[str, str] = K.MEASURE_POOLS,
    counts: MappingType[str, str | None] = K.COUNT_POOLS,
    apart: Sequence[str] = (),
) -> DataFrame:
    """``driver_totals(encounter_drivers(...))`` with the unpivot done last.

    Measures are summed as columns, so each resource row is aggregated once
    instead of once per measure; only the monthly totals are reshaped.
    """
    names = ["cost_pool_code", "allocation_driver", "total_driver_units"]
    month = [RUN, "reporting_month", *apart]
    measured = (
        resource.groupBy(RUN, F.col("service_month").alias("reporting_month"), *apart)
        .agg(*[F.expr(f"SUM(IF({m} > 0, {m}, NULL)) AS {m}") for m in measures])
        .select(*month, stacked([[quoted(p), quoted(m), m] for m, p in measures.items()], names))
    )
    counted = (
        encounters.groupBy(RUN, F.col("episode_month").alias("reporting_month"), *apart)
        .agg(
            *[
                F.expr(
                    f"COUNT({'1' if care is None else f'IF(care_type = {quoted(care)}, 1, NULL)'}) "
                    f"AS {pool}"
                )
                for pool, care in counts.items()
            ]
        )
        .select(*month, stacked([[quoted(p), quoted(K.COUNT_DRIVER), p] for p in counts], names))
    )
    return (
        measured.unionByName(counted)
        .filter("total_driver_units > 0")
        .withColumn("total_driver_units", F.col("total_driver_units").cast("decimal(29,6)"))
    )


def driver_summary(drivers: DataFrame) -> DataFrame:
    """Rows and units per pool, driver and status."""
    return drivers.groupBy(
        RUN, "cost_pool_code", "allocation_driver", "driver_status"
    ).agg(
        F.count(F.lit(1)).alias("driver_rows"),
        F.sum("driver_units").alias("total_driver_units"),
    )


def within_scope(
    drivers: DataFrame, encounters: DataFrame, rules: DataFrame, all_scope: str = "All"
) -> DataFrame:
    """Drivers whose encounter lies in the eligible scope of a rule of their month.

    A scope is a ``|`` list of care types or service lines. Rules are joined on
    pool, driver and month, as the ledger joins them; of several categories any may
    admit a driver. Drivers of pools without a rule in their month are kept. Rules
    without dates hold in every month.
    """
    dated = {"effective_from", "effective_to"} <= set(rules.columns)
    month = F.col("reporting_month").between(F.col("effective_from"), F.col("effective_to")) if dated else F.lit(True)
    pairs = drivers.select("cost_pool_code", "allocation_driver", "reporting_month").distinct()
    scopes = lookup(
        pairs.join(rules.filter(F.col("active_flag") == "Y"), ["cost_pool_code", "allocation_driver"])
        .filter(month)
        .groupBy("cost_pool_code", "allocation_driver", "reporting_month")
        .agg(F.flatten(F.collect_set(F.split("eligible_scope", r"\|"))).alias("scopes"))
    )
    attributes = encounters.select(RUN, "encounter_id", "care_type", "service_line")
    scope = F.col("scopes")
    in_scope = (
        scope.isNull()
        | F.array_contains(scope, F.lit(all_scope))
        | F.array_contains(scope, F.col("care_type"))
        | F.array_contains(scope, F.col("service_line"))
    )
    return (
        drivers.join(scopes, ["cost_pool_code", "allocation_driver", "reporting_month"], "left")
        .join(attributes, [RUN, "encounter_id"])
        .filter(in_scope)
        .select(*drivers.columns)
    )
