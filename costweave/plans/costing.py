"""One costing run, from typed tables to reconciliation."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame

from costweave import constants as K
from costweave.operators import allocate, drivers, funding, patient, pools, recon, unallocated
from costweave.operators.mapping import Mapping
from costweave.schemas import RUN
from costweave.session import stage


@dataclass
class CostingRun:
    """The steps of a run; each is built when first asked for.

    Aggregates that later steps read more than once, or whose size decides a
    join, are stored in the shared staging folder. Everything else stays lazy,
    and its joins and filters are planned together with the step that uses it.
    Pass stored tables as inputs: several steps read them.

    ``apart`` names columns of the pools and encounters, such as ``("facility",)``, that keep
    pools apart: a pool is then spread over the encounters that share its values, and
    direct items meet only the pools of their encounter. An encounter without a
    value gets its direct cost only.

    ``carried`` names columns of ``drivers`` that the audit listing keeps; overhead rows
    have none.
    """

    encounters: DataFrame
    resource: DataFrame
    direct: DataFrame
    ledger: DataFrame
    mapping: Mapping
    rejected_direct: DataFrame | None = None
    funding_groups: DataFrame | None = None
    attribution: str = patient.EPISODE_MONTH
    price: Decimal = K.BASE_PRICE
    factors: dict = field(default_factory=lambda: dict(K.ADJUSTMENT_FACTORS))
    zero_driver_treatments: tuple[str, ...] = (K.INDIRECT,)
    apart: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [*drivers.DRIVER_KEY, *self.apart]

    def _placed(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with what keeps pools apart, as their encounter has it; joined once."""
        if not self.apart:
            return rows
        places = self.encounters.select(RUN, "encounter_id", *self.apart)
        return stage(rows.drop(*self.apart).join(places, [RUN, "encounter_id"]), name)

    @cached_property
    def used(self) -> DataFrame:
        return self._placed(self.resource, "placed_resource")

    @cached_property
    def pools(self) -> DataFrame:
        return stage(pools.cost_pools(self.ledger, self.mapping), "cost_pool")

    @cached_property
    def driver_totals(self) -> DataFrame:
        return stage(
            drivers.source_driver_totals(self.used, self.encounters, apart=self.apart), "driver_total"
        )

    @cached_property
    def drivers(self) -> DataFrame:
        return drivers.encounter_drivers(self.used, self.encounters, apart=self.apart)

    @cached_property
    def rates(self) -> DataFrame:
        """Two stored aggregates joined; cheap enough to plan again where it is used."""
        return allocate.pool_rates(self.pools, self.driver_totals, K.INDIRECT, self.keys)

    @cached_property
    def monthly_rates(self) -> DataFrame:
        rates = allocate.driver_rates(self.rates, self.keys)
        return stage(allocate.rates_by_month(rates, apart=self.apart), "monthly_rate")

    @cached_property
    def indirect(self) -> DataFrame:
        return allocate.indirect_by_encounter(
            self.monthly_rates, self.used, self.encounters, apart=self.apart
        )

    @cached_property
    def assigned(self) -> DataFrame:
        return allocate.assign_direct(self._placed(self.direct, "placed_direct"), self.apart)

    @cached_property
    def base(self) -> DataFrame:
        direct = allocate.by_encounter_month(self.assigned, "assigned_amount", "service_month")
        return stage(
            patient.cost_base(self.encounters, direct, self.indirect, self.attribution),
            "cost_base",
        )

    @cached_property
    def overhead_rates(self) -> DataFrame:
        return stage(patient.overhead_rates(self.pools, self.base, self.apart), "overhead_rate")

    @cached_property
    def costs(self) -> DataFrame:
        """Patient-level cost before the cohort comparison; a narrow pass over the base."""
        return patient.patient_level_cost(self.base, self.overhead_rates, self.apart)

    @cached_property
    def stored_costs(self) -> DataFrame:
        return stage(self.costs, "patient_cost")

    @cached_property
    def flagged(self) -> DataFrame:
        return patient.flag_high_cost(self.stored_costs)

    @cached_property
    def indirect_allocations(self) -> DataFrame:
        rates = stage(allocate.driver_rates(self.rates, self.keys), "driver_rate")
        return allocate.allocate_units(rates, self.drivers, self.keys)

    @cached_property
    def overhead_allocations(self) -> DataFrame:
        rates = stage(allocate.driver_rates(self.overhead_rates, self.keys), "driver_rate")
        return allocate.allocate_units(rates, self.overhead_drivers, self.keys)

    @cached_property
    def overhead_drivers(self) -> DataFrame:
        return drivers.pre_overhead_drivers(self.base, self.apart)

    @cached_property
    def pool_allocations(self) -> DataFrame:
        """The audit listing of both stages: what each pool gave to each encounter."""
        indirect = allocate.allocate(
            stage(self.rates, "pool_rate"), self.drivers, self.keys, self.carried
        )
        overhead = allocate.allocate(self.overhead_rates, self.overhead_drivers, self.keys)
        return indirect.unionByName(overhead, allowMissingColumns=bool(self.carried))

    @cached_property
    def allocated(self) -> DataFrame:
        """Amount every pool gave away, both stages.

        From the allocation rows where they were stored; else from units that are
        summed as the rows are priced, which unpivots nothing.
        """
        if "indirect_allocations" in self.__dict__:
            indirect = allocate.allocated_by_pool(self.rates, self.indirect_allocations, self.keys)
        else:
            reached = allocate.reached_units(
                self.monthly_rates, self.used, self.encounters, apart=self.apart
            )
            indirect = allocate.given_away(self.rates, reached, self.keys)
        return indirect.unionByName(
            allocate.allocated_by_pool(self.overhead_rates, self.overhead_allocations, self.keys)
        )

    @cached_property
    def zero_driver(self) -> DataFrame:
        totals = self.driver_totals
        if K.OVERHEAD in self.zero_driver_treatments:
            totals = totals.unionByName(
                drivers.driver_totals(self.overhead_drivers, self.keys)
            )
        return unallocated.zero_driver_pools(
            self.pools, totals, self.keys, self.zero_driver_treatments
        )

    @cached_property
    def unallocated(self) -> DataFrame:
        return unallocated.unallocated_costs(self.pools, self.zero_driver, self.rejected_direct)

    @cached_property
    def comparison(self) -> DataFrame:
        return funding.funding_comparison(
            self.costs, self.funding_groups, self.price, self.factors
        )

    @cached_property
    def reconciliation(self) -> DataFrame:
        """Pool rows, rows without a pool, and the total."""
        rows = stage(
            recon.reconcile_pools(
                self.pools,
                self.assigned,
                self.allocated,
                self.unallocated,
                direct_keys=[*recon.DIRECT_KEY, *self.apart],
            ).unionByName(recon.reconcile_unmatched(self.unallocated)),
            "reconciliation",
        )
        return rows.unionByName(recon.reconcile_total(rows))
