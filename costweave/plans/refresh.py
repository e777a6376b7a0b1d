"""The monthly refresh: land, seed, promote, cost, check, publish.

Steps talk to each other only through tables under one warehouse folder, each
partitioned by run, so any step can be repeated and leaves the same data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave.functions.columns import inline
from costweave.operators import checks, promote, quality
from costweave.operators.funding import adjustment_factors
from costweave.operators.mapping import governed
from costweave.operators.promote import accepted, classify, rejected
from costweave.plans.assurance import assure
from costweave.plans.costing import CostingRun
from costweave.schemas import ENCOUNTER, ENTITIES, REFERENCES, RUN
from costweave.session import stage
from costweave.sources import landing
from costweave.sources.reference import read_reference, upsert
from costweave.sources.tables import replace_run, replace_slice

CONFORMED = {
    "service_line": "service_line",
    "care_type": "care_type",
    "activity_group_code": "activity_group",
}


@dataclass(frozen=True)
class Warehouse:
    """Tables of one installation under a shared folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def read(self, name: str, run: int | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        if RUN in df.columns:
            df = df.withColumn(RUN, F.col(RUN).cast("long"))
        return df if run is None else df.filter(F.col(RUN) == run)

    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name))
        except AnalysisException:
            return False
        return True

    def replace(self, name: str, df: DataFrame, run: int) -> DataFrame:
        replace_run(df, self.path(name), run)
        return self.read(name, run)


def load(
    wh: Warehouse,
    source_root: str,
    expected_rows: dict[str, int],
    at: datetime,
    run: int,
    financial_year: str | None = None,
) -> None:
    """Land the raw extracts and compare their row counts with the control.

    A run that fails is logged as FAILED; later steps read completed runs only.
    """
    log = wh.path("dq.load_run")
    landing.log_event(wh.spark, log, run, "STARTED", at, financial_year, source_root)
    try:
        actual = None
        for entity in ENTITIES.values():
            scan = landing.read_landing_csv(
                wh.spark, f"{source_root}/{entity.name}.csv", entity
            )
            rows = wh.replace(f"landing.{entity.name}", landing.add_lineage(scan, run), run)
            # a folder of part files is one source file
            part = rows.select(RUN, F.lit(f"{entity.name}.csv").alias("source_file_name"))
            actual = part if actual is None else actual.unionByName(part)
        expected = inline(
            wh.spark, list(expected_rows.items()), "file_name string, expected_row_count long"
        )
        control = landing.file_row_control(actual, expected).withColumn(
            RUN, F.lit(run).cast("long")
        )
        wh.replace("dq.source_file_control", control, run)
    except Exception as error:
        landing.log_event(wh.spark, log, run, "FAILED", at, financial_year, source_root, str(error))
        raise
    landing.log_event(wh.spark, log, run, "COMPLETED", at, financial_year, source_root)


def seed(wh: Warehouse, folder: str) -> None:
    """Merge the reference files and the rule catalogue into their tables."""

    def merge(name: str, source: DataFrame, keys: list[str]) -> None:
        if wh.exists(name):
            source = stage(upsert(wh.read(name), source, keys), "reference")
        source.write.mode("overwrite").parquet(wh.path(name))

    for ref in REFERENCES.values():
        merge(f"ref.{ref.name}", read_reference(wh.spark, ref.name, folder), list(ref.keys))
    merge("dq.validation_rule", quality.rule_catalogue(wh.spark), ["validation_rule_id"])


def current_run(wh: Warehouse) -> int:
    log = landing.run_log(wh.spark, wh.path("dq.load_run"))
    return landing.current_run(log).first()[0]


def promote_rows(wh: Warehouse, run: int) -> dict[str, DataFrame]:
    """Classify landed rows; accepted and rejected rows stay in one table per entity.

    Every copy of a repeated business key is rejected: which of them is right is not known.
    """
    references = {column: wh.read(f"ref.{name}") for column, name in CONFORMED.items()}
    classified: dict[str, DataFrame] = {}
    for name, entity in ENTITIES.items():
        parents = accepted(classified[ENCOUNTER.name]) if entity.needs_encounter else None
        rows = classify(
            wh.read(f"landing.{name}", run), entity, references=references, encounters=parents, unique=True
        )
        classified[name] = wh.replace(f"stg.{name}", rows, run)
    wh.replace("dq.promotion_summary", promote.promotion_summary(classified), run)
    return classified


def cost(wh: Warehouse, run: int, apart: tuple[str, ...] = (), audit: bool = False) -> CostingRun:
    """Build and store every costing table of the run.

    ``apart`` keeps pools apart, by facility for example. ``audit`` also stores what each pool
    gave to each encounter, a table of pools times encounters that costing itself never reads.
    """
    staged = {name: wh.read(f"stg.{name}", run) for name in ENTITIES}
    costing = CostingRun(
        encounters=accepted(staged["patient_encounter"]),
        resource=accepted(staged["resource_usage"]),
        direct=accepted(staged["direct_cost_detail"]),
        ledger=accepted(staged["general_ledger_transaction"]),
        mapping=governed(*[wh.read(f"ref.{n}") for n in ("cost_centre", "account_mapping", "allocation_rule")]),
        rejected_direct=rejected(staged["direct_cost_detail"]),
        funding_groups=wh.read("ref.abf_activity_group"),
        factors=adjustment_factors(wh.read("ref.abf_adjustment_rule")),
        apart=apart,
    )
    wh.replace("costing.cost_pool", costing.pools, run)
    wh.replace(
        "costing.encounter_driver",
        costing.drivers.unionByName(costing.overhead_drivers),
        run,
    )
    wh.replace("costing.direct_cost_assignment", costing.assigned, run)
    allocations = wh.path("costing.encounter_allocation")
    for treatment, rows in (
        ("Indirect", costing.indirect_allocations),
        ("Overhead", costing.overhead_allocations),
    ):
        replace_slice(
            rows.withColumn("costing_treatment", F.lit(treatment)),
            allocations,
            {RUN: run, "costing_treatment": treatment},
        )
    # later steps start from the stored rows
    stored = wh.read("costing.encounter_allocation", run)
    costing.indirect_allocations = stored.filter(F.col("costing_treatment") == "Indirect")
    costing.overhead_allocations = stored.filter(F.col("costing_treatment") == "Overhead")
    if audit:
        wh.replace("costing.pool_allocation", costing.pool_allocations, run)
    wh.replace("costing.unallocated_cost", costing.unallocated, run)
    costing.costs = costing.stored_costs
    wh.replace("costing.patient_level_cost", costing.flagged, run)
    wh.replace("costing.abf_comparison", costing.comparison, run)
    wh.replace("recon.costing_reconciliation", costing.reconciliation, run)
    return costing


def check(wh: Warehouse, run: int, costing: CostingRun) -> DataFrame:
    """Store rule results and issues, one slice per rule, and return readiness."""
    ledger = accepted(wh.read("stg.general_ledger_transaction", run))
    outcomes = {
        "RU_NOT_PROMOTED": quality.resource_not_promoted(wh.read("stg.resource_usage", run)),
        "DC_NOT_PROMOTED": quality.direct_not_promoted(wh.read("stg.direct_cost_detail", run)),
        "GL_UNKNOWN_COST_CENTRE": quality.unknown_cost_centre(ledger, costing.mapping),
        "GL_UNMAPPED_ACCOUNT": quality.unmapped_account(ledger, costing.mapping),
        "ZERO_DRIVER_POOL": quality.zero_driver(costing.pools, costing.zero_driver),
    }
    for rule, (result, issues) in outcomes.items():
        slice_ = {RUN: run, "validation_rule_id": rule}
        result = quality.with_missing(result, run, [rule])
        replace_slice(result, wh.path("dq.validation_result"), slice_)
        replace_slice(issues, wh.path("dq.issue_register"), slice_)
    return checks.readiness(
        wh.read("dq.validation_result", run),
        wh.read("dq.validation_rule"),
        wh.read("dq.source_file_control", run),
        wh.read("recon.costing_reconciliation", run),
    )


def refresh(
    wh: Warehouse,
    source_root: str,
    reference_root: str,
    expected_rows: dict[str, int],
    at: datetime,
    run: int,
    financial_year: str | None = None,
    expect: checks.Expectations = checks.YEAR,
    apart: tuple[str, ...] = (),
    audit: bool = False,
) -> DataFrame:
    """All steps in order; returns whether the run may be published.

    ``apart`` and ``audit`` are those of ``cost``.
    """
    load(wh, source_root, expected_rows, at, run, financial_year)
    seed(wh, reference_root)
    promote_rows(wh, run)
    ready = check(wh, run, cost(wh, run, apart, audit))
    assure(wh, run, at, expect)
    return ready
