"""Assurance of a refreshed run: funding extract, controls, checks, statistics and issue lives, stored."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.operators import checks, quality, summaries
from costweave.operators.funding import adjustment_factors, encounter_funding, monthly_funding_control
from costweave.operators.pools import ledger_totals
from costweave.operators.promote import accepted
from costweave.operators.variance import unallocated_materiality
from costweave.schemas import RUN
from costweave.sources.tables import write_check_report, write_control_csv


def _of_run(df: DataFrame, run: int) -> DataFrame:
    return df.withColumn(RUN, F.lit(run).cast("long"))


def _landed(classified: DataFrame) -> DataFrame:
    """All rows as typed, the rejected ones too."""
    return classified.drop("landed", "reject_reason")


def store_funding(wh, run: int) -> DataFrame:
    """The funding extract, its monthly control as a table and as a file."""
    encounters = accepted(wh.read("stg.patient_encounter", run))
    extract = encounter_funding(
        encounters, wh.read("ref.abf_activity_group"), factors=adjustment_factors(wh.read("ref.abf_adjustment_rule"))
    )
    stored = wh.replace("abf.encounter_funding", extract, run)
    control = wh.replace("abf.monthly_control_total", _of_run(monthly_funding_control(stored), run), run)
    write_control_csv(control.orderBy("episode_month"), wh.path(f"controls.abf_monthly_control_total.{run}"))
    return stored


def check_run(wh, run: int, funding: DataFrame, expect: checks.Expectations = checks.YEAR) -> DataFrame:
    """All checks of a run: files, encounters, resources, ledger, funding and plausibility.

    Every area reads the stored tables of the run. Control totals of the ledger are taken
    from the landed rows, so what promotion lost shows. The results are stored as a table and
    as JSON lines.
    """
    staged = {
        name: wh.read(f"stg.{name}", run)
        for name in ("patient_encounter", "resource_usage", "direct_cost_detail", "general_ledger_transaction")
    }
    encounters = accepted(staged["patient_encounter"])
    ledger = accepted(staged["general_ledger_transaction"])
    landed = _landed(staged["general_ledger_transaction"])

    def control(*by: str) -> DataFrame:
        return ledger_totals(landed, *by).withColumnRenamed("signed_gl_total", "expected_signed_gl_total")

    areas = [
        checks.row_control_check(wh.read("dq.source_file_control", run)),
        checks.encounter_checks(encounters, accepted(staged["resource_usage"]), expect),
        checks.resource_checks(_landed(staged["resource_usage"]), encounters, expect),
        checks.financial_checks(
            ledger,
            _landed(staged["direct_cost_detail"]),
            encounters,
            wh.read("ref.cost_centre"),
            wh.read("ref.account_mapping"),
            control("reporting_month"),
            control("reporting_month", "cost_centre_id"),
            expect,
        ),
        checks.funding_checks(
            funding, encounters, wh.read("ref.abf_activity_group"), wh.read("abf.monthly_control_total", run), expect
        ),
        checks.plausibility_checks(encounters, ledger, funding, expect),
    ]
    found = areas[0]
    for area in areas[1:]:
        found = found.unionByName(area)
    stored = wh.replace("dq.check_result", _of_run(found, run), run)
    write_check_report(stored, wh.path(f"controls.check_report.{run}"))
    status = checks.overall_status(stored)
    wh.replace("dq.check_status", _of_run(status, run), run)
    return stored


def store_statistics(wh, run: int, funding: DataFrame) -> None:
    """Totals by level of ledger and funding, materiality of what is unallocated, odd resource rows."""
    ledger = accepted(wh.read("stg.general_ledger_transaction", run))
    wh.replace("dq.ledger_statistic", summaries.ledger_statistics(ledger), run)
    wh.replace("dq.funding_statistic", summaries.funding_statistics(funding), run)
    wh.replace(
        "dq.unallocated_materiality",
        unallocated_materiality(
            wh.read("costing.unallocated_cost", run), ledger_totals(ledger, RUN, "reporting_month")
        ),
        run,
    )
    resource = _landed(wh.read("stg.resource_usage", run))
    wh.replace("dq.implausible_resource", checks.implausible_resources(resource), run)


def store_lives(wh, run: int, at: datetime) -> DataFrame:
    """The life of every issue up to this run, from the lives of the latest earlier run."""
    previous = None
    if wh.exists("dq.issue_life"):
        lives = wh.read("dq.issue_life").filter(F.col(RUN) < run)
        before = lives.agg(F.max(RUN)).first()[0]
        previous = None if before is None else lives.filter(F.col(RUN) == before)
    current = wh.read("dq.issue_register", run)
    return wh.replace("dq.issue_life", quality.carry_forward(previous, current, run, at), run)


def assure(wh, run: int, at: datetime, expect: checks.Expectations = checks.YEAR) -> DataFrame:
    """Everything above, after costing and rules are stored; returns the checks."""
    funding = store_funding(wh, run)
    store_statistics(wh, run, funding)
    store_lives(wh, run, at)
    return check_run(wh, run, funding, expect)
