"""The whole refresh over the hand-written hospital."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.operators.mapping import governed
from costweave.operators.promote import accepted, rejected
from costweave.plans import reporting
from costweave.plans.costing import CostingRun
from costweave.plans.refresh import Warehouse, current_run, refresh
from tests import hospital

EXPECTED = {
    "patient_encounter.csv": 30,
    "resource_usage.csv": 28,
    "direct_cost_detail.csv": 3,
    "general_ledger_transaction.csv": 14,
}
AT = datetime(2025, 7, 1, 8, 0, 0)


@pytest.fixture(scope="module")
def hospital_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hospital")
    raw, ref = hospital.write(folder)
    wh = Warehouse(spark, str(folder / "warehouse"))
    ready = refresh(wh, raw, ref, EXPECTED, AT, 1, "2024-25").collect()
    return wh, raw, ref, ready


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_controls_and_run_log(hospital_run):
    wh, *_ = hospital_run
    assert current_run(wh) == 1
    control = wh.read("dq.source_file_control", 1)
    assert {r[0] for r in rows(control, "control_status")} == {"PASS"}
    lines = wh.read("landing.patient_encounter", 1).select("source_row_number", "encounter_id")
    assert rows(lines, "source_row_number")[0] == (2,)
    assert one(lines.filter("encounter_id = 'E23'"))[0] == 25


def test_pools_apart_by_facility_and_the_audit_listing(hospital_run, spark, tmp_path):
    """With one facility nothing changes; the listing adds up to the stored allocations."""
    wh, raw, ref, _ = hospital_run
    costing = CostingRun(
        **{
            name: accepted(wh.read(f"stg.{table}", 1))
            for name, table in (
                ("encounters", "patient_encounter"),
                ("resource", "resource_usage"),
                ("direct", "direct_cost_detail"),
                ("ledger", "general_ledger_transaction"),
            )
        },
        mapping=governed(*[wh.read(f"ref.{n}") for n in ("cost_centre", "account_mapping", "allocation_rule")]),
        rejected_direct=rejected(wh.read("stg.direct_cost_detail", 1)),
        apart=("facility",),
    )
    parts = ("encounter_id", "direct_cost_amount", "indirect_cost_amount", "overhead_cost_amount")
    assert rows(costing.costs, *parts) == rows(wh.read("costing.patient_level_cost", 1), *parts)
    by = ("cost_pool_code", "encounter_id")
    listed = costing.pool_allocations.groupBy(*by).agg(F.sum("allocated_amount").alias("amount"))
    stored = wh.read("costing.encounter_allocation", 1).groupBy(*by).agg(F.sum("allocated_amount").alias("amount"))
    left, right = ({tuple(r[:2]): r[2] for r in df.collect()} for df in (listed, stored))
    assert left.keys() == right.keys() and all(abs(left[k] - right[k]) < Decimal("0.00001") for k in left)
    total = one(costing.reconciliation.filter("reconciliation_level = 'TOTAL'"))
    assert total.gl_amount == Decimal(hospital.GL_TOTAL) and total.reconciliation_status == "PASS"


def test_promotion(hospital_run):
    wh, *_ = hospital_run
    assert rows(wh.read("dq.promotion_summary", 1), "source_entity", "landing_count", "staged_count") == [
        ("direct_cost_detail", 3, 2),
        ("general_ledger_transaction", 14, 14),
        ("patient_encounter", 30, 28),
        ("resource_usage", 28, 27),
    ]
    bad = wh.read("stg.patient_encounter", 1).filter("reject_reason IS NOT NULL")
    assert rows(bad, "encounter_id", "reject_reason") == [
        ("BACKWARD", "discharge_date before admission_date"),
        ("BADDATE", "invalid admission_date"),
    ]
    trimmed = wh.read("stg.patient_encounter", 1).filter("encounter_id = 'ED1'")
    assert one(trimmed.select("care_type"))[0] == "Emergency"


def test_pools_keep_every_dollar(hospital_run):
    wh, *_ = hospital_run
    pools = wh.read("costing.cost_pool", 1)
    assert one(pools.agg(F.sum("source_gl_amount")))[0] == Decimal(hospital.GL_TOTAL)
    status = dict(rows(pools.filter("pool_status <> 'READY'"), "cost_centre_id", "pool_status"))
    assert status == {"CC_UNKNOWN": "REVIEW", "CC_WARD": "REVIEW", "CC_OLD": "REVIEW", "CC_ADMIN": "EXCLUDED"}
    merged = one(pools.filter("natural_account = '510400'"))
    assert (merged.source_transaction_count, merged.source_gl_amount) == (2, Decimal("6800"))
    unknown = one(pools.filter("cost_centre_id = 'CC_UNKNOWN'"))
    assert (unknown.cost_pool_code, unknown.cost_category, unknown.allocation_driver) == ("UNMAPPED", "Nursing", "bed_days")


def test_patient_cost_against_arithmetic_by_hand(hospital_run):
    wh, *_ = hospital_run
    costs = {r.encounter_id: r for r in wh.read("costing.patient_level_cost", 1).collect()}
    assert len(costs) == 28
    # ward: 76000 over 24*3+4 days; pharmacy: 6800 over 300+6+2 units; admin: 2700 over 27
    ward, pharmacy, admin = Decimal(76000) / 76, Decimal(6800) / 308, Decimal(2700) / 27
    e5 = costs["E05"]
    assert e5.direct_cost_amount == Decimal("5000")
    assert abs(e5.indirect_cost_amount - (3 * ward + 6 * pharmacy + admin)) < Decimal("0.00001")
    assert abs(costs["ED1"].indirect_cost_amount - (Decimal("1234.56") + admin)) < Decimal("0.00001")
    # the February ward pool (5000) went to a stay whose episode month is January
    gap = costs["MULTI"].indirect_cost_amount - (4 * ward + 6 * pharmacy + admin)
    assert abs(gap) < Decimal("0.00001")
    overhead = sum(r.overhead_cost_amount for r in costs.values())
    assert abs(overhead - 10000) < Decimal("0.001")
    assert costs["NOGROUP"].total_patient_cost == Decimal("100")


def test_high_cost_flags(hospital_run):
    wh, *_ = hospital_run
    costs = wh.read("costing.patient_level_cost", 1)
    assert rows(costs.filter("high_cost_flag = 'Y'"), "encounter_id") == [("E05",), ("MULTI",)]
    small = costs.filter("care_type <> 'Inpatient'")
    assert {r[0] for r in rows(small, "review_note")} == {
        "Cohort has fewer than 20 encounters; high-cost comparison not considered stable."
    }


def test_unallocated_and_reconciliation(hospital_run):
    wh, *_ = hospital_run
    unallocated = wh.read("costing.unallocated_cost", 1)
    assert rows(unallocated, "unallocated_reason", "unallocated_amount") == [
        ("EXCLUDED_ADJUSTMENT", Decimal("777")),
        ("FAILED_DIRECT_ASSIGNMENT", Decimal("900")),
        ("UNMAPPED_ACCOUNT", Decimal("333")),
        ("UNMAPPED_COST_CENTRE", Decimal("111")),
        ("UNMAPPED_COST_CENTRE", Decimal("25000")),
        ("ZERO_DRIVER_POOL", Decimal("45000")),
    ]
    recon = wh.read("recon.costing_reconciliation", 1)
    total = one(recon.filter("reconciliation_level = 'TOTAL'"))
    assert total.gl_amount == Decimal(hospital.GL_TOTAL)
    assert abs(total.reconciliation_difference) < Decimal("0.01")
    assert total.reconciliation_status == "PASS"
    # the failed direct item: its pool is 900 short, the row without a pool 900 over
    off = recon.filter("reconciliation_level = 'COST_POOL' AND abs(reconciliation_difference) > 1")
    assert rows(off, "reconciliation_difference") == [(Decimal("-900"),), (Decimal("900"),)]
    assert {r[0] for r in rows(off, "reconciliation_status")} == {"REVIEW"}


def test_no_pool_is_both_allocated_and_unallocated(hospital_run):
    wh, *_ = hospital_run
    keys = ["reporting_month", "cost_pool_code"]
    ready = wh.read("costing.encounter_allocation", 1).select(*keys).distinct()
    lost = wh.read("costing.unallocated_cost", 1).filter("unallocated_reason = 'ZERO_DRIVER_POOL'")
    assert ready.join(lost, keys).count() == 0


def test_funding(hospital_run):
    wh, *_ = hospital_run
    found = {r.encounter_id: r for r in wh.read("costing.abf_comparison", 1).collect()}
    weight = Decimal("0.9")
    expected = {
        "E00": weight * Decimal("1.04"),
        "E01": weight * Decimal("1.06"),
        "E02": weight * Decimal("1.05"),
        "E03": weight + 5 * Decimal("0.04"),
        "E04": weight,
        "SAMEDAY": Decimal("0.75") * Decimal("0.92"),
    }
    for encounter, nwau in expected.items():
        row = found[encounter]
        assert row.synthetic_nwau == nwau
        assert row.synthetic_funding_amount == nwau * 10750
        assert row.cost_funding_variance == row.total_patient_cost - nwau * 10750
    none = found["NOGROUP"]
    assert (none.funding_status, none.synthetic_nwau, none.cost_funding_variance) == ("UNFUNDED_REVIEW", None, None)


def test_issues(hospital_run):
    wh, _, _, ready = hospital_run
    issues = wh.read("dq.issue_register", 1)
    assert rows(issues.groupBy("validation_rule_id").count(), "validation_rule_id", "count") == [
        ("DC_NOT_PROMOTED", 1),
        ("GL_UNKNOWN_COST_CENTRE", 2),
        ("GL_UNMAPPED_ACCOUNT", 1),
        ("RU_NOT_PROMOTED", 1),
        ("ZERO_DRIVER_POOL", 1),
    ]
    negative = one(issues.filter("validation_rule_id = 'RU_NOT_PROMOTED'"))
    assert "pathology_weighted_units=-2" in negative.invalid_value
    assert negative.source_row_number == 29
    results = dict(rows(wh.read("dq.validation_result", 1), "validation_rule_id", "validation_status"))
    assert results == {
        "DC_NOT_PROMOTED": "FAIL",
        "GL_UNKNOWN_COST_CENTRE": "REVIEW",
        "GL_UNMAPPED_ACCOUNT": "REVIEW",
        "RU_NOT_PROMOTED": "FAIL",
        "ZERO_DRIVER_POOL": "REVIEW",
    }
    assert ready[0].publish_flag == "N" and ready[0].blocking_failures == 2
    facts = reporting.fact_data_quality_issue(
        issues, wh.read("dq.validation_result"), wh.read("dq.validation_rule")
    )
    assert facts.count() == 6


def test_running_again_changes_nothing(hospital_run):
    wh, raw, ref, _ = hospital_run
    names = [
        "costing.cost_pool",
        "costing.encounter_driver",
        "costing.patient_level_cost",
        "costing.unallocated_cost",
        "recon.costing_reconciliation",
        "dq.issue_register",
        "ref.cost_centre",
    ]

    def snapshot():
        return {n: sorted(map(str, wh.read(n).collect())) for n in names}

    before = snapshot()
    refresh(wh, raw, ref, EXPECTED, AT, 1, "2024-25").collect()
    assert snapshot() == before


def test_failed_load_is_logged_and_not_current(hospital_run, tmp_path):
    wh, *_ = hospital_run
    with pytest.raises(Exception):
        refresh(wh, str(tmp_path / "missing"), "", EXPECTED, AT, 2)
    assert current_run(wh) == 1


def test_assurance_is_stored(hospital_run):
    wh, *_ = hospital_run
    found = {r.check_id: (r.status, r.observed) for r in wh.read("dq.check_result", 1).collect()}
    assert {"SRC-ROW-CONTROL", "ENC-UNIQUE", "RES-FK", "GL-MONTH-CONTROL", "ABF-CALC", "PLAUS-VOLUME"} <= found.keys()
    assert found["ENC-UNIQUE"] == ("PASS", "0") and found["SRC-ROW-CONTROL"][0] == "PASS"
    assert found["RES-NEG-PATH"][0] == "EXPECTED" and found["GL-MONTH-CONTROL"] == ("PASS", "0")
    assert found["ABF-MONTH-CONTROL"] == ("PASS", "0") and found["PLAUS-VOLUME"][0] == "WARNING"
    status = one(wh.read("dq.check_status", 1))
    assert status.check_count == len(found) and status.overall_status == "FAIL"
    as_lines = wh.spark.read.json(wh.path("controls.check_report.1"))
    assert as_lines.count() == len(found)


def test_statistics_and_controls_are_stored(hospital_run):
    wh, *_ = hospital_run
    ledger = wh.read("dq.ledger_statistic", 1)
    whole = one(ledger.filter("level = 'run'"))
    assert (whole.row_count, whole.signed_amount) == (14, Decimal(hospital.GL_TOTAL))
    for level in ("reporting_month", "adjustment_type"):
        assert one(ledger.filter(F.col("level") == level).agg(F.sum("signed_amount")))[0] == Decimal(hospital.GL_TOTAL)
    extract, control = wh.read("abf.encounter_funding", 1), wh.read("abf.monthly_control_total", 1)
    assert extract.count() == 28 and one(control.agg(F.sum("encounter_count")))[0] == 28
    as_csv = wh.spark.read.option("header", True).csv(wh.path("controls.abf_monthly_control_total.1"))
    assert as_csv.count() == control.count()
    lost = one(wh.read("dq.unallocated_materiality", 1).agg(F.sum("unallocated_amount")))[0]
    assert lost == one(wh.read("costing.unallocated_cost", 1).agg(F.sum("unallocated_amount")))[0]
    odd = wh.read("dq.implausible_resource", 1)
    assert rows(odd.filter("blocking_flag = 'Y'"), "measure", "value") == [("pathology_weighted_units", -2)]


def test_issue_lives_over_two_runs(spark, tmp_path):
    """The second run repairs the negative driver, lands an encounter twice and has a contested rule."""
    raw, ref = hospital.write(tmp_path)
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    refresh(wh, raw, ref, EXPECTED, AT, 1).collect()
    lives = wh.read("dq.issue_life", 1)
    assert {tuple(r) for r in lives.select("issue_status", "first_run_id", "created_at_utc").collect()} == {("OPEN", 1, AT)}
    path = tmp_path / "raw" / "resource_usage.csv"
    path.write_text(path.read_text().replace("-2", "2"))
    path = tmp_path / "raw" / "patient_encounter.csv"
    lines = path.read_text().splitlines()
    again = next(line for line in lines if "E10" in line.split(","))
    path.write_text("\n".join([*lines, again]) + "\n")
    path = tmp_path / "reference" / "allocation_rule.csv"
    ward = next(line for line in path.read_text().splitlines() if line.startswith("RULE_WARD"))
    moved = ward.replace("RULE_WARD", "RULE_WARD2").replace(hospital.FROM, "2025-01-01")
    path.write_text(path.read_text() + moved + "\n")
    later = datetime(2025, 8, 1, 8, 0, 0)
    refresh(wh, raw, ref, EXPECTED, later, 2).collect()
    second = {(r.validation_rule_id, r.issue_status, r.first_run_id) for r in wh.read("dq.issue_life", 2).collect()}
    assert ("RU_NOT_PROMOTED", "RESOLVED", 1) in second and ("DC_NOT_PROMOTED", "OPEN", 1) in second
    # both copies of the encounter are rejected, so what names it is a new issue
    assert ("RU_NOT_PROMOTED", "OPEN", 2) in second
    twice = wh.read("stg.patient_encounter", 2).filter("encounter_id = 'E10'")
    assert rows(twice, "reject_reason") == [("repeated encounter_id",)] * 2
    gone = one(wh.read("dq.issue_life", 2).filter("issue_status = 'RESOLVED' AND validation_rule_id = 'RU_NOT_PROMOTED'"))
    assert (gone.created_at_utc, gone.resolved_at_utc, gone.resolution_note) == (AT, later, "Not found in run 2.")
    # the ward waits for review, every other pool is costed and the total agrees
    costs = wh.read("costing.patient_level_cost", 2)
    assert costs.count() == 27 and costs.filter("total_patient_cost > 0").count() > 20
    pools = wh.read("costing.cost_pool", 2)
    assert one(pools.agg(F.sum("source_gl_amount")))[0] == Decimal(hospital.GL_TOTAL)
    waiting = pools.filter("cost_pool_code = 'WARD_NURSING' AND pool_status = 'REVIEW'")
    assert {r[0] for r in rows(waiting.filter("cost_centre_id = 'CC_WARD' AND natural_account = '500100'"), "review_note")} == {
        K.NOTE_CONTESTED_RULE
    }
    total = one(wh.read("recon.costing_reconciliation", 2).filter("reconciliation_level = 'TOTAL'"))
    assert abs(total.reconciliation_difference) < Decimal("0.01")
