"""A small hand-written hospital with every deliberate exception."""

from __future__ import annotations

import csv
from pathlib import Path

FACILITY = "Main"
FROM, TO = "2024-07-01", "2025-06-30"

REFERENCES = {
    "service_line": ("service_line,description", ["Medical,Medical care", "Emergency,Emergency care"]),
    "care_type": (
        "care_type,description",
        ["Inpatient,Overnight", "Same-day,Same day", "Emergency,Emergency", "Outpatient,Clinic"],
    ),
    "activity_group": (
        "activity_group_code,activity_group_name,default_service_line,default_care_type,official_classification_flag",
        ["AG02,General,Medical,Inpatient,N", "AG04,Minor,Medical,Same-day,N", "AG08,Emergency,Emergency,Emergency,N", "UNCLASSIFIED,None,,,N"],
    ),
    "cost_centre": (
        "cost_centre_id,cost_centre_name,service_line,cost_pool_code,active_flag,effective_from,effective_to",
        [
            f"CC_WARD,Ward,Medical,WARD_NURSING,Y,{FROM},{TO}",
            f"CC_ED,Emergency,Emergency,EMERGENCY_CARE,Y,{FROM},{TO}",
            f"CC_PHARMACY,Pharmacy,All,PHARMACY,Y,{FROM},{TO}",
            f"CC_UNUSED,Rehabilitation,All,ALLIED_SPECIAL,Y,{FROM},{TO}",
            f"CC_ADMIN,Administration,All,PATIENT_ADMIN,Y,{FROM},{TO}",
            f"CC_ICT,ICT,All,OVERHEAD,Y,{FROM},{TO}",
            "CC_OLD,Closed,All,WARD_NURSING,Y,2020-07-01,2024-06-30",
        ],
    ),
    "account_mapping": (
        "natural_account,account_description,cost_category,costing_treatment,default_driver,active_flag",
        [
            "500100,Nursing,Nursing,Indirect,bed_days,Y",
            "510400,Pharmaceuticals,Pharmacy,Indirect,pharmacy_units,Y",
            "510500,Allied health,Allied Health,Indirect,allied_health_units,Y",
            "520100,Administration,Patient Administration,Indirect,encounter_count,Y",
            "530100,ICT,Overhead,Overhead,pre_overhead_cost,Y",
            "540200,Patient pharmacy,Pharmacy,Direct,direct_assignment,Y",
            "590100,Depreciation,Capital,Exclude,review,Y",
        ],
    ),
    "allocation_rule": (
        "allocation_rule_id,cost_pool_code,cost_category,allocation_driver,eligible_scope,business_rationale,effective_from,effective_to,active_flag",
        [
            f"RULE_WARD,WARD_NURSING,Nursing,bed_days,Inpatient|Same-day,Days,{FROM},{TO},Y",
            f"RULE_ED,EMERGENCY_CARE,Nursing,encounter_count,Emergency,Volume,{FROM},{TO},Y",
            f"RULE_PHARMACY,PHARMACY,Pharmacy,pharmacy_units,All,Units,{FROM},{TO},Y",
            f"RULE_ADMIN,PATIENT_ADMIN,Patient Administration,encounter_count,All,Volume,{FROM},{TO},Y",
            f"RULE_OVERHEAD,OVERHEAD,Overhead,pre_overhead_cost,All,Cost,{FROM},{TO},Y",
        ],
    ),
    "reporting_period": (
        "reporting_month,period_start,period_end,financial_year,period_number",
        ["2025-01-01,2025-01-01,2025-01-31,2024-25,7", "2025-02-01,2025-02-01,2025-02-28,2024-25,8"],
    ),
    "abf_activity_group": (
        "activity_group_code,activity_group_name,service_stream,synthetic_base_weight,high_length_of_stay_trim_days,synthetic_outlier_nwau_per_day,official_price_weight_flag",
        ["AG02,General,Admitted acute,0.9000,7,0.0400,N", "AG04,Minor,Admitted acute,0.7500,1,0.0300,N", "AG08,Emergency,Emergency,0.3500,0,0.0000,N"],
    ),
    "abf_adjustment_rule": (
        "adjustment_code,description,factor,application,official_adjustment_flag",
        ["INDIGENOUS,a,1.0400,Multiplicative,N", "REMOTE,b,1.0600,Multiplicative,N", "PAEDIATRIC,c,1.0500,Multiplicative,N", "SAME_DAY,d,0.9200,Multiplicative,N", "LONG_STAY,e,Varies by group,Additive NWAU,N"],
    ),
}

ENCOUNTER_HEADER = "encounter_id,patient_id,facility,service_line,care_type,admission_date,discharge_date,episode_month,activity_group_code,length_of_stay,separation_status,age_years,indigenous_status,remoteness_area,high_complexity_flag,hospital_acquired_complication_flag"
RESOURCE_HEADER = "resource_usage_id,encounter_id,service_month,bed_days,theatre_minutes,imaging_weighted_units,pathology_weighted_units,pharmacy_units,medical_service_units,allied_health_units"
DIRECT_HEADER = "direct_cost_id,encounter_id,service_month,cost_centre_id,natural_account,direct_cost_type,quantity,amount"
LEDGER_HEADER = "gl_transaction_id,reporting_month,entity,facility,cost_centre_id,natural_account,account_description,signed_amount,adjustment_type,source_reference"


def encounters() -> list[list]:
    rows = []
    for i in range(24):  # a cohort large enough to compare
        rows.append([f"E{i:02d}", f"P{i:02d}", FACILITY, "Medical", "Inpatient", "2025-01-10", "2025-01-13", "2025-01-01", "AG02", 3, "Discharged", 40 + i, "N", "Major Cities", "N", "N"])
    rows[0][12] = "Y"  # Indigenous
    rows[1][13] = "Remote"
    rows[2][11] = 9  # paediatric
    rows[3][9] = 12  # five days above the trim point
    # a stay over two months
    rows.append(["MULTI", "P50", FACILITY, "Medical", "Inpatient", "2025-01-28", "2025-02-06", "2025-01-01", "AG02", 9, "Discharged", 60, "N", "Major Cities", "Y", "N"])
    rows.append(["SAMEDAY", "P51", FACILITY, "Medical", "Same-day", "2025-01-15", "2025-01-15", "2025-01-01", "AG04", 0, "Discharged", 30, "N", "Major Cities", "N", "N"])
    rows.append([" ED1 ", "P52", FACILITY, "Emergency", " Emergency", "2025-01-20", "2025-01-20", "2025-01-01", "AG08", 0, "Discharged", 70, "N", "Major Cities", "N", "N"])
    rows.append(["NOGROUP", "P53", FACILITY, "Emergency", "Emergency", "2025-02-20", "2025-02-20", "2025-02-01", "UNCLASSIFIED", 0, "Discharged", 20, "N", "Major Cities", "N", "N"])
    rows.append(["BADDATE", "P54", FACILITY, "Medical", "Inpatient", "not-a-date", "2025-01-13", "2025-01-01", "AG02", 3, "Discharged", 40, "N", "Major Cities", "N", "N"])
    rows.append(["BACKWARD", "P55", FACILITY, "Medical", "Inpatient", "2025-01-13", "2025-01-10", "2025-01-01", "AG02", 3, "Discharged", 40, "N", "Major Cities", "N", "N"])
    return rows


def resources() -> list[list]:
    rows = [[f"R{i:02d}", f"E{i:02d}", "2025-01-01", 3, 0, 1, 2, i + 1, 4, 1] for i in range(24)]
    rows.append(["RM1", "MULTI", "2025-01-01", 4, 0, 1, 2, 6, 4, 1])
    rows.append(["RM2", "MULTI", "2025-02-01", 5, 0, 1, 2, 5, 4, 1])
    rows.append(["RS", "SAMEDAY", "2025-01-01", 0, 65, 1, 1, 2, 3, 0])
    rows.append(["RNEG", "E00", "2025-01-01", 1, 0, 1, -2, 1, 1, 1])  # negative driver
    return rows


def direct_costs() -> list[list]:
    return [
        ["D1", "E05", "2025-01-01", "CC_PHARMACY", "540200", "Medicine", 1, "5000.00"],
        ["D2", "E06", "2025-01-01", "CC_PHARMACY", "540200", "Medicine", 2, "250.00"],
        ["D3", "ENC_NOT_FOUND", "2025-01-01", "CC_PHARMACY", "540200", "Medicine", 1, "900.00"],
    ]


def ledger() -> list[list]:
    def row(i, month, centre, account, amount, kind="Standard expense", ref="MONTHLY"):
        return [f"G{i:02d}", month, "Service", FACILITY, centre, account, "text", amount, kind, ref]

    return [
        row(1, "2025-01-01", "CC_WARD", "500100", "76000.00"),
        row(2, "2025-02-01", "CC_WARD", "500100", "5000.00"),
        row(3, "2025-01-01", "CC_ED", "500100", "1234.56"),
        row(4, "2025-01-01", "CC_PHARMACY", "510400", "30800.00"),
        row(5, "2025-01-01", "CC_PHARMACY", "510400", "-24000.00", "Credit"),
        row(6, "2025-01-01", "CC_PHARMACY", "540200", "6150.00", ref="DIRECT-CONTROL-2025-01-01"),
        row(7, "2025-01-01", "CC_UNUSED", "510500", "45000.00"),
        row(8, "2025-01-01", "CC_UNKNOWN", "500100", "25000.00"),
        row(9, "2025-01-01", "CC_ADMIN", "520100", "2700.00"),
        row(10, "2025-02-01", "CC_ADMIN", "520100", "100.00"),
        row(11, "2025-01-01", "CC_ICT", "530100", "10000.00"),
        row(12, "2025-01-01", "CC_ADMIN", "590100", "777.00"),
        row(13, "2025-01-01", "CC_WARD", "999999", "333.00"),
        row(14, "2025-01-01", "CC_OLD", "500100", "111.00"),
    ]


GL_TOTAL = "179205.56"


def write(folder: Path) -> tuple[str, str]:
    """Write raw and reference extracts; returns both folders."""
    raw, ref = folder / "raw", folder / "reference"
    raw.mkdir(parents=True)
    ref.mkdir()
    for name, header, rows in (
        ("patient_encounter", ENCOUNTER_HEADER, encounters()),
        ("resource_usage", RESOURCE_HEADER, resources()),
        ("direct_cost_detail", DIRECT_HEADER, direct_costs()),
        ("general_ledger_transaction", LEDGER_HEADER, ledger()),
    ):
        with (raw / f"{name}.csv").open("w", newline="", encoding="utf-8") as handle:
            writer = csv.writer(handle)
            writer.writerow(header.split(","))
            writer.writerows(rows)
    for name, (header, lines) in REFERENCES.items():
        (ref / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(raw), str(ref)
