"""Assurance checks as aggregates: (check_id, area, status, message, observed, expected).

Each area reads its tables once. Value coverage is tested with one flag per
expected value, never by collecting the values that occur.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import (
    count_when,
    quoted,
    safe_ratio,
    side_by_side,
    stacked,
    zero_if_null,
)
from costweave.operators.funding import monthly_funding_control
from costweave.schemas import MEASURES, MONEY, POOL_AMOUNT, RUN, TOTAL
from costweave.session import lookup

CHECK_COLUMNS = ["check_id", "area", "status", "message", "observed", "expected"]


# What a year of the hospital is expected to contain
@dataclass(frozen=True)
class Expectations:
    service_lines: Sequence[str] = (
        "Medical",
        "Surgical",
        "Women's and Children's",
        "Mental Health",
        "Emergency",
        "Outpatients",
    )
    care_types: Sequence[str] = ("Inpatient", "Same-day", "Emergency", "Outpatient")
    months: Sequence[str] = tuple(f"2024-{m:02d}-01" for m in range(7, 13)) + tuple(
        f"2025-{m:02d}-01" for m in range(1, 7)
    )
    theatre_lines: Sequence[str] = ("Surgical", "Women's and Children's")
    negative_types: Sequence[str] = ("Credit", "Reversal")
    unknown_centre: str = "CC_UNKNOWN"
    unknown_encounter: str = "ENC_NOT_FOUND"
    unclassified: str = "UNCLASSIFIED"
    zero_driver_centre: str = "CC_ALLIED_UNUSED"
    zero_driver_amount: Decimal = Decimal("45000.00")
    volume: tuple[int, int] = (5000, 10000)
    factor_range: tuple[Decimal, Decimal] = (Decimal("0.85"), Decimal("1.20"))
    funding_range: tuple[Decimal, Decimal] = (Decimal("0.80"), Decimal("1.20"))
    month_ratio: Decimal = Decimal("1.50")
    theatre_share: Decimal = Decimal("0.95")
    admitted: Sequence[str] = ("Inpatient", "Same-day")
    not_admitted: Sequence[str] = ("Emergency", "Outpatient")
    no_stay: Sequence[str] = ("Same-day", "Emergency", "Outpatient")


YEAR = Expectations()


@dataclass(frozen=True)
class Check:
    """A verdict over one aggregated row."""

    id: str
    ok: Column
    message: str
    observed: Column
    expected: str = ""
    good: str = "PASS"
    bad: str = field(default="ERROR")


def verdicts(totals: DataFrame, area: str, checks: Sequence[Check]) -> DataFrame:
    """Turn one row of totals into one row per check."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c.id).alias("check_id"),
                F.lit(area).alias("area"),
                F.when(F.coalesce(c.ok, F.lit(False)), c.good).otherwise(c.bad).alias("status"),
                F.lit(c.message).alias("message"),
                F.coalesce(c.observed.cast("string"), F.lit("")).alias("observed"),
                F.lit(c.expected).alias("expected"),
            )
            for c in checks
        ]
    )
    return totals.select(F.explode(rows).alias("c")).select("c.*")


def _coverage(column: str, allowed: Sequence[str], name: str) -> list[Column]:
    """Expected values that occur, and rows outside them."""
    value = F.col(column).cast("string")
    present = [F.max(F.when(value == v, 1).otherwise(0)) for v in allowed]
    found = present[0]
    for p in present[1:]:
        found = found + p
    return [
        found.alias(f"{name}_found"),
        count_when(~value.isin(*allowed)).alias(f"{name}_other"),
    ]


def _covered(name: str, allowed: Sequence[str]) -> Column:
    return (F.col(f"{name}_found") == len(allowed)) & (F.col(f"{name}_other") == 0)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Business keys that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def table_checks(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Required columns present, with the row count of each table."""
    result = None
    for name, columns in required.items():
        df = tables.get(name)
        missing = sorted(set(columns) - set(df.columns)) if df is not None else sorted(columns)
        spark = next(iter(tables.values())).sparkSession
        counted = (
            spark.range(1).select(F.lit(0).alias("n"))
            if df is None
            else df.agg(F.count(F.lit(1)).alias("n"))
        )
        row = verdicts(
            counted,
            "Files",
            [
                Check(
                    f"FILE-{name}",
                    F.lit(not missing),
                    "Table and required columns are present",
                    F.col("n") if not missing else F.lit(", ".join(missing)),
                )
            ],
        )
        result = row if result is None else result.unionByName(row)
    return result


def row_control_check(controls: DataFrame) -> DataFrame:
    """All controlled files landed with the expected number of rows."""
    totals = controls.agg(
        count_when(F.col("control_status") != "PASS").alias("bad"), F.count(F.lit(1)).alias("n")
    )
    return verdicts(
        totals,
        "Source controls",
        [
            Check(
                "SRC-ROW-CONTROL",
                F.col("bad") == 0,
                "All controlled source row counts agree",
                F.col("n"),
            )
        ],
    )


def encounter_checks(
    encounters: DataFrame, resource: DataFrame, expect: Expectations = YEAR
) -> DataFrame:
    """Keys, coverage, dates, ages, stay lengths and deliberate exceptions."""
    los = F.col("length_of_stay")
    totals = encounters.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(RUN, "encounter_id").alias("ids"),
        *_coverage("service_line", expect.service_lines, "line"),
        *_coverage("care_type", expect.care_types, "care"),
        *_coverage("episode_month", expect.months, "month"),
        count_when((F.col("discharge_date") < F.col("admission_date")) | (los < 0)).alias("dates"),
        count_when(~F.col("age_years").between(0, 110)).alias("ages"),
        count_when(
            (F.col("care_type").isin(*expect.no_stay) & (los != 0))
            | ((F.col("care_type") == "Inpatient") & (los < 1))
        ).alias("stays"),
        count_when(F.col("activity_group_code") == expect.unclassified).alias("unclassified"),
    )
    several = (
        resource.groupBy(RUN, "encounter_id")
        .agg(F.min("service_month").alias("a"), F.max("service_month").alias("b"))
        .agg(count_when(F.col("a") < F.col("b")).alias("several"))
    )
    return verdicts(
        side_by_side(totals, several),
        "Encounters",
        [
            Check("ENC-UNIQUE", F.col("n") == F.col("ids"), "Encounter IDs are unique", F.col("n") - F.col("ids"), "0"),
            Check("ENC-SERVICES", _covered("line", expect.service_lines), "Service lines as expected", F.col("line_found"), str(len(expect.service_lines))),
            Check("ENC-CARE", _covered("care", expect.care_types), "Care types as expected", F.col("care_found"), str(len(expect.care_types))),
            Check("ENC-MONTHS", _covered("month", expect.months), "Months as expected", F.col("month_found"), str(len(expect.months))),
            Check("ENC-DATES", F.col("dates") == 0, "Dates and length of stay agree", F.col("dates"), "0"),
            Check("ENC-AGE", F.col("ages") == 0, "Ages are within 0-110", F.col("ages"), "0"),
            Check("ENC-CARE-LOS", F.col("stays") == 0, "Care type and length of stay agree", F.col("stays"), "0"),
            Check("ENC-UNCLASSIFIED", F.col("unclassified") == 1, "One deliberate unclassified encounter", F.col("unclassified"), "1", good="EXPECTED"),
            Check("ENC-MULTI-MONTH", F.col("several") > 0, "Stays over several months are present", F.col("several"), ">0"),
        ],
    )


def resource_checks(
    resource: DataFrame, encounters: DataFrame, expect: Expectations = YEAR
) -> DataFrame:
    """Keys, orphans, negative measures, bed days and theatre concentration."""
    known = encounters.select(
        RUN, "encounter_id", "care_type", "service_line", F.lit(True).alias("_known")
    )
    joined = resource.join(known, [RUN, "encounter_id"], "left")
    others = [m for m in MEASURES if m != "pathology_weighted_units"]
    negative_others = count_when(F.col(others[0]) < 0)
    for m in others[1:]:
        negative_others = negative_others + count_when(F.col(m) < 0)

    def total(condition: Column, measure: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(measure).cast("long"))), F.lit(0))

    totals = joined.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(RUN, "resource_usage_id").alias("ids"),
        count_when(F.col("_known").isNull()).alias("orphans"),
        count_when(F.col("pathology_weighted_units") < 0).alias("pathology"),
        negative_others.alias("others"),
        total(F.col("care_type").isin(*expect.admitted), "bed_days").alias("admitted"),
        total(F.col("care_type").isin(*expect.not_admitted), "bed_days").alias("not_admitted"),
        total(F.col("service_line").isin(*expect.theatre_lines), "theatre_minutes").alias("theatre"),
        total(F.lit(True), "theatre_minutes").alias("all_theatre"),
    ).withColumn(
        "share",
        F.coalesce(
            safe_ratio(F.col("theatre").cast("decimal(19,0)"), F.col("all_theatre").cast("decimal(19,0)")),
            F.lit(0),
        ),
    )
    return verdicts(
        totals,
        "Resources",
        [
            Check("RES-UNIQUE", F.col("n") == F.col("ids"), "Resource usage IDs are unique", F.col("n") - F.col("ids"), "0"),
            Check("RES-FK", F.col("orphans") == 0, "All rows name a known encounter", F.col("orphans"), "0"),
            Check("RES-NEG-PATH", F.col("pathology") == 1, "One deliberate negative pathology driver", F.col("pathology"), "1", good="EXPECTED"),
            Check("RES-NEG-OTHER", F.col("others") == 0, "No other negative measure", F.col("others"), "0"),
            Check("RES-BED-DAY", (F.col("admitted") > 0) & (F.col("not_admitted") == 0), "Bed days are confined to admitted care", F.col("not_admitted"), "0"),
            Check("RES-THEATRE", F.col("share") >= F.lit(expect.theatre_share), "Theatre minutes lie with procedural services", F.col("share").cast("decimal(9,4)"), f">={expect.theatre_share}", bad="WARNING"),
        ],
    )


def control_differences(control: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Control rows whose total differs; keys only the actual side has are ignored."""
    return control.join(actual, keys, "left").filter(
        ~F.col("expected_signed_gl_total").eqNullSafe(zero_if_null("signed_gl_total"))
    )


def _control_check(id_: str, control: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    totals = control_differences(control, actual, keys).agg(F.count(F.lit(1)).alias("n"))
    return verdicts(
        totals,
        "Financial",
        [Check(id_, F.col("n") == 0, "Ledger totals match controls", F.col("n"), "0")],
    )


def direct_control_differences(direct: DataFrame, ledger: DataFrame) -> DataFrame:
    """Month, centre and account where direct items and their ledger rows differ."""
    keys = ["reporting_month", "cost_centre_id", "natural_account"]
    items = (
        direct.withColumnRenamed("service_month", "reporting_month")
        .groupBy(*keys)
        .agg(F.sum("amount").cast(TOTAL).alias("direct_total"))
    )
    posted = (
        ledger.filter(F.col("source_reference").startswith("DIRECT-CONTROL-"))
        .groupBy(*keys)
        .agg(F.sum("signed_amount").cast(TOTAL).alias("ledger_total"))
    )
    return items.join(posted, keys, "left").filter(
        ~F.col("direct_total").eqNullSafe(F.col("ledger_total"))
    )


def financial_checks(
    ledger: DataFrame,
    direct: DataFrame,
    encounters: DataFrame,
    cost_centres: DataFrame,
    accounts: DataFrame,
    monthly_control: DataFrame,
    centre_control: DataFrame,
    expect: Expectations = YEAR,
) -> DataFrame:
    """Ledger keys, mappings, signs, controls and deliberate exceptions."""
    amount = F.col("signed_amount")
    centres = lookup(cost_centres.select("cost_centre_id").distinct()).withColumn("_centre", F.lit(True))
    known = lookup(accounts.select("natural_account").distinct()).withColumn("_account", F.lit(True))
    unknown = F.col("_centre").isNull()
    zero_pool = F.coalesce(
        F.sum(F.when(F.col("cost_centre_id") == expect.zero_driver_centre, amount)), F.lit(0)
    ).cast("decimal(19,2)")
    totals = (
        ledger.join(centres, "cost_centre_id", "left")
        .join(known, "natural_account", "left")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct(RUN, "gl_transaction_id").alias("ids"),
            count_when(unknown).alias("no_centre"),
            count_when(unknown & (F.col("cost_centre_id") == expect.unknown_centre)).alias("planned"),
            count_when(F.col("_account").isNull()).alias("no_account"),
            count_when(amount < 0).alias("negative"),
            count_when((amount < 0) & ~F.col("adjustment_type").isin(*expect.negative_types)).alias("odd"),
            zero_pool.alias("zero_pool"),
        )
    )
    ledger_rows = verdicts(
        totals,
        "Financial",
        [
            Check("GL-UNIQUE", F.col("n") == F.col("ids"), "GL transaction IDs are unique", F.col("n") - F.col("ids"), "0"),
            Check("GL-UNKNOWN-CC", (F.col("no_centre") == 1) & (F.col("planned") == 1), "One deliberate unmapped cost centre", F.col("no_centre"), "1", good="EXPECTED"),
            Check("GL-UNKNOWN-ACCOUNT", F.col("no_account") == 0, "All accounts are mapped", F.col("no_account"), "0"),
            Check("GL-NEGATIVE", (F.col("negative") > 0) & (F.col("odd") == 0), "Negative amounts are credits or reversals", F.col("negative"), ">0"),
            Check("GL-ZERO-DRIVER", F.col("zero_pool") == F.lit(expect.zero_driver_amount), "Deliberate zero-driver pool is present", F.col("zero_pool"), str(expect.zero_driver_amount), good="EXPECTED"),
        ],
    )
    orphans = direct.join(encounters.select(RUN, "encounter_id"), [RUN, "encounter_id"], "left_anti")
    failed = orphans.agg(
        F.count(F.lit(1)).alias("n"),
        count_when(F.col("encounter_id") == expect.unknown_encounter).alias("planned"),
    )
    by_month = ["reporting_month"]
    by_centre = ["reporting_month", "cost_centre_id"]

    def actual(keys):
        return ledger.groupBy(*keys).agg(F.sum(amount).cast(TOTAL).alias("signed_gl_total"))

    direct_diff = direct_control_differences(direct, ledger).agg(F.count(F.lit(1)).alias("n"))
    return (
        ledger_rows.unionByName(
            verdicts(
                failed,
                "Financial",
                [Check("DIR-FAILED", (F.col("n") == 1) & (F.col("planned") == 1), "One deliberate failed direct assignment", F.col("n"), "1", good="EXPECTED")],
            )
        )
        .unionByName(_control_check("GL-MONTH-CONTROL", monthly_control, actual(by_month), by_month))
        .unionByName(_control_check("GL-CC-CONTROL", centre_control, actual(by_centre), by_centre))
        .unionByName(
            verdicts(
                direct_diff,
                "Financial",
                [Check("GL-DIRECT-CONTROL", F.col("n") == 0, "Direct items agree with the ledger", F.col("n"), "0")],
            )
        )
    )


def funding_checks(
    funding: DataFrame,
    encounters: DataFrame,
    groups: DataFrame,
    monthly_control: DataFrame,
    expect: Expectations = YEAR,
) -> DataFrame:
    """Population, arithmetic, price, monthly controls and group references."""
    calculated = F.col("funding_status") == "CALCULATED"
    nwau, price = F.col("final_synthetic_nwau"), F.col("synthetic_base_price")
    off = F.abs(F.col("estimated_synthetic_funding") - F.round(nwau * price, 2)) > F.lit(Decimal("0.01"))
    low, high = expect.factor_range
    wrong = off | (nwau <= 0) | ~F.col("demographic_adjustment_factor").between(F.lit(low), F.lit(high))
    has_group = lookup(groups.select("activity_group_code").distinct()).withColumn("_group", F.lit(True))
    totals = funding.join(has_group, "activity_group_code", "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(RUN, "encounter_id").alias("ids"),
        count_when(F.col("funding_status") == "UNFUNDED_REVIEW").alias("unfunded"),
        count_when(
            (F.col("funding_status") == "UNFUNDED_REVIEW")
            & (F.col("activity_group_code") == expect.unclassified)
        ).alias("planned"),
        count_when(calculated & wrong).alias("wrong"),
        F.min(F.when(calculated, price)).alias("least"),
        F.max(F.when(calculated, price)).alias("most"),
        count_when(calculated & F.col("_group").isNull()).alias("no_group"),
    )
    key = [RUN, "encounter_id"]
    people = encounters.select(*key)
    both = (
        funding.select(*key, F.lit(1).alias("f"), F.lit(0).alias("e"))
        .unionByName(people.select(*key, F.lit(0).alias("f"), F.lit(1).alias("e")))
        .groupBy(*key)
        .agg(F.sum("f").alias("f"), F.sum("e").alias("e"))
        .agg(count_when((F.col("f") == 0) | (F.col("e") == 0)).alias("one_sided"))
    )
    names = [
        "encounter_count",
        "funded_encounter_count",
        "unfunded_review_count",
        "total_synthetic_nwau",
        "total_estimated_synthetic_funding",
    ]
    actual = monthly_funding_control(funding).select(
        "episode_month", *[F.col(c).alias(f"_{c}") for c in names]
    )
    differs = F.lit(False)
    for c in names:
        differs = differs | ~F.col(c).eqNullSafe(F.coalesce(F.col(f"_{c}"), F.lit(0)))
    monthly = (
        monthly_control.join(actual, "episode_month", "left")
        .agg(count_when(differs).alias("months"))
    )
    return verdicts(
        side_by_side(totals, both, monthly),
        "ABF",
        [
            Check("ABF-POPULATION", (F.col("n") == F.col("ids")) & (F.col("one_sided") == 0), "Funding and encounter populations agree", F.col("one_sided"), "0"),
            Check("ABF-UNFUNDED", (F.col("unfunded") == 1) & (F.col("planned") == 1), "One unclassified encounter is held for review", F.col("unfunded"), "1", good="EXPECTED"),
            Check("ABF-CALC", F.col("wrong") == 0, "Funding arithmetic is consistent", F.col("wrong"), "0"),
            Check("ABF-PRICE", F.col("least") == F.col("most"), "One base price is applied", F.col("most").cast("decimal(19,2)")),
            Check("ABF-MONTH-CONTROL", F.col("months") == 0, "Monthly funding controls agree", F.col("months"), "0"),
            Check("ABF-GROUPS", F.col("no_group") == 0, "All funded groups have a reference row", F.col("no_group"), "0"),
        ],
    )


def plausibility_checks(
    encounters: DataFrame, ledger: DataFrame, funding: DataFrame, expect: Expectations = YEAR
) -> DataFrame:
    """Volume, service mix, month spread and the funding to cost ratio."""
    counts = encounters.groupBy("service_line", "episode_month").agg(F.count(F.lit(1)).alias("n"))
    lines = counts.groupBy("service_line").agg(F.sum("n").alias("n"))
    months = counts.groupBy("episode_month").agg(F.sum("n").alias("n"))
    volume = counts.agg(F.sum("n").alias("n"))
    floor = F.greatest(F.lit(100), volume.scalar() * F.lit(Decimal("0.02")))
    small = lines.filter(F.col("n") < floor).agg(F.count(F.lit(1)).alias("small"))
    spread = months.agg(F.min("n").alias("least"), F.max("n").alias("most"))
    spent = ledger.agg(F.sum("signed_amount").alias("gl"))
    funded = funding.filter(F.col("funding_status") == "CALCULATED").agg(
        F.sum("estimated_synthetic_funding").alias("funding")
    )
    ratio = safe_ratio(F.col("funding").cast(POOL_AMOUNT), F.col("gl").cast(POOL_AMOUNT))
    low, high = expect.funding_range
    return verdicts(
        side_by_side(volume, small, spread, spent, funded).withColumn("ratio", ratio),
        "Plausibility",
        [
            Check("PLAUS-VOLUME", F.col("n").between(*expect.volume), "Encounter volume", F.col("n"), f"{expect.volume[0]}-{expect.volume[1]}", bad="WARNING"),
            Check("PLAUS-SERVICE-MIX", F.col("small") == 0, "Service lines are large enough", F.col("small"), "0", bad="WARNING"),
            Check("PLAUS-MONTH-VOLUME", F.col("most") <= F.col("least") * F.lit(expect.month_ratio), "Monthly volumes are even", F.concat_ws("-", "least", "most"), f"<={expect.month_ratio}", bad="WARNING"),
            Check("PLAUS-COST-FUNDING", F.col("ratio").between(F.lit(low), F.lit(high)), "Funding is calibrated to cost", F.col("ratio").cast("decimal(9,4)"), f"{low}-{high}", bad="WARNING"),
        ],
    )


def status_counts(checks: DataFrame) -> DataFrame:
    """Checks per status."""
    return checks.groupBy("status").agg(F.count(F.lit(1)).alias("check_count"))


def overall_status(checks: DataFrame) -> DataFrame:
    """FAIL as soon as one check is an error."""
    return checks.agg(
        F.count(F.lit(1)).alias("check_count"),
        F.when(count_when(F.col("status") == "ERROR") > 0, "FAIL").otherwise("PASS").alias("overall_status"),
    )


def implausible_resources(resource: DataFrame) -> DataFrame:
    """Measures outside their plausible range, with severity. Negative is blocking.

    Described by the quality design and not part of its stored procedures.
    """
    rows = [
        [quoted(m), m, str(upper), quoted(severity)]
        for m, (upper, severity) in K.PLAUSIBLE_RANGES.items()
    ]
    names = ["measure", "value", "upper_limit", "severity"]
    return (
        resource.select(
            RUN, "resource_usage_id", "encounter_id", "service_month", stacked(rows, names)
        )
        .filter((F.col("value") < 0) | (F.col("value") > F.col("upper_limit")))
        .withColumn("blocking_flag", F.when(F.col("value") < 0, "Y").otherwise("N"))
    )


def readiness(
    results: DataFrame, rules: DataFrame, controls: DataFrame, reconciliation: DataFrame
) -> DataFrame:
    """Whether a run may be published.

    Ready when every active blocking rule has a result and passed, there are file
    controls and all passed, and the total reconciles. What is missing counts as
    failed. Described by the quality design, not part of its procedures.
    """
    active = rules.filter((F.col("blocking_flag") == "Y") & (F.col("active_flag") == "Y"))
    total_rules = active.agg(F.countDistinct("validation_rule_id")).first()[0]
    blocking = (
        results.join(lookup(active.select("validation_rule_id")), "validation_rule_id")
        .groupBy(RUN, "validation_rule_id")
        .agg(count_when(F.col("validation_status") != "PASS").alias("failed"))
        .groupBy(RUN)
        .agg(
            (count_when(F.col("failed") > 0) + F.lit(total_rules) - F.count(F.lit(1))).alias("blocking_failures")
        )
    )
    files = controls.groupBy(RUN).agg(
        count_when(~F.col("control_status").eqNullSafe("PASS")).alias("failed_controls")
    )
    total = reconciliation.filter(F.col("reconciliation_level") == "TOTAL").select(
        RUN, F.col("reconciliation_status").alias("total_status")
    )
    ready = (
        (F.col("blocking_failures") == 0)
        & F.col("failed_controls").eqNullSafe(0)
        & F.col("total_status").eqNullSafe("PASS")
    )
    return (
        total.join(blocking, RUN, "left")
        .withColumn("blocking_failures", F.coalesce("blocking_failures", F.lit(total_rules)))
        .join(files, RUN, "left")
        .withColumn("publish_flag", F.when(ready, "Y").otherwise("N"))
    )
