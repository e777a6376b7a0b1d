"""Validation rules: per-run results and the row-level issue register."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import describe, inline
from costweave.operators.mapping import Mapping, effective_join
from costweave.operators.pools import POOL_KEY
from costweave.schemas import MEASURES, MONEY, POOL_AMOUNT, RUN, TOTAL

RESULT_COLUMNS = [
    RUN,
    "validation_rule_id",
    "evaluated_row_count",
    "failed_row_count",
    "affected_amount",
    "validation_status",
    "result_message",
]
ISSUE_COLUMNS = [
    RUN,
    "validation_rule_id",
    "source_entity",
    "source_file_name",
    "source_row_number",
    "business_key",
    "field_name",
    "invalid_value",
    "financial_impact",
    "issue_status",
    "recommended_owner",
    "recommended_action",
]


def rule_catalogue(spark: SparkSession) -> DataFrame:
    """Severity, blocking and active flag of every rule."""
    return inline(spark, K.RULES, ", ".join(f"{c} string" for c in K.RULE_COLUMNS))


def with_missing(results: DataFrame, run: int, rules: list[str]) -> DataFrame:
    """``results`` and a PASS over no rows for every rule of ``rules`` without a result in ``run``.

    Grouping by run leaves no row for an empty extract, but a rule that looked at
    nothing was looked at.
    """
    texts = [(rule, K.RULE_TEXTS[rule][0]) for rule in rules]
    expected = inline(results.sparkSession, texts, "validation_rule_id string, result_message string")
    absent = expected.join(results.filter(F.col(RUN) == run), "validation_rule_id", "left_anti")
    empty = absent.select(
        F.lit(run).cast("long").alias(RUN),
        "validation_rule_id",
        F.lit(0).cast("long").alias("evaluated_row_count"),
        F.lit(0).cast("long").alias("failed_row_count"),
        F.lit(None).cast(TOTAL).alias("affected_amount"),
        F.lit("PASS").alias("validation_status"),
        "result_message",
    )
    return results.unionByName(empty)


def _result(df: DataFrame, rule: str, failed: Column, amount: Column | None, bad: str) -> DataFrame:
    """Evaluated, failed and affected amount of one rule, in one aggregate."""
    failures = F.count(F.when(failed, 1))
    affected = (
        F.lit(None)
        if amount is None
        else F.sum(F.when(failed, amount).otherwise(F.lit(0).cast(MONEY)))
    )
    return (
        df.groupBy(RUN)
        .agg(
            F.count(F.lit(1)).alias("evaluated_row_count"),
            failures.alias("failed_row_count"),
            affected.cast(TOTAL).alias("affected_amount"),
        )
        .withColumns(
            {
                "validation_rule_id": F.lit(rule),
                "validation_status": F.when(F.col("failed_row_count") == 0, "PASS").otherwise(bad),
                "result_message": F.lit(K.RULE_TEXTS[rule][0]),
            }
        )
        .select(*RESULT_COLUMNS)
    )


def _issues(df: DataFrame, rule: str, entity: str, **columns: Column) -> DataFrame:
    _, field, owner, action = K.RULE_TEXTS[rule]
    fixed = {
        "validation_rule_id": F.lit(rule),
        "source_entity": F.lit(entity),
        "field_name": F.lit(field),
        "issue_status": F.lit("OPEN"),
        "recommended_owner": F.lit(owner),
        "recommended_action": F.lit(action),
    }
    # one type for all rules: their slices are files of one table
    columns = {**columns, "financial_impact": columns["financial_impact"].cast(POOL_AMOUNT)}
    values = {**fixed, **columns}
    return df.select(*[values.get(c, F.col(c)).alias(c) for c in ISSUE_COLUMNS])


def resource_not_promoted(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Result and issues for resource rows that were not staged."""
    failed = F.col("reject_reason").isNotNull()
    landed = F.col("landed")
    issues = _issues(
        classified.filter(failed),
        "RU_NOT_PROMOTED",
        "resource_usage",
        business_key=landed["resource_usage_id"],
        invalid_value=describe(**{c: landed[c] for c in ("encounter_id", *MEASURES)}),
        financial_impact=F.lit(None).cast(MONEY),
    )
    return _result(classified, "RU_NOT_PROMOTED", failed, None, "FAIL"), issues


def direct_not_promoted(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Result and issues for direct items that were not staged, with their amount."""
    failed = F.col("reject_reason").isNotNull()
    landed = F.col("landed")
    amount = landed["amount"].try_cast(MONEY)
    shown = (
        "encounter_id",
        "service_month",
        "cost_centre_id",
        "natural_account",
        "quantity",
        "amount",
    )
    issues = _issues(
        classified.filter(failed),
        "DC_NOT_PROMOTED",
        "direct_cost_detail",
        business_key=landed["direct_cost_id"],
        invalid_value=describe(**{c: landed[c] for c in shown}),
        financial_impact=amount,
    )
    return _result(classified, "DC_NOT_PROMOTED", failed, amount, "FAIL"), issues


def _ledger_rule(
    with_flag: DataFrame, rule: str, column: str
) -> tuple[DataFrame, DataFrame]:
    missing = F.col("_found").isNull()
    issues = _issues(
        with_flag.filter(missing),
        rule,
        "general_ledger_transaction",
        business_key=F.col("gl_transaction_id"),
        invalid_value=F.col(column),
        financial_impact=F.col("signed_amount"),
    )
    return _result(with_flag, rule, missing, F.col("signed_amount"), "REVIEW"), issues


def unknown_cost_centre(ledger: DataFrame, mapping: Mapping) -> tuple[DataFrame, DataFrame]:
    """Ledger rows whose centre has no active reference row in their month."""
    flagged = effective_join(ledger, mapping.cost_centre, ["cost_centre_id"])
    return _ledger_rule(flagged, "GL_UNKNOWN_COST_CENTRE", "cost_centre_id")


def unmapped_account(ledger: DataFrame, mapping: Mapping) -> tuple[DataFrame, DataFrame]:
    """Ledger rows whose account has no active mapping."""
    flagged = ledger.join(
        mapping.account.select("natural_account", F.lit(True).alias("_found")),
        "natural_account",
        "left",
    )
    return _ledger_rule(flagged, "GL_UNMAPPED_ACCOUNT", "natural_account")


def zero_driver(pools: DataFrame, zero_pools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ready indirect pools with money and no valid unit. Run after drivers exist."""
    considered = pools.filter(
        (F.col("pool_status") == K.READY) & (F.col("costing_treatment") == K.INDIRECT)
    )
    flagged = considered.join(
        zero_pools.select(*POOL_KEY, F.lit(True).alias("_zero")), POOL_KEY, "left"
    )
    failed = F.col("_zero").isNotNull()
    issues = _issues(
        zero_pools,
        "ZERO_DRIVER_POOL",
        "costing.cost_pool",
        source_file_name=F.lit("costing.cost_pool"),
        source_row_number=F.lit(None).cast("long"),
        business_key=F.concat_ws("|", *POOL_KEY[1:]),
        invalid_value=describe(
            reporting_month=F.date_format("reporting_month", "yyyy-MM-dd"),
            cost_pool_code="cost_pool_code",
            allocation_driver="allocation_driver",
            total_valid_driver_units="total_driver_units",
        ),
        financial_impact=F.col("source_gl_amount"),
    )
    return (
        _result(flagged, "ZERO_DRIVER_POOL", failed, F.col("source_gl_amount"), "REVIEW"),
        issues,
    )


def gather(*pairs: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """All results and the whole issue register."""
    results, issues = pairs[0]
    for result, issue in pairs[1:]:
        results, issues = results.unionByName(result), issues.unionByName(issue)
    return results, issues


ISSUE_KEY = ["validation_rule_id", "source_entity", "business_key", "field_name"]
LIFE_COLUMNS = [*ISSUE_COLUMNS, "first_run_id", "created_at_utc", "resolved_at_utc", "resolution_note"]


def carry_forward(previous: DataFrame | None, current: DataFrame, run: int, at: datetime) -> DataFrame:
    """The issues of ``run`` with their life so far, and those that it no longer has, as resolved.

    An issue is known again by its rule, entity, business key and field, whatever row it
    is on this time. ``previous`` is the result for the run before. What was open there and is
    found again stays open with its first run and creation time; what is not found is
    resolved at ``at`` and leaves with the next run; what is new opens. Nulls in a key are
    equal. Several rows with one key share their life, and none is multiplied: the earlier
    run is reduced to keys first.
    """
    opened = {
        "first_run_id": F.lit(run).cast("long"),
        "created_at_utc": F.lit(at).cast("timestamp"),
        "resolved_at_utc": F.lit(None).cast("timestamp"),
        "resolution_note": F.lit(None).cast("string"),
    }
    current = current.select(*ISSUE_COLUMNS)
    if previous is None:
        return current.withColumns(opened).select(*LIFE_COLUMNS)
    still = previous.filter(F.col("issue_status") == "OPEN")
    lives = still.groupBy(*[F.col(c).alias(f"_{c}") for c in ISSUE_KEY]).agg(
        F.min("first_run_id").alias("_first"), F.min("created_at_utc").alias("_created")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ISSUE_KEY])
    found = current.withColumns(opened).join(lives, same, "left").withColumns(
        {
            "first_run_id": F.coalesce("_first", "first_run_id"),
            "created_at_utc": F.coalesce("_created", "created_at_utc"),
        }
    )
    now = current.select(*[F.col(c).alias(f"_{c}") for c in ISSUE_KEY]).distinct()
    gone = still.join(now, same, "left_anti").withColumns(
        {
            RUN: F.lit(run).cast("long"),
            "issue_status": F.lit("RESOLVED"),
            "resolved_at_utc": F.lit(at).cast("timestamp"),
            "resolution_note": F.lit(f"Not found in run {run}."),
        }
    )
    return found.select(*LIFE_COLUMNS).unionByName(gone.select(*LIFE_COLUMNS))


def life_summary(lives: DataFrame) -> DataFrame:
    """Issues and impact of a run by rule, status and whether they are new in it."""
    return lives.groupBy(
        RUN, "validation_rule_id", "issue_status", (F.col("first_run_id") == F.col(RUN)).alias("new_flag")
    ).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.sum(F.coalesce("financial_impact", F.lit(0).cast(MONEY))).cast(TOTAL).alias("financial_impact"),
    )


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues and impact per entity and field."""
    return issues.groupBy(RUN, "source_entity", "field_name").agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.sum(F.coalesce("financial_impact", F.lit(0).cast(MONEY)))
        .cast(TOTAL)
        .alias("financial_impact"),
    )
