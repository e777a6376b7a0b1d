"""Effective-dated reference lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costweave.session import stage


RULE_KEYS = ["cost_pool_code", "cost_category"]
CENTRE_KEYS = ["cost_centre_id"]
PERIOD = ["effective_from", "effective_to"]


@dataclass(frozen=True)
class Mapping:
    """Active reference rows.

    Centres and rules are ``segments`` of their versions, with ``contested``.
    """

    cost_centre: DataFrame
    account: DataFrame
    rule: DataFrame


def governed(
    cost_centre: DataFrame, account_mapping: DataFrame, allocation_rule: DataFrame
) -> Mapping:
    """Keep active rows and the columns costing reads.

    Versions are laid out as segments, so a ledger row meets one at most. They are stored:
    the optimizer sees their size and decides how to join them.
    """
    active = F.col("active_flag") == "Y"
    centres = cost_centre.filter(active).select(
        *CENTRE_KEYS, "cost_pool_code", "effective_from", "effective_to"
    )
    rules = allocation_rule.filter(active).select(
        *RULE_KEYS, "allocation_driver", "effective_from", "effective_to"
    )
    return Mapping(
        cost_centre=stage(segments(centres, CENTRE_KEYS), "centre_segments"),
        account=account_mapping.filter(active).select(
            "natural_account", "cost_category", "costing_treatment", "default_driver"
        ),
        rule=stage(segments(rules, RULE_KEYS), "rule_segments"),
    )


def segments(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The versions of each key as stretches of days that do not overlap, and ``contested``.

    A sweep over the days on which versions start and end: running sums tell how many
    versions hold from one such day to the next, and, where it is one, which, as the sum
    of the names of those that hold is then its name. Nothing is paired, and the sweep is
    over days, not versions. Stretches that several versions claim, equal ones too, are
    contested and have no values; versions without both days, or that end before they
    start, hold on no day.
    """
    rest = [c for c in versions.columns if c not in keys]
    valid = versions.filter(F.col("effective_from") <= F.col("effective_to")).withColumn(
        "_name", F.xxhash64(*versions.columns).cast("decimal(38,0)")
    )
    start, after = F.col("effective_from"), F.date_add("effective_to", 1)
    one = F.lit(1).cast("long")
    days = (
        valid.select(*keys, F.explode(F.array(
            F.struct(start.alias("day"), one.alias("step"), F.col("_name").alias("name")),
            F.struct(after.alias("day"), (-one).alias("step"), (-F.col("_name")).cast("decimal(38,0)").alias("name")),
        )).alias("event"))
        .groupBy(*keys, "event.day")
        .agg(F.sum("event.step").alias("step"), F.sum("event.name").alias("name"))
    )
    sweep = Window.partitionBy(*keys).orderBy("day")
    stretches = days.select(
        *keys,
        F.col("day").alias("effective_from"),
        F.date_sub(F.lead("day").over(sweep), 1).alias("effective_to"),
        F.sum("step").over(sweep).alias("_held"),
        F.sum("name").over(sweep).cast("decimal(38,0)").alias("_name"),
    ).filter(F.col("_held") > 0)
    values = valid.select("_name", *[c for c in rest if c not in PERIOD]).dropDuplicates(["_name"])
    alone = F.when(F.col("_held") == 1, F.col("_name"))
    return (
        stretches.withColumn("_name", alone)
        .join(values, "_name", "left")
        .select(*versions.columns, (F.col("_held") > 1).alias("contested"))
    )


def effective_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    month: str = "reporting_month",
    how: str = "left",
) -> DataFrame:
    """Equality on ``keys`` and ``month`` inside the version's date range.

    The equality keeps this a hash join; the range is a residual condition. A
    left join adds ``_found``, null when no version applies.
    """
    renamed = versions.select(
        *[F.col(c).alias(f"_v_{c}" if c in keys else c) for c in versions.columns],
        F.lit(True).alias("_found"),
    )
    condition = (F.col(month) >= F.col("effective_from")) & (
        F.col(month) <= F.col("effective_to")
    )
    for key in keys:
        condition = (F.col(key) == F.col(f"_v_{key}")) & condition
    joined = facts.join(renamed, condition, how)
    return joined.drop(*[f"_v_{k}" for k in keys], "effective_from", "effective_to")


def map_ledger(ledger: DataFrame, mapping: Mapping) -> DataFrame:
    """Attach pool, category, treatment and rule driver to ledger rows.

    ``centre_found`` and ``account_found`` are false for rows without a mapping,
    ``centre_contested`` and ``rule_contested`` true where several versions hold in the
    month: such a row has no pool or no driver from them, and stays one row.
    Works on transactions or on any pre-aggregate that keeps month, cost centre
    and account.
    """
    with_centre = effective_join(ledger, mapping.cost_centre, CENTRE_KEYS).withColumnRenamed(
        "contested", "centre_contested"
    )
    with_account = with_centre.withColumnRenamed("_found", "centre_found").join(
        mapping.account.withColumn("account_found", F.lit(True)), "natural_account", "left"
    )
    with_rule = effective_join(with_account, mapping.rule, RULE_KEYS).drop("_found")
    return with_rule.withColumnRenamed("contested", "rule_contested").withColumns(
        {
            "centre_found": F.col("centre_found").isNotNull(),
            "account_found": F.col("account_found").isNotNull(),
            **{c: F.coalesce(c, F.lit(False)) for c in ("centre_contested", "rule_contested")},
        }
    )


def overlapping_rules(rules: DataFrame) -> DataFrame:
    """Active rules that start before an earlier rule of the same pool and category has ended.

    The ledger meets rules by pool, category and month, so two rules that differ in
    scope alone would each take the whole amount.
    """
    active = rules.filter(F.col("active_flag") == "Y")
    return _overlapping(active, RULE_KEYS, "allocation_rule_id").select(
        "allocation_rule_id", *RULE_KEYS, "eligible_scope", "effective_from", "effective_to"
    )


def overlapping_centres(centres: DataFrame) -> DataFrame:
    """Active versions of a cost centre that start before an earlier one has ended."""
    active = centres.filter(F.col("active_flag") == "Y")
    return _overlapping(active, CENTRE_KEYS, "cost_pool_code").select(
        *CENTRE_KEYS, "cost_pool_code", "effective_from", "effective_to"
    )


def _overlapping(versions: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Start dates are summarised first and only those are put in order, so a key
    with very many versions is never lined up in one task, nor paired. Of versions that
    start together the one with the smallest ``tie`` is the earlier.
    """
    starts = versions.groupBy(*keys, "effective_from").agg(
        F.min(tie).alias("first_id"),
        F.max("effective_to").alias("latest_to"),
        F.count(F.lit(1)).alias("together"),
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("effective_from")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    timeline = starts.select(
        *keys,
        "effective_from",
        "first_id",
        "together",
        F.max("latest_to").over(before).alias("earlier_to"),
    )
    # versions equal in the tie as well are all reported
    repeated = (F.col("together") > 1) & (F.col(tie) >= F.col("first_id"))
    first = (F.col(tie) == F.col("first_id")) & (F.col("ties") == 1)
    overlaps = (F.col("effective_from") <= F.col("earlier_to")) | (repeated & ~first)
    ties = versions.groupBy(*keys, "effective_from", tie).agg(F.count(F.lit(1)).alias("ties"))
    return (
        versions.join(timeline, [*keys, "effective_from"])
        .join(ties, [*keys, "effective_from", tie])
        .filter(overlaps)
    )
