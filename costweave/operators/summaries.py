"""Numeric summaries, frequencies and shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.functions.columns import quoted, stacked
from costweave.operators.percentiles import group_percentiles
from costweave.schemas import RUN, TOTAL
from costweave.session import stage


def numeric_summary(
    df: DataFrame,
    measures: list[str],
    non_negative_only: bool = False,
    places: int = 3,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Count, min, mean, median, p95 and max of each measure, of all rows or ``by`` groups.

    Percentiles are exact and ranked by value ranges, so neither a measure nor a group is
    ever lined up in one task.
    """
    rows = [[quoted(m), f"CAST({m} AS DOUBLE)"] for m in measures]
    values = df.select(*by, stacked(rows, ["measure", "value"])).filter(F.col("value").isNotNull())
    if non_negative_only:
        values = values.filter(F.col("value") >= 0)
    keys = [*by, "measure"]
    values = stage(values, "values")
    ranked = group_percentiles(values, keys, "value", {"median": 0.5, "p95": 0.95})
    ranked = ranked.select(*[F.col(k).alias(f"_{k}") for k in keys], "median", "p95")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return (
        values.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("value").alias("min"),
            F.avg("value").alias("mean"),
            F.max("value").alias("max"),
        )
        .join(ranked, same)
        .select(
            *keys,
            "count",
            *[F.round(c, places).alias(c) for c in ("min", "mean", "median", "p95", "max")],
        )
    )


def grouped_totals(df: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """Rows and sums of each run, and of each run and value of every column of ``by``, in one pass.

    ``load_run_id, level, value, row_count`` and the sums; ``level`` is ``run`` or the name
    of the column. Grouping sets add up inside each task before anything moves.
    """
    sets = [[RUN], *[[RUN, c] for c in by]]
    level, value = F.lit("run"), F.lit(None).cast("string")
    for c in by:
        of_column = F.grouping(c) == 0
        level = F.when(of_column, c).otherwise(level)
        value = F.when(of_column, F.col(c).cast("string")).otherwise(value)
    totals = df.groupingSets(sets, RUN, *by).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast(TOTAL).alias(c) for c in sums],
        level.alias("level"),
        value.alias("value"),
    )
    return totals.select(RUN, "level", "value", "row_count", *sums)


def ledger_statistics(ledger: DataFrame) -> DataFrame:
    """Transactions and signed amount of the run, of its months and of its adjustment types."""
    return grouped_totals(ledger, ["reporting_month", "adjustment_type"], ["signed_amount"])


def funding_statistics(funding: DataFrame) -> DataFrame:
    """Encounters, weighted activity and funding of the run, of its statuses and of its months.

    Only calculated funding counts.
    """
    names = ["final_synthetic_nwau", "estimated_synthetic_funding"]
    calculated = F.col("funding_status") == "CALCULATED"
    counted = funding.withColumns({c: F.when(calculated, F.col(c)) for c in names})
    return grouped_totals(counted, ["funding_status", "episode_month"], names)


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value of each column and their share of all rows, in one pass."""
    rows = [[quoted(c), f"CAST({c} AS STRING)"] for c in columns]
    values = df.select(stacked(rows, ["attribute", "value"]))
    counts = values.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("attribute").agg(F.sum("n").alias("total"))
    return counts.join(totals, "attribute").select(
        "attribute", "value", "n", (F.col("n") / F.col("total")).alias("share")
    )


def ordered(summary: DataFrame, *keys: str, descending: tuple[str, ...] = ()) -> DataFrame:
    """A summary in the order it is presented. For aggregates, not for facts."""
    return summary.orderBy(*[F.col(k).desc() if k in descending else F.col(k).asc() for k in keys])
