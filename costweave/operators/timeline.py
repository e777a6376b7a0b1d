"""Stays as calendar months: months touched, bed days, even splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.functions.columns import ColumnLike, col, month_of
from costweave.schemas import MONEY, RUN, TOTAL

NOT_ADMITTED = ("Same-day", "Emergency", "Outpatient")


def stay_months(encounters: DataFrame) -> DataFrame:
    """One row per calendar month a stay touches, with position and month count."""
    months = F.sequence(
        month_of("admission_date"), month_of("discharge_date"), F.expr("interval 1 month")
    )
    return encounters.withColumn("_months", months).select(
        *encounters.columns,
        F.posexplode("_months").alias("month_position", "service_month"),
        F.size("_months").alias("month_count"),
    )


def bed_days_in_month() -> Column:
    """Days of the stay inside ``service_month``, both ends counted.

    The discharge month gives one day back but keeps at least one, so a stay that
    ends on the first of a month still has a bed day there.
    """
    start = F.greatest("admission_date", "service_month")
    end = F.least("discharge_date", F.last_day("service_month"))
    days = F.greatest(F.lit(0), F.datediff(end, start) + 1)
    is_last = F.col("month_position") == F.col("month_count") - 1
    counted = F.when(is_last & (days > 0), F.greatest(F.lit(1), days - 1)).otherwise(days)
    return F.when(F.col("care_type").isin(*NOT_ADMITTED), 0).otherwise(counted)


def split_even(total: ColumnLike, parts: ColumnLike, position: ColumnLike) -> Column:
    """Integer split over months; the first month takes the remainder."""
    share = F.floor(col(total) / col(parts))
    rest = col(total) - share * (col(parts) - 1)
    return F.when(col(position) == 0, rest).otherwise(share).cast("int")


def spread_over_months(encounters: DataFrame, measures: list[str]) -> DataFrame:
    """Monthly resource rows from encounters that carry whole-stay measures."""
    return stay_months(encounters).select(
        RUN,
        "encounter_id",
        "service_month",
        bed_days_in_month().cast("int").alias("bed_days"),
        *[split_even(m, "month_count", "month_position").alias(m) for m in measures],
    )


def direct_to_ledger(direct: DataFrame) -> DataFrame:
    """Ledger control rows: direct items summed by month, centre and account."""
    month = F.date_format("reporting_month", "yyyy-MM-dd")
    return (
        direct.withColumnRenamed("service_month", "reporting_month")
        .groupBy(RUN, "reporting_month", "cost_centre_id", "natural_account")
        .agg(F.sum("amount").cast(TOTAL).alias("signed_amount"))
        .withColumn("adjustment_type", F.lit("Standard expense"))
        .withColumn(
            "source_reference",
            F.concat_ws("-", F.lit("DIRECT-CONTROL"), month, "cost_centre_id", "natural_account"),
        )
    )
