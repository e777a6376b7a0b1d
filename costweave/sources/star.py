"""Hospital frames expressed over a retail star schema.

Orders are encounters, their lines are resource use, ledger transactions and
direct cost items, nations are cost centres. Every frame covers its whole table;
the rules below label rows, they never leave any out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import inline, month_of
from costweave.operators.mapping import Mapping, governed
from costweave.schemas import (
    DIRECT_COST,
    ENCOUNTER,
    LEDGER,
    REFERENCES,
    RESOURCE,
    RUN,
    Entity,
)

THE_RUN = 1
# Fixed values of the adapter (the SQL twins read the same ones)
SEGMENT_GROUPS = {
    "AUTOMOBILE": "AG01",
    "BUILDING": "AG02",
    "FURNITURE": "AG04",
    "HOUSEHOLD": "AG06",
    "MACHINERY": "UNCLASSIFIED",
}
CARE_TYPES = ("Inpatient", "Same-day", "Emergency", "Outpatient")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FACILITY = "Network"
# pool of a nation: position n_nationkey modulo the length
NATION_POOLS = (
    "WARD_NURSING",
    "THEATRE",
    "IMAGING",
    "PATHOLOGY",
    "PHARMACY",
    "MEDICAL",
    "ALLIED_HEALTH",
    "EMERGENCY_CARE",
    "OUTPATIENT_CARE",
    "PATIENT_ADMIN",
    "OVERHEAD",
    "ALLIED_SPECIAL",
    "OVERHEAD",
)
UNMAPPED_NATION, SPLIT_NATION, EXPIRED_NATION, INACTIVE_NATION = 7, 1, 2, 3
OPEN_FROM, OPEN_TO = "1990-01-01", "2010-12-31"
SPLIT_END, SPLIT_START, EXPIRED_END = "1997-12-31", "1998-01-01", "1999-12-31"
SPLIT_POOL = "IMAGING"
# direct items of a centre without a mapping would count as assigned and as
# unallocated, so those centres post them to a shared account
DIRECT_ACCOUNT, UNMAPPED_DIRECT_ACCOUNT = "AF", "NF"
# account, description, category, treatment, default driver; RO has no mapping
ACCOUNTS = [
    ("NF", "Nursing salaries", "Nursing", "Indirect", "bed_days", "Y"),
    ("NO", "Clinical services", "Clinical", "Indirect", "medical_service_units", "Y"),
    ("RF", "Supplies", "Supplies", "Indirect", "pharmacy_units", "Y"),
    ("OH", "Support services", "Overhead", "Overhead", "pre_overhead_cost", "Y"),
    ("AF", "Patient-specific items", "Prosthesis", "Direct", "direct_assignment", "Y"),
    ("AO", "Capital works", "Capital", "Exclude", "review", "Y"),
]
RULE_CATEGORIES = ("Nursing", "Clinical", "Supplies")
POOL_DRIVERS = {
    **{pool: measure for measure, pool in K.MEASURE_POOLS.items()},
    **{pool: K.COUNT_DRIVER for pool in K.COUNT_POOLS},
    "ALLIED_SPECIAL": "specialist_units",
}
RULE_SCOPES = {
    "WARD_NURSING": "Inpatient|Same-day",
    "EMERGENCY_CARE": "Emergency",
    "OUTPATIENT_CARE": "Outpatient",
    "THEATRE": "1-URGENT|2-HIGH",
    "ALLIED_SPECIAL": "Specialist Rehabilitation",
}
ENDED_RULE, ENDED_RULE_TO = ("MEDICAL", "Supplies"), "1998-12-31"
# group, name, stream, weight, trim days, weight per outlier day: invented for the star schema
FUNDING_GROUPS = [
    ("AG01", "Urgent orders", "Admitted acute", "2.4000", 9, "0.0700", "N"),
    ("AG02", "Planned orders", "Admitted acute", "1.1000", 6, "0.0300", "N"),
    ("AG04", "Counter orders", "Admitted acute", "0.6000", 2, "0.0200", "N"),
    ("AG06", "Orders for the young", "Admitted acute", "1.3000", 5, "0.0500", "N"),
]


# declared, so that no job reads footers to find out
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


CARE_TYPE = (
    "CASE WHEN o_orderstatus = 'O' THEN 'Outpatient' WHEN o_orderstatus = 'P' THEN 'Emergency' "
    "WHEN o_orderkey % 4 = 0 THEN 'Same-day' ELSE 'Inpatient' END"
)


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encounter per order with patient attributes from its customer.

    Nation and region are tiny files; the optimizer broadcasts them by their size.
    """
    groups = " ".join(f"WHEN '{s}' THEN '{g}'" for s, g in SEGMENT_GROUPS.items())
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey AS c_custkey",
        "o_orderpriority AS service_line",
        f"{CARE_TYPE} AS care_type",
        "CAST(o_orderdate AS DATE) AS admission_date",
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_nationkey AS n_nationkey", "c_mktsegment"
    )
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_regionkey AS r_regionkey")
    return (
        orders.join(customers, "c_custkey")
        .join(nations, "n_nationkey")
        .join(table(spark, sf_dir, "region"), "r_regionkey")
        .selectExpr(
            "*",
            "CAST(IF(care_type = 'Inpatient', o_orderkey % 15, 0) AS SMALLINT) AS length_of_stay",
        )
        .selectExpr(
            f"CAST({THE_RUN} AS BIGINT) AS {RUN}",
            "CAST(o_orderkey AS STRING) AS encounter_id",
            "CAST(c_custkey AS STRING) AS patient_id",
            "r_name AS facility",
            "service_line",
            "care_type",
            "admission_date",
            "date_add(admission_date, CAST(length_of_stay AS INT)) AS discharge_date",
            "trunc(admission_date, 'MM') AS episode_month",
            f"CASE c_mktsegment {groups} END AS activity_group_code",
            "length_of_stay",
            "'Discharged' AS separation_status",
            "CAST(c_custkey % 90 AS SMALLINT) AS age_years",
            "IF(c_custkey % 29 = 0, 'Y', 'N') AS indigenous_status",
            "IF(c_custkey % 41 = 0, 'Remote', 'Major Cities') AS remoteness_area",
            "IF(o_orderkey % 7 = 0, 'Y', 'N') AS high_complexity_flag",
            "IF(o_orderkey % 50 = 0, 'Y', 'N') AS hospital_acquired_complication_flag",
        )
    )


# measures summed per order and month
_LINE_MEASURES = {
    "lines": "1",
    "theatre_minutes": "IF(l_returnflag = 'R', CAST(l_quantity AS INT), 0)",
    "imaging_weighted_units": "l_linenumber",
    "pathology_weighted_units": "IF(l_linestatus = 'F', 1, 0)",
    "pharmacy_units": "CAST(l_quantity AS INT)",
    "allied_health_units": "IF(l_returnflag = 'A', 1, 0)",
}


def resource_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures per order and month; odd line numbers fall in the next month.

    Both months are summed side by side, so lines shuffle once, by order, after
    map-side combining, and the join with orders reuses that partitioning.
    """
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            *[
                F.expr(
                    f"CAST(SUM(IF(l_linenumber % 2 = {later}, {value}, NULL)) AS INT) "
                    f"AS {name}_{later}"
                )
                for later in (0, 1)
                for name, value in _LINE_MEASURES.items()
            ]
        )
    )
    months = ", ".join(
        f"named_struct('later', {later}, "
        + ", ".join(f"'{name}', {name}_{later}" for name in _LINE_MEASURES)
        + ")"
        for later in (0, 1)
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        f"{CARE_TYPE} IN ('Inpatient', 'Same-day') AS admitted",
        "trunc(o_orderdate, 'MM') AS first_month",
    )
    return (
        per_order.join(orders, "o_orderkey")
        .selectExpr("o_orderkey", "admitted", "first_month", f"inline(array({months}))")
        .filter("lines IS NOT NULL")
        .selectExpr(
            f"CAST({THE_RUN} AS BIGINT) AS {RUN}",
            "concat_ws('-', o_orderkey, later) AS resource_usage_id",
            "CAST(o_orderkey AS STRING) AS encounter_id",
            "add_months(first_month, later) AS service_month",
            "IF(admitted, lines, 0) AS bed_days",
            "theatre_minutes",
            "imaging_weighted_units",
            "pathology_weighted_units",
            "pharmacy_units",
            "lines AS medical_service_units",
            "allied_health_units",
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with centre, account and amount. Suppliers grow with the data,
    so the optimizer chooses the join from their real size."""
    support = ", ".join(str(i) for i, pool in enumerate(NATION_POOLS) if pool == "OVERHEAD")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS l_suppkey",
        "concat('CC_', s_nationkey) AS cost_centre_id",
        f"s_nationkey % {len(NATION_POOLS)} IN ({support}) AS support",
        f"s_nationkey IN ({UNMAPPED_NATION}, {EXPIRED_NATION}) AS unmapped",
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "concat(l_returnflag, l_linestatus) AS flags",
        "trunc(l_shipdate, 'MM') AS month",
        "CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(19,6)) AS amount",
    )
    return lines.join(suppliers, "l_suppkey").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "month",
        "amount",
        "cost_centre_id",
        f"CASE WHEN support THEN 'OH' WHEN unmapped AND flags = '{DIRECT_ACCOUNT}' "
        f"THEN '{UNMAPPED_DIRECT_ACCOUNT}' ELSE flags END AS natural_account",
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger transaction per order line; first returned lines are credits."""
    credit = "l_returnflag = 'R' AND l_linenumber = 1"
    source = f"IF(natural_account = '{DIRECT_ACCOUNT}', 'DIRECT-CONTROL', 'MONTHLY')"
    return _lines(spark, sf_dir).selectExpr(
        f"CAST({THE_RUN} AS BIGINT) AS {RUN}",
        "'general_ledger_transaction.csv' AS source_file_name",
        "CAST(NULL AS BIGINT) AS source_row_number",
        "concat_ws('-', l_orderkey, l_linenumber) AS gl_transaction_id",
        "month AS reporting_month",
        "'Health Service' AS entity",
        f"'{FACILITY}' AS facility",
        "cost_centre_id",
        "natural_account",
        "concat('Account ', natural_account) AS account_description",
        f"CAST(IF({credit}, -amount, amount) AS DECIMAL(19,6)) AS signed_amount",
        f"IF({credit}, 'Credit', 'Standard expense') AS adjustment_type",
        f"concat_ws('-', {source}, CAST(month AS STRING), cost_centre_id, natural_account) "
        "AS source_reference",
    )


def ledger_by_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with each transaction at the facility of its order."""
    places = encounters(spark, sf_dir).select("encounter_id", "facility")
    order = F.substring_index("gl_transaction_id", "-", 1)
    rows = ledger(spark, sf_dir).drop("facility")
    return rows.withColumn("encounter_id", order).join(places, "encounter_id").drop("encounter_id")


def direct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines on the direct account; line number 7 names an order that does not exist."""
    return (
        _lines(spark, sf_dir)
        .filter(F.col("natural_account") == DIRECT_ACCOUNT)
        .selectExpr(
            f"CAST({THE_RUN} AS BIGINT) AS {RUN}",
            "concat_ws('-', l_orderkey, l_linenumber) AS direct_cost_id",
            "CAST(IF(l_linenumber = 7, -1 - l_orderkey, l_orderkey) AS STRING) AS encounter_id",
            "month AS service_month",
            "cost_centre_id",
            "natural_account",
            "'Patient-specific item' AS direct_cost_type",
            "CAST(l_quantity AS INT) AS quantity",
            "amount",
        )
    )


# --- reference tables -------------------------------------------------------


def cost_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A centre per nation; one unmapped, one split in time, one expired, one with
    an additional inactive row."""
    key = F.col("n_nationkey")
    pool = F.element_at(F.array(*[F.lit(p) for p in NATION_POOLS]), (key % len(NATION_POOLS) + 1).cast("int"))

    def version(pool: Column, start: str, end: Column, active: str = "Y") -> Column:
        return F.struct(
            pool.alias("cost_pool_code"),
            F.lit(active).alias("active_flag"),
            F.lit(start).cast("date").alias("effective_from"),
            end.cast("date").alias("effective_to"),
        )

    end = (
        F.when(key == SPLIT_NATION, SPLIT_END)
        .when(key == EXPIRED_NATION, EXPIRED_END)
        .otherwise(OPEN_TO)
    )
    versions = F.array(
        version(pool, OPEN_FROM, end),
        F.when(key == SPLIT_NATION, version(F.lit(SPLIT_POOL), SPLIT_START, F.lit(OPEN_TO))).when(
            key == INACTIVE_NATION, version(F.lit(SPLIT_POOL), OPEN_FROM, F.lit(OPEN_TO), "N")
        ),
    )
    return (
        table(spark, sf_dir, "nation")
        .filter(key != UNMAPPED_NATION)
        .select(
            F.concat(F.lit("CC_"), key.cast("string")).alias("cost_centre_id"),
            F.col("n_name").alias("cost_centre_name"),
            F.lit("All").alias("service_line"),
            F.explode(versions).alias("v"),
        )
        .filter(F.col("v").isNotNull())
        .select("cost_centre_id", "cost_centre_name", "service_line", "v.*")
    )


def rule_rows() -> list[tuple]:
    """Allocation rules: every pool and category, plus overhead."""
    rows = []
    for pool, driver in POOL_DRIVERS.items():
        for category in RULE_CATEGORIES:
            end = ENDED_RULE_TO if (pool, category) == ENDED_RULE else OPEN_TO
            rows.append((pool, category, driver, RULE_SCOPES.get(pool, "All"), end))
    rows.append((K.OVERHEAD_POOL, "Overhead", K.OVERHEAD_DRIVER, "All", OPEN_TO))
    return rows


def account_mapping(spark: SparkSession) -> DataFrame:
    return inline(spark, ACCOUNTS, REFERENCES["account_mapping"].ddl)


def allocation_rules(spark: SparkSession) -> DataFrame:
    rows = [
        (f"RULE_{pool}_{category}", pool, category, driver, scope, "Use follows the driver", OPEN_FROM, end, "Y")
        for pool, category, driver, scope, end in rule_rows()
    ]
    return inline(spark, rows, ", ".join(f"{c} string" for c in (
        "allocation_rule_id", "cost_pool_code", "cost_category", "allocation_driver",
        "eligible_scope", "business_rationale", "effective_from", "effective_to", "active_flag",
    ))).withColumns(
        {c: F.col(c).cast("date") for c in ("effective_from", "effective_to")}
    )


def funding_groups(spark: SparkSession) -> DataFrame:
    text = inline(
        spark,
        FUNDING_GROUPS,
        "activity_group_code string, activity_group_name string, service_stream string, "
        "synthetic_base_weight string, high_length_of_stay_trim_days long, "
        "synthetic_outlier_nwau_per_day string, official_price_weight_flag string",
    )
    return text.withColumns(
        {
            "synthetic_base_weight": F.col("synthetic_base_weight").cast("decimal(12,6)"),
            "high_length_of_stay_trim_days": F.col("high_length_of_stay_trim_days").cast("short"),
            "synthetic_outlier_nwau_per_day": F.col("synthetic_outlier_nwau_per_day").cast(
                "decimal(12,6)"
            ),
        }
    )


def mapping(spark: SparkSession, sf_dir: str) -> Mapping:
    return governed(cost_centres(spark, sf_dir), account_mapping(spark), allocation_rules(spark))


def references(spark: SparkSession) -> dict[str, DataFrame]:
    """Allowed values of the conformed encounter columns."""

    def values(column: str, allowed) -> DataFrame:
        return inline(spark, [(v,) for v in allowed], f"{column} string")

    return {
        "service_line": values("service_line", PRIORITIES),
        "care_type": values("care_type", CARE_TYPES),
        "activity_group_code": values("activity_group_code", SEGMENT_GROUPS.values()),
    }


def reporting_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A period per ledger month; the financial year starts in July."""
    month = F.col("reporting_month")
    start_year = F.year(month) - F.when(F.month(month) < 7, 1).otherwise(0)
    return (
        table(spark, sf_dir, "lineitem")
        .select(month_of("l_shipdate").alias("reporting_month"))
        .distinct()
        .select(
            month,
            month.alias("period_start"),
            F.last_day(month).alias("period_end"),
            F.format_string("%d-%02d", start_year, (start_year + 1) % 100).alias("financial_year"),
            ((F.month(month) + 5) % 12 + 1).cast("short").alias("period_number"),
        )
    )


# --- landing text -------------------------------------------------------------

# A text that converts to nothing, and the key step that gets it
BAD_TEXT, BAD_STEP = "bad", 97


def as_landing(
    df: DataFrame, entity: Entity, spoiled: dict[str, str], line: str = "NULL"
) -> DataFrame:
    """A typed frame as landed text; ``spoiled`` columns become unreadable where the
    given condition holds."""

    def text(name: str) -> str:
        value = f"concat(' ', {name}, ' ')"
        if name in spoiled:
            value = f"IF({spoiled[name]}, '{BAD_TEXT}', {value})"
        return f"{value} AS {name}"

    return df.selectExpr(
        RUN,
        f"'{entity.name}.csv' AS source_file_name",
        f"CAST({line} AS BIGINT) AS source_row_number",
        *[text(c) for c in entity.columns],
    )


def _every(key: str, shift: int = 0) -> str:
    return f"CAST({key} AS BIGINT) % {BAD_STEP} = {shift}"


def encounter_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "encounter_id"
    return as_landing(
        encounters(spark, sf_dir),
        ENCOUNTER,
        {"admission_date": _every(key), "care_type": _every(key, 1), "age_years": _every(key, 2)},
        line=f"{key} + 2",
    )


def spoiled_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed resource rows, some with a negative pathology driver."""
    return resource_usage(spark, sf_dir).withColumn(
        "pathology_weighted_units",
        F.expr(f"IF({_every('encounter_id', 3)}, -2, pathology_weighted_units)"),
    )


def resource_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_landing(
        spoiled_resource(spark, sf_dir),
        RESOURCE,
        {"bed_days": _every("encounter_id", 4)},
        line="CAST(encounter_id AS BIGINT) * 2 + split(resource_usage_id, '-')[1] + 2",
    )


def direct_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_landing(
        direct_items(spark, sf_dir), DIRECT_COST, {"quantity": _every("encounter_id", 5)}
    )


def ledger_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_landing(
        ledger(spark, sf_dir), LEDGER, {"signed_amount": _every("split(gl_transaction_id, '-')[0]", 6)}
    )
