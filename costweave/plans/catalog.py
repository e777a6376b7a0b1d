"""Every operator as a query over the star-schema tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave import constants as K
from costweave.functions.columns import blank_to_null
from costweave.operators import (
    allocate,
    checks,
    drivers,
    funding,
    mapping as mapped,
    patient,
    percentiles,
    pools,
    promote,
    quality,
    recon,
    summaries,
    timeline,
    unallocated,
    variance,
)
from costweave.plans import reporting
from costweave.plans.costing import CostingRun
from costweave.plans.star_sql import d, money, n, q, ratio, shown, twin
from costweave.schemas import DIRECT_COST, ENCOUNTER, LEDGER, MEASURES, MONEY, RESOURCE, RUN, TOTAL
from costweave.session import scratch_path, stage
from costweave.sources import landing, reference, star, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = twin(sql)
        return fn

    return register


# integers that may be missing are shown as text, which every reader compares alike
NULLABLE = ("source_row_number", "actual_row_count", "count_change")


def show(df: DataFrame, *columns: str, **places: int) -> DataFrame:
    """Output types both engines agree on: rounded doubles, bigints, ISO dates."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in columns or kinds:
        kind = kinds[name]
        if isinstance(kind, T.DecimalType):
            out.append(f"CAST(ROUND({name}, {places.get(name, 2)}) AS DOUBLE) AS {name}")
        elif isinstance(kind, T.DoubleType):
            out.append(f"ROUND({name}, {places.get(name, 6)}) AS {name}")
        elif isinstance(kind, T.DateType) or name in NULLABLE:
            out.append(f"CAST({name} AS STRING) AS {name}")
        elif isinstance(kind, (T.ShortType, T.IntegerType)):
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            out.append(name)
    return df.selectExpr(*out)


# --- inputs ---------------------------------------------------------------------


def costing_run(
    spark: SparkSession, sf_dir: str, attribution: str = patient.EPISODE_MONTH, **options
) -> CostingRun:
    """A run over the star schema; what a query never asks for is never built."""
    return StarRun(spark, sf_dir, attribution=attribution, **options)


class StarRun(CostingRun):
    """Inputs are stored when first used.

    Direct items meet their encounters in one join whose result is stored, so a
    hot encounter can be split there and is pre-aggregated wherever it is summed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, **options):
        super().__init__(
            None,
            None,
            None,
            star.ledger(spark, sf_dir),
            None,
            funding_groups=star.funding_groups(spark),
            **options,
        )
        self.spark, self.sf_dir = spark, sf_dir
        for name in ("encounters", "resource", "direct", "mapping", "rejected_direct"):
            self.__dict__.pop(name, None)

    @cached_property
    def encounters(self) -> DataFrame:
        return stage(star.encounters(self.spark, self.sf_dir), "patient_encounter")

    @cached_property
    def resource(self) -> DataFrame:
        """Without the text key of each row, which no step of a run reads."""
        used = star.resource_usage(self.spark, self.sf_dir).drop("resource_usage_id")
        return stage(used, "resource_usage")

    @cached_property
    def mapping(self) -> mapped.Mapping:
        return star.mapping(self.spark, self.sf_dir)

    @cached_property
    def _items(self) -> DataFrame:
        known = self.encounters.select(RUN, "encounter_id", F.lit(True).alias("known"))
        items = star.direct_items(self.spark, self.sf_dir)
        return stage(items.join(known, [RUN, "encounter_id"], "left"), "direct_cost_detail")

    @cached_property
    def direct(self) -> DataFrame:
        return self._items.filter("known")

    @cached_property
    def rejected_direct(self) -> DataFrame:
        landed = F.struct(*[F.col(c).cast("string").alias(c) for c in DIRECT_COST.columns])
        return self._items.filter("known IS NULL").select(RUN, landed.alias("landed"))


def classified_encounters(spark, sf_dir) -> DataFrame:
    return promote.classify(
        star.encounter_landing(spark, sf_dir), ENCOUNTER, references=star.references(spark)
    )


def classified_children(spark, sf_dir, *names: str) -> dict[str, DataFrame]:
    parents = stage(
        promote.accepted(classified_encounters(spark, sf_dir)).select(RUN, "encounter_id"),
        "staged_encounters",
    )
    sources = {
        "resource_usage": (star.resource_landing, RESOURCE),
        "direct_cost_detail": (star.direct_landing, DIRECT_COST),
    }
    return {
        name: promote.classify(sources[name][0](spark, sf_dir), sources[name][1], encounters=parents)
        for name in names
    }


# --- scans, sources, sinks --------------------------------------------------------


@query(
    "a1_landing_text",
    """SELECT service_line AS landed_service_line, CAST(COUNT(*) AS BIGINT) AS row_count,
              CAST(COUNT(DISTINCT encounter_id) AS BIGINT) AS encounters,
              CAST(SUM(CASE WHEN admission_date = 'bad' THEN 1 ELSE 0 END) AS BIGINT) AS unreadable_dates
       FROM lenc GROUP BY 1""",
)
def a1(spark, sf_dir):
    path = scratch_path(spark, "patient_encounter.csv")
    star.encounter_landing(spark, sf_dir).select(*ENCOUNTER.columns).write.option(
        "header", True
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    df = landing.read_landing_csv(spark, path, ENCOUNTER)
    return df.groupBy(F.col("service_line").alias("landed_service_line")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("encounter_id").alias("encounters"),
        F.count(F.when(F.col("admission_date") == "bad", 1)).alias("unreadable_dates"),
    )


@query(
    "a2_lineage",
    """SELECT CAST(1 AS BIGINT) AS load_run_id, CAST(COUNT(*) AS BIGINT) AS row_count,
              CAST(COUNT(*) AS BIGINT) AS distinct_lines, CAST(2 AS BIGINT) AS first_line,
              CAST(COUNT(*) AS BIGINT) AS rows_below_last_lines FROM orders""",
)
def a2(spark, sf_dir):
    path = scratch_path(spark, "patient_encounter.csv")
    star.encounter_landing(spark, sf_dir).select(*ENCOUNTER.columns).write.option(
        "header", True
    ).csv(path)
    rows = landing.add_lineage(landing.read_landing_csv(spark, path, ENCOUNTER), run=star.THE_RUN)
    per_file = rows.groupBy(RUN, "source_file_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("source_row_number").alias("lines"),
        F.min("source_row_number").alias("first"),
        F.max("source_row_number").alias("last"),
    )
    return per_file.groupBy(RUN).agg(
        F.sum("rows").alias("row_count"),
        F.sum("lines").alias("distinct_lines"),
        F.max("first").cast("long").alias("first_line"),
        F.sum(F.col("last") - 1).cast("long").alias("rows_below_last_lines"),
    )


_CONTROLS = """(SELECT 'patient_encounter.csv' AS f, (SELECT COUNT(*) FROM orders) AS e, (SELECT COUNT(*) FROM enc) AS a
             UNION ALL SELECT 'resource_usage.csv', (SELECT COUNT(DISTINCT (l_orderkey, l_linenumber % 2)) FROM lineitem), (SELECT COUNT(*) FROM res)
             UNION ALL SELECT 'general_ledger_transaction.csv', (SELECT COUNT(*) FROM lineitem) + 1, (SELECT COUNT(*) FROM gl)
             UNION ALL SELECT 'direct_cost_detail.csv', (SELECT COUNT(*) FROM dir), (SELECT COUNT(*) FROM rdir)
             UNION ALL SELECT 'never_landed.csv', (SELECT COUNT(*) FROM customer), NULL) t"""


@query(
    "a3_file_row_control",
    f"""SELECT f AS file_name, CAST(e AS BIGINT) AS expected_row_count, CAST(a AS VARCHAR) AS actual_row_count,
              CASE WHEN e = a THEN 'PASS' ELSE 'FAIL' END AS control_status
       FROM {_CONTROLS}""",
)
def a3(spark, sf_dir):
    return show(
        _file_controls(spark, sf_dir),
        "file_name",
        "expected_row_count",
        "actual_row_count",
        "control_status",
    )


@query(
    "k2_row_control_check",
    f"""SELECT 'SRC-ROW-CONTROL' AS check_id, CASE WHEN COUNT(*) FILTER (e IS DISTINCT FROM a) = 0 THEN 'PASS' ELSE 'ERROR' END AS status,
               CAST(COUNT(*) AS VARCHAR) AS observed FROM {_CONTROLS}""",
)
def k2(spark, sf_dir):
    return _seen(checks.row_control_check(_file_controls(spark, sf_dir)))


def _file_controls(spark, sf_dir) -> DataFrame:
    landed = None
    for frame in (
        star.encounter_landing,
        star.resource_landing,
        star.direct_landing,
        star.ledger_landing,
    ):
        part = frame(spark, sf_dir).select(RUN, "source_file_name")
        landed = part if landed is None else landed.unionByName(part)
    lines = star.table(spark, sf_dir, "lineitem")

    def expect(name, df, more=0):
        return df.agg((F.count(F.lit(1)) + more).alias("expected_row_count")).withColumn(
            "file_name", F.lit(name)
        )

    expected = (
        expect("patient_encounter.csv", star.table(spark, sf_dir, "orders"))
        .unionByName(
            expect(
                "resource_usage.csv",
                lines.select("l_orderkey", F.col("l_linenumber") % 2).distinct(),
            )
        )
        .unionByName(expect("direct_cost_detail.csv", star.direct_items(spark, sf_dir)))
        .unionByName(expect("general_ledger_transaction.csv", lines, more=1))
        .unionByName(expect("never_landed.csv", star.table(spark, sf_dir, "customer")))
    )
    return landing.file_row_control(landed, expected)


_LOG_SQL = """SELECT CAST(o_orderkey AS BIGINT) AS load_run_id,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'STARTED' END AS load_status FROM orders"""


def _events(spark, sf_dir) -> DataFrame:
    """Orders as load runs: all start, finished orders complete, open ones fail."""
    status = F.col("o_orderstatus")
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(RUN),
        F.lit(landing.LOAD_NAME).alias("load_name"),
        F.col("o_orderdate").alias("event_at_utc"),
        F.when(status == "F", "COMPLETED").when(status == "O", "FAILED").alias("last_status"),
    )
    return orders.withColumn("load_status", F.lit("STARTED")).unionByName(
        orders.filter(F.col("last_status").isNotNull()).withColumn(
            "load_status", F.col("last_status")
        )
    )


@query(
    "a4_run_log",
    f"""SELECT load_status, CAST(COUNT(*) AS BIGINT) AS run_count FROM ({_LOG_SQL}) t GROUP BY 1""",
)
def a4(spark, sf_dir):
    return (
        landing.latest_status(_events(spark, sf_dir))
        .groupBy("load_status")
        .agg(F.count(F.lit(1)).alias("run_count"))
    )


@query(
    "a5_current_run",
    f"""SELECT MAX(load_run_id) AS load_run_id FROM ({_LOG_SQL}) t WHERE load_status = 'COMPLETED'""",
)
def a5(spark, sf_dir):
    return landing.current_run(landing.latest_status(_events(spark, sf_dir)))


@query(
    "a6_reference_table",
    f"""SELECT cost_centre_id, cost_centre_name, cost_pool_code, active_flag,
               {d('effective_from')} AS effective_from, {d('effective_to')} AS effective_to FROM centre""",
)
def a6(spark, sf_dir):
    folder = scratch_path(spark, "reference")
    star.cost_centres(spark, sf_dir).write.option("header", True).csv(f"{folder}/cost_centre.csv")
    df = reference.read_reference(spark, "cost_centre", folder)
    return show(df.drop("service_line"))


@query(
    "a7_upsert",
    """SELECT CAST(c_custkey AS BIGINT) AS id, COALESCE(s_name, c_mktsegment) AS label
       FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
       UNION ALL
       SELECT CAST(s_suppkey AS BIGINT), s_name FROM supplier
       WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""",
)
def a7(spark, sf_dir):
    target = star.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("label")
    )
    source = star.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("label")
    )
    return reference.upsert(target, source, ["id"])


@query(
    "b6_repeated_keys",
    """SELECT CAST(2 * COUNT(*) FILTER (encounter_id LIKE '%7') AS BIGINT) AS repeated_count,
              CAST((SELECT COUNT(*) FROM penc WHERE encounter_id NOT LIKE '%7') AS BIGINT) AS staged_count FROM enc""",
)
def b6r(spark, sf_dir):
    """Some encounters land twice: no copy of them is staged."""
    landed = star.encounter_landing(spark, sf_dir)
    twice = landed.unionByName(landed.filter("trim(encounter_id) LIKE '%7'"))
    rows = promote.classify(twice, ENCOUNTER, references=star.references(spark), unique=True)
    repeated = F.contains("reject_reason", F.lit("repeated encounter_id"))
    return rows.agg(
        F.count(F.when(repeated, 1)).alias("repeated_count"),
        F.count(F.when(F.col("reject_reason").isNull(), 1)).alias("staged_count"),
    )


@query(
    "a8_replace_run",
    f"""SELECT load_run_id, CAST(COUNT(*) AS BIGINT) AS row_count, {shown('SUM(signed_amount)')} AS amount
        FROM (SELECT CAST(1 AS BIGINT) AS load_run_id, signed_amount FROM gl WHERE adjustment_type = 'Credit'
              UNION ALL SELECT CAST(2 AS BIGINT), signed_amount FROM gl) t GROUP BY 1""",
)
def a8(spark, sf_dir):
    """Run 1 is written in full, then again as its credits only; run 2 stays."""
    path = scratch_path(spark, "ledger")
    rows = stage(
        star.ledger(spark, sf_dir).select("signed_amount", "adjustment_type"), "rows"
    )
    first, second = (rows.withColumn(RUN, F.lit(r).cast("long")) for r in (1, 2))
    tables.replace_run(first, path, 1)
    tables.replace_run(second, path, 2)
    tables.replace_run(first.filter(F.col("adjustment_type") == "Credit"), path, 1)
    table = spark.read.schema(first.schema).parquet(path)
    return show(
        table.groupBy(RUN).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("signed_amount").alias("amount")
        )
    )


@query(
    "a9_replace_slice",
    f"""SELECT adjustment_type, CAST(COUNT(*) AS BIGINT) AS row_count, {shown('SUM(signed_amount)')} AS amount
        FROM (SELECT adjustment_type, signed_amount FROM gl WHERE adjustment_type <> 'Credit'
              UNION ALL SELECT adjustment_type, -signed_amount FROM gl WHERE adjustment_type = 'Credit') t GROUP BY 1""",
)
def a9(spark, sf_dir):
    """One slice of the run is replaced, its siblings are left alone."""
    path = scratch_path(spark, "ledger")
    rows = stage(
        star.ledger(spark, sf_dir).select(RUN, "signed_amount", "adjustment_type"), "rows"
    )
    of_kind = {k: F.col("adjustment_type") == k for k in ("Credit", "Standard expense")}
    for kind, mine in of_kind.items():
        tables.replace_slice(rows.filter(mine), path, {RUN: 1, "adjustment_type": kind})
    turned = rows.withColumn("signed_amount", (-F.col("signed_amount")).cast(MONEY))
    credit = {RUN: 1, "adjustment_type": "Credit"}
    tables.replace_slice(turned.filter(of_kind["Credit"]), path, credit)
    try:  # rows of both kinds are refused, and the slice keeps what it has
        tables.replace_slice(rows, path, credit)
    except tables.ForeignRows:
        pass
    table = spark.read.schema(rows.schema).parquet(path)
    return show(
        table.groupBy("adjustment_type").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("signed_amount").alias("amount")
        )
    )


@query(
    "a10_append_new",
    """SELECT care_type, CAST(COUNT(*) AS BIGINT) AS row_count FROM enc GROUP BY 1""",
)
def a10(spark, sf_dir):
    """Inpatients are appended first, then everybody; nobody appears twice."""
    path = scratch_path(spark, "patient_encounter")
    enc = stage(
        star.encounters(spark, sf_dir).select(RUN, "encounter_id", "care_type"), "encounters"
    )
    key = [RUN, "encounter_id"]
    tables.append_new(enc.filter(F.col("care_type") == "Inpatient"), path, None, key)
    tables.append_new(enc, path, spark.read.schema(enc.schema).parquet(path), key)
    table = spark.read.schema(enc.schema).parquet(path)
    return table.groupBy("care_type").agg(F.count(F.lit(1)).alias("row_count"))


_CONTROL_SQL = f"""SELECT {d('episode_month')} AS episode_month, CAST(COUNT(*) AS BIGINT) AS encounter_count,
    CAST(COUNT(*) FILTER (funding_status = 'CALCULATED') AS BIGINT) AS funded_encounter_count,
    CAST(COUNT(*) FILTER (funding_status <> 'CALCULATED') AS BIGINT) AS unfunded_review_count,
    {shown('COALESCE(SUM(final_synthetic_nwau), 0)', 6)} AS total_synthetic_nwau,
    {shown('COALESCE(SUM(estimated_synthetic_funding), 0)')} AS total_estimated_synthetic_funding
    FROM fund GROUP BY 1"""


def _encounter_funding(spark, sf_dir) -> DataFrame:
    return funding.encounter_funding(
        star.encounters(spark, sf_dir), star.funding_groups(spark)
    )


@query("a11_control_csv", _CONTROL_SQL)
def a11(spark, sf_dir):
    path = scratch_path(spark, "abf_monthly_control_total.csv")
    control = funding.monthly_funding_control(_encounter_funding(spark, sf_dir))
    tables.write_control_csv(control, path)
    back = spark.read.schema(control.schema).option("header", True).csv(path)
    return show(back, total_synthetic_nwau=6)


# --- promotion ---------------------------------------------------------------------


_PENC = ", ".join(
    {
        "date": f"{d(c.name)} AS {c.name}",
        "smallint": f"{n(c.name)} AS {c.name}",
        "string": c.name,
    }[c.kind.simpleString()]
    for c in ENCOUNTER.fields
)


@query("b6_promote_encounter", f"SELECT load_run_id, {_PENC} FROM penc")
def b6(spark, sf_dir):
    return show(
        promote.accepted(classified_encounters(spark, sf_dir)), RUN, *ENCOUNTER.columns
    )


@query(
    "b6_rejected_encounter_reasons",
    f"""SELECT CASE k % {star.BAD_STEP} WHEN 0 THEN 'invalid admission_date' WHEN 1 THEN 'unknown care_type'
                ELSE 'invalid age_years' END AS reject_reason, CAST(COUNT(*) AS BIGINT) AS row_count
        FROM enc WHERE k % {star.BAD_STEP} IN (0, 1, 2) GROUP BY 1""",
)
def b6r(spark, sf_dir):
    return (
        promote.rejected(classified_encounters(spark, sf_dir))
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "b7_promote_resource",
    f"""SELECT load_run_id, resource_usage_id, encounter_id, {d('service_month')} AS service_month,
        {", ".join(f"{n(m)} AS {m}" for m in MEASURES)} FROM rres WHERE NOT rejected""",
)
def b7(spark, sf_dir):
    df = classified_children(spark, sf_dir, "resource_usage")["resource_usage"]
    return show(promote.accepted(df), RUN, *RESOURCE.columns)


@query(
    "b8_promote_direct_cost",
    f"""SELECT load_run_id, direct_cost_id, encounter_id, {d('service_month')} AS service_month, cost_centre_id,
        natural_account, direct_cost_type, {n('quantity')} AS quantity, {shown('amount')} AS amount
        FROM rdir WHERE NOT rejected""",
)
def b8(spark, sf_dir):
    df = classified_children(spark, sf_dir, "direct_cost_detail")["direct_cost_detail"]
    return show(promote.accepted(df), RUN, *DIRECT_COST.columns)


@query(
    "b9_promote_ledger",
    f"""SELECT load_run_id, gl_transaction_id, {d('reporting_month')} AS reporting_month, entity, facility,
        cost_centre_id, natural_account, account_description, {shown('signed_amount')} AS signed_amount,
        adjustment_type, source_reference FROM pgl""",
)
def b9(spark, sf_dir):
    df = promote.classify(star.ledger_landing(spark, sf_dir), LEDGER)
    return show(promote.accepted(df), RUN, *LEDGER.columns)


@query(
    "b10_promotion_summary",
    """SELECT CAST(1 AS BIGINT) AS load_run_id, e AS source_entity, CAST(l AS BIGINT) AS landing_count,
              CAST(s AS BIGINT) AS staged_count, CAST(l - s AS BIGINT) AS not_staged_count
       FROM (SELECT 'patient_encounter' AS e, (SELECT COUNT(*) FROM enc) AS l, (SELECT COUNT(*) FROM penc) AS s
             UNION ALL SELECT 'resource_usage', (SELECT COUNT(*) FROM res), (SELECT COUNT(*) FROM rres WHERE NOT rejected)
             UNION ALL SELECT 'direct_cost_detail', (SELECT COUNT(*) FROM dir), (SELECT COUNT(*) FROM rdir WHERE NOT rejected)
             UNION ALL SELECT 'general_ledger_transaction', (SELECT COUNT(*) FROM gl), (SELECT COUNT(*) FROM pgl)) t""",
)
def b10(spark, sf_dir):
    return promote.promotion_summary(
        {
            "patient_encounter": classified_encounters(spark, sf_dir),
            **classified_children(spark, sf_dir, "resource_usage", "direct_cost_detail"),
            "general_ledger_transaction": promote.classify(
                star.ledger_landing(spark, sf_dir), LEDGER
            ),
        }
    )


# --- reference lookups -----------------------------------------------------------


@query(
    "c3_mapped_ledger",
    f"""SELECT cost_centre_id, natural_account, cost_pool_code, cost_category, costing_treatment,
               allocation_driver, default_driver, centre_found, account_found,
               CAST(COUNT(*) AS BIGINT) AS row_count, {shown('SUM(signed_amount)')} AS amount
        FROM mapped GROUP BY ALL""",
)
def c3(spark, sf_dir):
    rows = mapped.map_ledger(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    return show(
        rows.groupBy(
            "cost_centre_id",
            "natural_account",
            "cost_pool_code",
            "cost_category",
            "costing_treatment",
            "allocation_driver",
            "default_driver",
            "centre_found",
            "account_found",
        ).agg(F.count(F.lit(1)).alias("row_count"), F.sum("signed_amount").alias("amount"))
    )


@query(
    "c6_not_staged",
    f"""SELECT CAST(k + 2 AS VARCHAR) AS source_row_number, ' ' || encounter_id || ' ' AS encounter_id
        FROM enc WHERE k % {star.BAD_STEP} IN (0, 1, 2)""",
)
def c6(spark, sf_dir):
    landed = star.encounter_landing(spark, sf_dir)
    staged = promote.accepted(classified_encounters(spark, sf_dir))
    return show(promote.not_staged(landed, staged), "source_row_number", "encounter_id")


@query(
    "c7_ledger_without_centre",
    f"""SELECT cost_centre_id, {d('reporting_month')} AS reporting_month, CAST(COUNT(*) AS BIGINT) AS row_count,
               {shown('SUM(signed_amount)')} AS amount
        FROM mapped WHERE NOT centre_found GROUP BY cost_centre_id, reporting_month""",
)
def c7(spark, sf_dir):
    missing = mapped.effective_join(
        star.ledger(spark, sf_dir),
        star.mapping(spark, sf_dir).cost_centre,
        ["cost_centre_id"],
        how="left_anti",
    )
    return show(
        missing.groupBy("cost_centre_id", "reporting_month").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("signed_amount").alias("amount")
        )
    )


# --- pools, drivers, allocation ------------------------------------------------------

_POOL_TEXT = "facility, cost_centre_id, natural_account, cost_pool_code"


@query(
    "h1_cost_pools",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, {_POOL_TEXT}, cost_category, costing_treatment,
               allocation_driver, pool_status, review_note, {n('source_transaction_count')} AS source_transaction_count,
               {shown('source_gl_amount')} AS source_gl_amount FROM pool""",
)
def h1(spark, sf_dir):
    return show(pools.cost_pools(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir)))


@query(
    "d13_ledger_control_totals",
    f"""SELECT {d('reporting_month')} AS reporting_month, cost_centre_id, {shown('SUM(signed_amount)')} AS signed_gl_total
        FROM gl GROUP BY reporting_month, cost_centre_id
        UNION ALL SELECT {d('reporting_month')}, NULL, {shown('SUM(signed_amount)')} FROM gl GROUP BY reporting_month""",
)
def d13(spark, sf_dir):
    gl = star.ledger(spark, sf_dir)
    by_centre = pools.ledger_totals(gl, "reporting_month", "cost_centre_id")
    by_month = by_centre.groupBy("reporting_month").agg(
        F.sum("signed_gl_total").cast(TOTAL).alias("signed_gl_total")
    )
    return show(by_centre.unionByName(by_month, allowMissingColumns=True))


@query(
    "d16_pool_status_summary",
    f"""SELECT load_run_id, pool_status, CAST(COUNT(*) AS BIGINT) AS pool_count,
               {shown('SUM(source_gl_amount)')} AS source_gl_amount FROM pool GROUP BY ALL""",
)
def d16(spark, sf_dir):
    return show(
        pools.pool_summary(
            pools.cost_pools(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
        )
    )


@query(
    "g5_unpivot_measures",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, encounter_id, cost_pool_code, allocation_driver,
               {shown('driver_units')} AS driver_units FROM drv WHERE allocation_driver <> 'encounter_count'""",
)
def g5(spark, sf_dir):
    return show(drivers.unpivot_measures(star.resource_usage(spark, sf_dir)))


@query(
    "h2_encounter_drivers",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, encounter_id, cost_pool_code, allocation_driver,
               {shown('driver_units')} AS driver_units,
               CASE WHEN driver_units > 0 THEN 'VALID' ELSE 'EXCLUDED' END AS driver_status,
               CASE WHEN driver_units = 0 THEN {q(K.NOTE_ZERO_UNITS)} END AS review_note FROM drv""",
)
def h2(spark, sf_dir):
    return show(
        drivers.encounter_drivers(
            star.resource_usage(spark, sf_dir), star.encounters(spark, sf_dir)
        )
    )


_TOT = f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, cost_pool_code, allocation_driver,
    {shown('total_driver_units')} AS total_driver_units FROM tot"""


@query("d2_driver_totals", _TOT)
def d2(spark, sf_dir):
    """Totals from the sources, measures summed before they are unpivoted."""
    return show(
        drivers.source_driver_totals(
            star.resource_usage(spark, sf_dir), star.encounters(spark, sf_dir)
        )
    )


@query("d2_driver_totals_from_rows", _TOT)
def d2r(spark, sf_dir):
    """The same totals from the driver rows."""
    return show(
        drivers.driver_totals(
            drivers.encounter_drivers(
                star.resource_usage(spark, sf_dir), star.encounters(spark, sf_dir)
            )
        )
    )


@query(
    "d16_driver_summary",
    f"""SELECT load_run_id, cost_pool_code, allocation_driver,
               CASE WHEN driver_units > 0 THEN 'VALID' ELSE 'EXCLUDED' END AS driver_status,
               CAST(COUNT(*) AS BIGINT) AS driver_rows, {shown('SUM(driver_units)')} AS total_driver_units
        FROM drv GROUP BY ALL""",
)
def d16d(spark, sf_dir):
    return show(
        drivers.driver_summary(
            drivers.encounter_drivers(
                star.resource_usage(spark, sf_dir), star.encounters(spark, sf_dir)
            )
        )
    )


@query(
    "m5_drivers_in_scope",
    f"""SELECT cost_pool_code, allocation_driver, CAST(COUNT(*) AS BIGINT) AS driver_rows,
               {shown('SUM(driver_units)')} AS driver_units
        FROM drv JOIN enc USING (encounter_id)
        WHERE NOT EXISTS (SELECT 1 FROM rule r WHERE r.cost_pool_code = drv.cost_pool_code
              AND r.allocation_driver = drv.allocation_driver
              AND drv.reporting_month BETWEEN r.effective_from AND r.effective_to)
           OR EXISTS (SELECT 1 FROM rule r WHERE r.cost_pool_code = drv.cost_pool_code
              AND r.allocation_driver = drv.allocation_driver
              AND drv.reporting_month BETWEEN r.effective_from AND r.effective_to
              AND (r.eligible_scope = 'All' OR list_contains(string_split(r.eligible_scope, '|'), care_type)
                   OR list_contains(string_split(r.eligible_scope, '|'), service_line)))
        GROUP BY ALL""",
)
def m5(spark, sf_dir):
    enc = star.encounters(spark, sf_dir)
    scoped = drivers.within_scope(
        drivers.encounter_drivers(star.resource_usage(spark, sf_dir), enc),
        enc,
        star.allocation_rules(spark),
    )
    return show(
        scoped.groupBy("cost_pool_code", "allocation_driver").agg(
            F.count(F.lit(1)).alias("driver_rows"), F.sum("driver_units").alias("driver_units")
        )
    )


@query(
    "h3_assign_direct",
    f"""SELECT load_run_id, direct_cost_id, encounter_id, {d('service_month')} AS service_month, cost_centre_id,
               natural_account, direct_cost_type, {n('quantity')} AS quantity, {shown('amount')} AS assigned_amount,
               'ASSIGNED' AS assignment_status FROM dok""",
)
def h3(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(run.assigned.drop("review_note"))


@query(
    "h4_pool_rates",
    f"""SELECT {d('reporting_month')} AS reporting_month, {_POOL_TEXT}, allocation_driver,
               {shown('source_gl_amount')} AS source_gl_amount, {shown('total_driver_units')} AS total_driver_units,
               ROUND(rate, 9) AS allocation_rate FROM rate""",
)
def h4r(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(
        run.rates.drop(RUN, "costing_treatment").withColumn(
            "allocation_rate", F.col("allocation_rate").cast("double")
        ),
        allocation_rate=9,
    )


@query(
    "h4_indirect_allocation_detail",
    f"""SELECT {d('reporting_month')} AS reporting_month, {_POOL_TEXT}, allocation_driver, encounter_id,
               {shown('d.driver_units')} AS encounter_driver_units,
               {shown(money('CAST(d.driver_units AS DOUBLE) * r.rate'))} AS allocated_amount
        FROM rate r JOIN drv d USING (load_run_id, reporting_month, cost_pool_code, allocation_driver)
        WHERE d.driver_units > 0""",
)
def h4d(spark, sf_dir):
    """Months and units are shown on the two sides, before pools multiply the driver rows."""
    run = costing_run(spark, sf_dir)
    rates = run.rates.withColumn("month", F.col("reporting_month").cast("string"))
    units = run.drivers.withColumn("units", F.round("driver_units", 2).cast("double"))
    detail = allocate.allocate(rates, units, carried=("month", "units"))
    return detail.select(
        F.col("month").alias("reporting_month"),
        "facility",
        "cost_centre_id",
        "natural_account",
        "cost_pool_code",
        "allocation_driver",
        "encounter_id",
        F.col("units").alias("encounter_driver_units"),
        F.round("allocated_amount", 2).cast("double").alias("allocated_amount"),
    )


@query(
    "h4_indirect_by_driver",
    f"""SELECT {d('reporting_month')} AS reporting_month, encounter_id, cost_pool_code, allocation_driver,
               {shown('driver_units')} AS encounter_driver_units, {shown('allocated_amount')} AS allocated_amount
        FROM alloc""",
)
def h4u(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(run.indirect_allocations.drop(RUN))


@query(
    "d4_indirect_by_encounter",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, encounter_id,
               {shown('allocated_amount')} AS allocated_amount FROM ind""",
)
def d4(spark, sf_dir):
    return show(costing_run(spark, sf_dir).indirect)


@query(
    "d4_direct_by_encounter",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, encounter_id,
               {shown('assigned_amount')} AS assigned_amount FROM dsum""",
)
def d4d(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(allocate.by_encounter_month(run.assigned, "assigned_amount", "service_month"))


@query(
    "c20_allocated_pools",
    f"""SELECT {d('reporting_month')} AS reporting_month, {_POOL_TEXT}, {shown('source_gl_amount')} AS source_gl_amount
        FROM rate""",
)
def c20(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(
        allocate.allocated_pools(run.pools, run.indirect_allocations),
        "reporting_month",
        "facility",
        "cost_centre_id",
        "natural_account",
        "cost_pool_code",
        "source_gl_amount",
    )


@query(
    "h5_pre_overhead_drivers",
    f"""SELECT {d('reporting_month')} AS reporting_month, encounter_id, {shown('pre')} AS driver_units,
               CASE WHEN pre > 0 THEN 'VALID' ELSE 'EXCLUDED' END AS driver_status,
               CASE WHEN pre = 0 THEN {q(K.NOTE_NO_PRE_OVERHEAD)} END AS review_note FROM base""",
)
def h5(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(
        drivers.pre_overhead_drivers(run.base),
        "reporting_month",
        "encounter_id",
        "driver_units",
        "driver_status",
        "review_note",
    )


@query(
    "h6_overhead_allocation",
    f"""SELECT {d('reporting_month')} AS reporting_month, encounter_id, {shown('pre')} AS encounter_driver_units,
               {shown(money('CAST(pre AS DOUBLE) * rate'))} AS allocated_amount
        FROM base JOIN (SELECT reporting_month, SUM(rate) AS rate FROM orate GROUP BY 1) o USING (reporting_month)
        WHERE pre > 0""",
)
def h6(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(
        run.overhead_allocations,
        "reporting_month",
        "encounter_id",
        "encounter_driver_units",
        "allocated_amount",
    )


# --- patient cost ----------------------------------------------------------------

_PARTS = ["direct_cost_amount", "indirect_cost_amount", "overhead_cost_amount", "total_patient_cost"]


def _cost_sql(table: str) -> str:
    return f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, encounter_id, facility, service_line, care_type,
        activity_group_code, {", ".join(f"{shown(c)} AS {c}" for c in _PARTS)} FROM {table}"""


_COST_COLUMNS = [RUN, "reporting_month", "encounter_id", "facility", "service_line", "care_type", "activity_group_code", *_PARTS]


@query("h7_patient_level_cost", _cost_sql("cost"))
def h7(spark, sf_dir):
    return show(costing_run(spark, sf_dir).costs, *_COST_COLUMNS)


@query("h7_patient_level_cost_all_months", _cost_sql("cost_all"))
def h7a(spark, sf_dir):
    return show(costing_run(spark, sf_dir, patient.ALL_MONTHS).costs, *_COST_COLUMNS)


def _by_facility(spark, sf_dir) -> CostingRun:
    run = costing_run(spark, sf_dir, apart=("facility",))
    run.ledger = star.ledger_by_facility(spark, sf_dir)
    return run


@query("h7_facility_costs", _cost_sql("cost_apart"))
def h7f(spark, sf_dir):
    """Each facility spreads its own pools over its own encounters."""
    return show(_by_facility(spark, sf_dir).costs, *_COST_COLUMNS)


@query(
    "h11_facility_reconciliation",
    "SELECT facility, "
    + ", ".join(
        shown(f"COALESCE(SUM(amount) FILTER (part = '{part}'), 0)") + f" AS {part}" for part in recon.AMOUNTS
    )
    + " FROM given_apart GROUP BY facility",
)
def h11f(spark, sf_dir):
    """What the pools of each facility gave away; no direct item is met by two of them."""
    pooled = _by_facility(spark, sf_dir).reconciliation.filter(
        "reconciliation_level = 'COST_POOL' AND facility IS NOT NULL"
    )
    return show(pooled.groupBy("facility").agg(*[F.sum(c).cast(TOTAL).alias(c) for c in recon.AMOUNTS]))


@query(
    "h4_facility_allocations",
    f"""SELECT p.facility, p.cost_pool_code, CAST(COUNT(*) AS BIGINT) AS allocation_rows,
               CAST(COUNT(*) FILTER (d.facility <> p.facility) AS BIGINT) AS foreign_rows,
               {shown('SUM(rate * CAST(driver_units AS DOUBLE))', 0)} AS allocated_amount
        FROM rate_apart p JOIN drv_apart d USING (load_run_id, reporting_month, facility, cost_pool_code, allocation_driver)
        WHERE driver_units > 0 GROUP BY ALL""",
)
def h4f(spark, sf_dir):
    """The audit listing of indirect pools, summed: pool rows and encounters of other facilities.

    Encounters give their place to the driver rows, before each of those meets several pools.
    """
    run = _by_facility(spark, sf_dir)
    known = [RUN, "encounter_id"]
    places = run.encounters.select(*known, F.col("facility").alias("place"))
    run.drivers = drivers.encounter_drivers(
        run.used.join(places, known), run.encounters.join(places, known), apart=("facility", "place")
    )
    run.carried = ("place",)
    rows = run.pool_allocations.filter(F.col("costing_treatment") == K.INDIRECT)
    return show(
        rows.groupBy("facility", "cost_pool_code").agg(
            F.count(F.lit(1)).alias("allocation_rows"),
            F.count(F.when(F.col("place") != F.col("facility"), 1)).alias("foreign_rows"),
            F.sum("allocated_amount").cast(TOTAL).alias("allocated_amount"),
        ),
        allocated_amount=0,
    )


@query(
    "h7_attribution_gap",
    f"""SELECT CAST(1 AS BIGINT) AS load_run_id, {shown('a')} AS allocated_amount, {shown('c')} AS attributed_amount,
               {shown('a - c')} AS unattributed_amount
        FROM (SELECT (SELECT SUM(allocated_amount) FROM ind) AS a, (SELECT SUM(indirect_cost_amount) FROM base) AS c) t""",
)
def h7g(spark, sf_dir):
    """Indirect cost is priced and summed once; the cost base and the gap read the stored sums."""
    run = costing_run(spark, sf_dir)
    run.indirect = stage(run.indirect, "indirect_cost")
    return show(patient.attribution_gap(run.indirect, run.base))


_LIM = """SELECT care_type, activity_group_code, CAST(cohort_count AS BIGINT) AS cohort_count,
    ROUND(p, 2) AS p95 FROM lim"""


def _limits(spark, sf_dir, accuracy=percentiles.ACCURACY):
    run = costing_run(spark, sf_dir)
    limits = percentiles.group_percentile(
        stage(run.costs, "patient_cost"), patient.COHORT, "total_patient_cost", K.HIGH_COST_PERCENTILE, "p95", accuracy
    )
    return show(limits, p95=2)


@query("e2_cohort_percentile", _LIM)
def e2(spark, sf_dir):
    return _limits(spark, sf_dir)


@query("e2_cohort_percentile_bracketed", _LIM)
def e2b(spark, sf_dir):
    """A coarse sketch: wide brackets, the same percentiles."""
    return _limits(spark, sf_dir, accuracy=20)


@query(
    "h8_high_cost_flags",
    f"""SELECT encounter_id, care_type, activity_group_code, {shown('total_patient_cost')} AS total_patient_cost,
               high_cost_flag, review_note FROM flagged""",
)
def h8(spark, sf_dir):
    return show(
        costing_run(spark, sf_dir).flagged,
        "encounter_id",
        *patient.COHORT,
        "total_patient_cost",
        "high_cost_flag",
        "review_note",
    )


@query(
    "d16_high_cost_summary",
    f"""SELECT load_run_id, high_cost_flag, CAST(COUNT(*) AS BIGINT) AS encounter_count,
               {shown('SUM(total_patient_cost)')} AS total_patient_cost FROM flagged GROUP BY ALL""",
)
def d16h(spark, sf_dir):
    return show(patient.high_cost_summary(costing_run(spark, sf_dir).flagged))


@query(
    "g2_most_expensive",
    f"""SELECT encounter_id, care_type, activity_group_code, {shown('total_patient_cost')} AS total_patient_cost,
               high_cost_flag, review_note FROM flagged WHERE high_cost_flag = 'Y'
        ORDER BY flagged.total_patient_cost DESC, encounter_id LIMIT 20""",
)
def g2(spark, sf_dir):
    return show(patient.most_expensive(costing_run(spark, sf_dir).flagged))


# --- unallocated and reconciliation -----------------------------------------------


@query(
    "h9_unallocated_costs",
    f"""SELECT {d('reporting_month')} AS reporting_month, {_POOL_TEXT}, cost_category, unallocated_reason,
               {shown('unallocated_amount')} AS unallocated_amount, source_record_type, resolution_status, review_note
        FROM una""",
)
def h9(spark, sf_dir):
    return show(costing_run(spark, sf_dir).unallocated.drop(RUN, "source_record_id"))


@query(
    "h9_unallocated_by_reason",
    f"""SELECT load_run_id, unallocated_reason, CAST(COUNT(*) AS BIGINT) AS row_count,
               {shown('SUM(unallocated_amount)')} AS unallocated_amount FROM una GROUP BY ALL""",
)
def h9s(spark, sf_dir):
    return show(unallocated.reason_summary(costing_run(spark, sf_dir).unallocated))


_REC_AMOUNTS = [*recon.AMOUNTS, "reconciliation_difference"]
_REC_SQL = f"""SELECT load_run_id, reconciliation_level, {d('reporting_month')} AS reporting_month, facility,
    cost_centre_id, cost_pool_code, cost_category,
    {", ".join(f"{shown(c)} AS {c}" for c in _REC_AMOUNTS)}, reconciliation_status, review_note"""


@query("h11_reconciliation", f"{_REC_SQL} FROM recon")
def h11(spark, sf_dir):
    return show(costing_run(spark, sf_dir).reconciliation)


@query("h13_reconciliation_total", f"{_REC_SQL} FROM total")
def h13(spark, sf_dir):
    rows = costing_run(spark, sf_dir).reconciliation
    return show(rows.filter(F.col("reconciliation_level") == "TOTAL"))


@query(
    "h13_total_with_overhead_zero_drivers",
    f"""SELECT CAST(1 AS BIGINT) AS load_run_id, {shown('SUM(unallocated_amount) + (SELECT COALESCE(SUM(p.source_gl_amount), 0) FROM pool p WHERE p.pool_status = ' + q('READY') + ' AND p.costing_treatment = ' + q('Overhead') + ' AND p.source_gl_amount <> 0 AND p.reporting_month NOT IN (SELECT reporting_month FROM otot))')} AS unallocated_amount,
               CAST(0 AS DOUBLE) AS reconciliation_difference, 'PASS' AS reconciliation_status FROM rec""",
)
def h13o(spark, sf_dir):
    """Overhead pools without a denominator also go to the unallocated ledger."""
    rows = costing_run(
        spark, sf_dir, zero_driver_treatments=(K.INDIRECT, K.OVERHEAD)
    ).reconciliation
    total = rows.filter(F.col("reconciliation_level") == "TOTAL")
    return show(
        total.withColumn(
            "reconciliation_difference", F.abs(F.round("reconciliation_difference", 0))
        ),
        RUN,
        "unallocated_amount",
        "reconciliation_difference",
        "reconciliation_status",
    )


@query(
    "d9_reconciliation_summary",
    f"""SELECT load_run_id, reconciliation_level, CAST(COUNT(*) AS BIGINT) AS row_count,
               CAST(COUNT(DISTINCT cost_category) AS BIGINT) AS cost_category_count,
               CAST(COUNT(DISTINCT cost_pool_code) AS BIGINT) AS cost_pool_count,
               {", ".join(f"{shown(f'SUM({c})')} AS {c}" for c in _REC_AMOUNTS)} FROM recon GROUP BY ALL""",
)
def d9(spark, sf_dir):
    return show(recon.reconciliation_summary(costing_run(spark, sf_dir).reconciliation))


@query(
    "h12_unmatched_rows",
    f"""SELECT {d('reporting_month')} AS reporting_month, cost_centre_id, cost_pool_code, cost_category,
               CAST(0 AS DOUBLE) AS gl_amount, {shown('SUM(unallocated_amount)')} AS unallocated_amount,
               {shown('-SUM(unallocated_amount)')} AS reconciliation_difference, 'REVIEW' AS reconciliation_status
        FROM una WHERE source_record_type <> 'COST_POOL' GROUP BY reporting_month, cost_centre_id, cost_pool_code, cost_category""",
)
def h12(spark, sf_dir):
    return show(
        recon.reconcile_unmatched(costing_run(spark, sf_dir).unallocated),
        "reporting_month",
        "cost_centre_id",
        "cost_pool_code",
        "cost_category",
        "gl_amount",
        "unallocated_amount",
        "reconciliation_difference",
        "reconciliation_status",
    )


@query(
    "c12_shared_direct_keys",
    f"""SELECT load_run_id, {d('reporting_month')} AS reporting_month, cost_centre_id, natural_account,
               CAST(COUNT(*) AS BIGINT) AS pool_count
        FROM (SELECT DISTINCT load_run_id, reporting_month, cost_centre_id, natural_account, adjustment_type FROM gl) t
        GROUP BY ALL HAVING COUNT(*) > 1""",
)
def c12(spark, sf_dir):
    """Pools kept apart by adjustment type would claim the same direct items."""
    split = star.ledger(spark, sf_dir).withColumn("facility", F.col("adjustment_type"))
    return show(
        recon.shared_direct_keys(pools.cost_pools(split, star.mapping(spark, sf_dir)))
    )


# --- funding ------------------------------------------------------------------------


@query(
    "h10_funding_comparison",
    f"""SELECT {d('reporting_month')} AS reporting_month, encounter_id, activity_group_code,
               {shown('total_patient_cost')} AS total_patient_cost, {shown('weight', 6)} AS synthetic_base_weight,
               {shown('factor', 6)} AS synthetic_adjustment_factor, {shown('synthetic_nwau', 6)} AS synthetic_nwau,
               {shown('synthetic_funding_amount')} AS synthetic_funding_amount,
               {shown('total_patient_cost - synthetic_funding_amount')} AS cost_funding_variance, funding_status,
               CASE WHEN funded THEN {q(K.NOTE_FUNDED)} ELSE {q(K.NOTE_UNFUNDED)} END AS review_note FROM cmp""",
)
def h10(spark, sf_dir):
    df = costing_run(spark, sf_dir).comparison
    return show(
        df.drop(RUN, "facility", "service_line", "care_type"),
        synthetic_base_weight=6,
        synthetic_adjustment_factor=6,
        synthetic_nwau=6,
    )


@query(
    "d8_funding_summary",
    f"""SELECT load_run_id, funding_status, CAST(COUNT(*) AS BIGINT) AS encounter_count,
               {shown('SUM(total_patient_cost)')} AS total_patient_cost, {shown('SUM(synthetic_nwau)')} AS synthetic_nwau,
               {shown('SUM(synthetic_funding_amount)')} AS synthetic_funding_amount,
               {shown('SUM(total_patient_cost - synthetic_funding_amount)')} AS cost_funding_variance
        FROM cmp GROUP BY ALL""",
)
def d8(spark, sf_dir):
    return show(funding.funding_summary(costing_run(spark, sf_dir).comparison))


@query(
    "h14_encounter_funding",
    f"""SELECT encounter_id, {d('episode_month')} AS episode_month, activity_group_code, service_stream,
               {shown('base_weight', 6)} AS base_weight, {shown('demographic_adjustment_factor', 6)} AS demographic_adjustment_factor,
               {shown('long_stay_outlier_nwau', 6)} AS long_stay_outlier_nwau, {shown('final_synthetic_nwau', 6)} AS final_synthetic_nwau,
               CAST(10750 AS DOUBLE) AS synthetic_base_price, {shown('estimated_synthetic_funding')} AS estimated_synthetic_funding,
               funding_status, funding_note FROM fund""",
)
def h14(spark, sf_dir):
    return show(
        _encounter_funding(spark, sf_dir).drop(RUN),
        base_weight=6,
        demographic_adjustment_factor=6,
        long_stay_outlier_nwau=6,
        final_synthetic_nwau=6,
    )


@query("d12_monthly_funding_control", _CONTROL_SQL)
def d12(spark, sf_dir):
    return show(
        funding.monthly_funding_control(_encounter_funding(spark, sf_dir)),
        total_synthetic_nwau=6,
    )


# --- data quality ----------------------------------------------------------------------

_RESULT_SQL = """SELECT CAST(1 AS BIGINT) AS load_run_id, {rule} AS validation_rule_id, {evaluated} AS evaluated_row_count,
    {failed} AS failed_row_count, {amount} AS affected_amount,
    CASE WHEN {failed} = 0 THEN 'PASS' ELSE {bad} END AS validation_status, {message} AS result_message FROM {table}"""


def _result_sql(rule, table, failed, amount, bad) -> str:
    return _RESULT_SQL.format(
        rule=q(rule),
        evaluated="CAST(COUNT(*) AS BIGINT)",
        failed=f"CAST(COUNT(*) FILTER ({failed}) AS BIGINT)",
        amount="CAST(NULL AS DOUBLE)"
        if amount is None
        else shown(f"SUM(CASE WHEN {failed} THEN {amount} ELSE 0 END)"),
        bad=q(bad),
        message=q(K.RULE_TEXTS[rule][0]),
        table=table,
    )


def _issue_sql(rule, entity, table, where, key, value, impact, file=None, line="CAST(NULL AS BIGINT)") -> str:
    _, column, owner, action = K.RULE_TEXTS[rule]
    return f"""SELECT CAST(1 AS BIGINT) AS load_run_id, {q(rule)} AS validation_rule_id, {q(entity)} AS source_entity,
        {q(file or entity + '.csv')} AS source_file_name, CAST({line} AS VARCHAR) AS source_row_number, {key} AS business_key,
        {q(column)} AS field_name, {value} AS invalid_value, {impact} AS financial_impact, 'OPEN' AS issue_status,
        {q(owner)} AS recommended_owner, {q(action)} AS recommended_action FROM {table} WHERE {where}"""


def _landed(expr: str, spoiled: str | None = None) -> str:
    value = f"' ' || CAST({expr} AS VARCHAR) || ' '"
    return f"(CASE WHEN {spoiled} THEN 'bad' ELSE {value} END)" if spoiled else f"({value})"


def _listed(**columns) -> str:
    return " || ".join(
        f"'{'; ' if i else ''}{name}=' || {value}" for i, (name, value) in enumerate(columns.items())
    )


_RU = ("RU_NOT_PROMOTED", "rres", "rejected", None, "FAIL")
_DC = ("DC_NOT_PROMOTED", "rdir", "rejected", "amount", "FAIL")
_CC = ("GL_UNKNOWN_COST_CENTRE", "mapped", "NOT centre_found", "signed_amount", "REVIEW")
_AC = ("GL_UNMAPPED_ACCOUNT", "mapped", "NOT account_found", "signed_amount", "REVIEW")
_ZERO_SQL = _result_sql(
    "ZERO_DRIVER_POOL",
    """(SELECT p.*, z.cost_pool_code IS NOT NULL AS is_zero FROM pool p LEFT JOIN zero z
        USING (reporting_month, facility, cost_centre_id, natural_account, cost_pool_code)
        WHERE p.pool_status = 'READY' AND p.costing_treatment = 'Indirect') t""",
    "is_zero",
    "source_gl_amount",
    "REVIEW",
)
_RU_ISSUES = _issue_sql(
    "RU_NOT_PROMOTED",
    "resource_usage",
    "rres",
    "rejected",
    _landed("resource_usage_id"),
    _listed(
        encounter_id=_landed("encounter_id"),
        **{m: _landed(m, "bad_bed" if m == "bed_days" else None) for m in MEASURES},
    ),
    "CAST(NULL AS DOUBLE)",
    line=n("k * 2 + CAST(string_split(resource_usage_id, '-')[2] AS BIGINT) + 2"),
)
_DC_ISSUES = _issue_sql(
    "DC_NOT_PROMOTED",
    "direct_cost_detail",
    "rdir",
    "rejected",
    _landed("direct_cost_id"),
    _listed(
        encounter_id=_landed("encounter_id"),
        service_month=_landed("service_month"),
        cost_centre_id=_landed("cost_centre_id"),
        natural_account=_landed("natural_account"),
        quantity=_landed("quantity", "bad_quantity"),
        amount=_landed("amount"),
    ),
    shown("amount"),
)


def _gl_issue_sql(rule, column, where) -> str:
    return _issue_sql(
        rule, "general_ledger_transaction", "mapped", where, "gl_transaction_id", column,
        shown("signed_amount"),
    )


_ZERO_ISSUES = _issue_sql(
    "ZERO_DRIVER_POOL",
    "costing.cost_pool",
    "zero",
    "TRUE",
    "CAST(reporting_month AS VARCHAR) || '|' || facility || '|' || cost_centre_id || '|' || natural_account || '|' || cost_pool_code",
    _listed(
        reporting_month="CAST(reporting_month AS VARCHAR)",
        cost_pool_code="cost_pool_code",
        allocation_driver="allocation_driver",
        total_valid_driver_units="'0.000000'",
    ),
    shown("source_gl_amount"),
    file="costing.cost_pool",
)


@query("i1_resource_result", _result_sql(*_RU))
def i1(spark, sf_dir):
    df = classified_children(spark, sf_dir, "resource_usage")["resource_usage"]
    return show(quality.resource_not_promoted(df)[0])


@query("i1_resource_issues", _RU_ISSUES)
def i1i(spark, sf_dir):
    df = classified_children(spark, sf_dir, "resource_usage")["resource_usage"]
    return show(quality.resource_not_promoted(df)[1])


@query("i2_direct_result", _result_sql(*_DC))
def i2(spark, sf_dir):
    df = classified_children(spark, sf_dir, "direct_cost_detail")["direct_cost_detail"]
    return show(quality.direct_not_promoted(df)[0])


@query("i2_direct_issues", _DC_ISSUES)
def i2i(spark, sf_dir):
    df = classified_children(spark, sf_dir, "direct_cost_detail")["direct_cost_detail"]
    return show(quality.direct_not_promoted(df)[1])


@query("i3_unknown_centre_result", _result_sql(*_CC))
def i3(spark, sf_dir):
    pair = quality.unknown_cost_centre(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    return show(pair[0])


@query(
    "i3_unknown_centre_issues",
    _gl_issue_sql("GL_UNKNOWN_COST_CENTRE", "cost_centre_id", "NOT centre_found"),
)
def i3i(spark, sf_dir):
    pair = quality.unknown_cost_centre(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    return show(pair[1])


@query("i4_unmapped_account_result", _result_sql(*_AC))
def i4(spark, sf_dir):
    pair = quality.unmapped_account(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    return show(pair[0])


@query(
    "i4_unmapped_account_issues",
    _gl_issue_sql("GL_UNMAPPED_ACCOUNT", "natural_account", "NOT account_found"),
)
def i4i(spark, sf_dir):
    pair = quality.unmapped_account(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    return show(pair[1])


@query("i5_zero_driver_result", _ZERO_SQL)
def i5(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(quality.zero_driver(run.pools, run.zero_driver)[0])


@query("i5_zero_driver_issues", _ZERO_ISSUES)
def i5i(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(quality.zero_driver(run.pools, run.zero_driver)[1])


def _register(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Results and issues of all five rules; neither is computed before it is read."""
    run = costing_run(spark, sf_dir)
    children = classified_children(spark, sf_dir, "resource_usage", "direct_cost_detail")
    gl, refs = run.ledger, run.mapping
    results, issues = quality.gather(
        quality.resource_not_promoted(children["resource_usage"]),
        quality.direct_not_promoted(children["direct_cost_detail"]),
        quality.unknown_cost_centre(gl, refs),
        quality.unmapped_account(gl, refs),
        quality.zero_driver(run.pools, run.zero_driver),
    )
    return results, issues


_REGISTER = " UNION ALL ".join(
    [
        _RU_ISSUES,
        _DC_ISSUES,
        _gl_issue_sql("GL_UNKNOWN_COST_CENTRE", "cost_centre_id", "NOT centre_found"),
        _gl_issue_sql("GL_UNMAPPED_ACCOUNT", "natural_account", "NOT account_found"),
        _ZERO_ISSUES,
    ]
)
_IMPACTS = """SELECT load_run_id, 'resource_usage' AS source_entity, 'resource_usage_driver_values' AS field_name,
        CAST(NULL AS DECIMAL(19,6)) AS impact FROM rres WHERE rejected
    UNION ALL SELECT load_run_id, 'direct_cost_detail', 'encounter_id', amount FROM rdir WHERE rejected
    UNION ALL SELECT load_run_id, 'general_ledger_transaction', 'cost_centre_id', signed_amount FROM mapped WHERE NOT centre_found
    UNION ALL SELECT load_run_id, 'general_ledger_transaction', 'natural_account', signed_amount FROM mapped WHERE NOT account_found
    UNION ALL SELECT load_run_id, 'costing.cost_pool', 'allocation_driver', source_gl_amount FROM zero"""
_RESULTS = " UNION ALL ".join([*[_result_sql(*rule) for rule in (_RU, _DC, _CC, _AC)], _ZERO_SQL])


@query("i7_issue_register", _REGISTER)
def i7(spark, sf_dir):
    return show(_register(spark, sf_dir)[1])


@query(
    "i7_issue_life_cycle",
    f"""SELECT CAST(2 AS BIGINT) AS load_run_id, 'GL_UNKNOWN_COST_CENTRE' AS validation_rule_id,
               CASE WHEN again THEN 'OPEN' ELSE 'RESOLVED' END AS issue_status, again AND NOT was AS new_flag,
               CAST(COUNT(*) AS BIGINT) AS issue_count, {shown('SUM(signed_amount)')} AS financial_impact
        FROM (SELECT signed_amount, signed_amount > 10000 AS again, bool_or(signed_amount < 40000) OVER same AS was,
                     bool_or(signed_amount > 10000) OVER same AS key_again
              FROM mapped WHERE NOT centre_found WINDOW same AS (PARTITION BY gl_transaction_id)) t
        WHERE again OR NOT key_again GROUP BY ALL""",
)
def i7l(spark, sf_dir):
    """Two runs: small issues of the first are gone in the second, large ones are new there."""
    ledger, refs = star.ledger(spark, sf_dir), star.mapping(spark, sf_dir)
    issues = stage(quality.unknown_cost_centre(ledger, refs)[1], "issues")
    first, second = (datetime(2025, month, 1) for month in (7, 8))
    before = quality.carry_forward(None, issues.filter("financial_impact < 40000"), 1, first)
    found = issues.filter("financial_impact > 10000").withColumn(RUN, F.lit(2).cast("long"))
    return show(quality.life_summary(quality.carry_forward(stage(before, "lives"), found, 2, second)))


@query(
    "i7_issue_summary",
    f"""SELECT load_run_id, source_entity, field_name, CAST(COUNT(*) AS BIGINT) AS issue_count,
               {shown('SUM(COALESCE(impact, 0))')} AS financial_impact FROM ({_IMPACTS}) t GROUP BY ALL""",
)
def i7s(spark, sf_dir):
    return show(quality.issue_summary(_register(spark, sf_dir)[1]))


# --- reporting views ---------------------------------------------------------------------

_RULE_VALUES = ", ".join("(" + ", ".join(q(v) for v in rule) + ")" for rule in K.RULES)


@query(
    "j1_dim_month",
    f"""SELECT {d('reporting_month')} AS reporting_month, {d('reporting_month')} AS period_start,
               {d('last_day(reporting_month)')} AS period_end,
               CAST(fy AS VARCHAR) || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
               CAST(p AS BIGINT) AS period_number,
               CAST(fy AS VARCHAR) || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0') || ' P' || lpad(CAST(p AS VARCHAR), 2, '0') AS period_label
        FROM (SELECT reporting_month, year(reporting_month) - CASE WHEN month(reporting_month) < 7 THEN 1 ELSE 0 END AS fy,
                     (month(reporting_month) + 5) % 12 + 1 AS p FROM period) t""",
)
def j1(spark, sf_dir):
    return show(reporting.dim_month(star.reporting_periods(spark, sf_dir)))


@query("j2_dim_facility", "SELECT DISTINCT facility FROM enc")
def j2(spark, sf_dir):
    return reporting.dim_facility(star.encounters(spark, sf_dir))


@query(
    "j3_dim_service_line",
    """SELECT DISTINCT o_orderpriority AS service_line, 'Priority ' || o_orderpriority AS service_line_description FROM orders""",
)
def j3(spark, sf_dir):
    lines = star.table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return reporting.dim_service_line(
        lines.select(
            F.col("o_orderpriority").alias("service_line"),
            F.concat(F.lit("Priority "), "o_orderpriority").alias("description"),
        )
    )


@query(
    "j3_dim_care_type",
    "SELECT DISTINCT care_type, 'Care: ' || care_type AS care_type_description FROM enc",
)
def j3c(spark, sf_dir):
    care = star.encounters(spark, sf_dir).select("care_type").distinct()
    return reporting.dim_care_type(
        care.withColumn("description", F.concat(F.lit("Care: "), "care_type"))
    )


@query(
    "j4_dim_activity_group",
    """SELECT activity_group_code, MIN(segment) AS activity_group_name, MIN(service_line) AS default_service_line,
              MIN(care_type) AS default_care_type, 'N' AS official_classification_flag
       FROM (SELECT activity_group_code, service_line, care_type, c_mktsegment AS segment
             FROM enc JOIN customer ON CAST(c_custkey AS VARCHAR) = patient_id) t GROUP BY 1""",
)
def j4(spark, sf_dir):
    customers = star.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"), "c_mktsegment"
    )
    groups = (
        star.encounters(spark, sf_dir)
        .join(customers, "patient_id")
        .groupBy("activity_group_code")
        .agg(
            F.min("c_mktsegment").alias("activity_group_name"),
            F.min("service_line").alias("default_service_line"),
            F.min("care_type").alias("default_care_type"),
        )
        .withColumn("official_classification_flag", F.lit("N"))
    )
    return reporting.dim_activity_group(groups)


@query("j5_dim_cost_category", "SELECT DISTINCT cost_category FROM pool")
def j5(spark, sf_dir):
    return reporting.dim_cost_category(
        pools.cost_pools(star.ledger(spark, sf_dir), star.mapping(spark, sf_dir))
    )


@query(
    "j6_fact_patient_cost",
    f"""SELECT {d('reporting_month')} AS reporting_month, encounter_id, {", ".join(f"{shown(c)} AS {c}" for c in _PARTS)},
               {", ".join(f"{ratio(f'{p}_cost_amount', 'total_patient_cost')} AS {p}_cost_share" for p in ("direct", "indirect", "overhead"))},
               'FINAL' AS cost_status, high_cost_flag, review_note, {n('length_of_stay')} AS length_of_stay, {n('age_years')} AS age_years,
               indigenous_status, remoteness_area, high_complexity_flag, hospital_acquired_complication_flag FROM flagged""",
)
def j6(spark, sf_dir):
    facts = reporting.fact_patient_cost(costing_run(spark, sf_dir).flagged)
    shares = {f"{p}_cost_share": 6 for p in ("direct", "indirect", "overhead")}
    return show(
        facts.drop(RUN, "facility", "service_line", "care_type", "activity_group_code"), **shares
    )


@query(
    "j7_fact_abf_comparison",
    f"""SELECT encounter_id, funding_status, {shown('synthetic_nwau', 6)} AS synthetic_nwau,
               {shown('synthetic_funding_amount')} AS synthetic_funding_amount,
               {shown('total_patient_cost - synthetic_funding_amount')} AS cost_funding_variance,
               {ratio('(total_patient_cost - synthetic_funding_amount)', 'synthetic_funding_amount')} AS cost_funding_variance_pct
        FROM cmp""",
)
def j7(spark, sf_dir):
    facts = reporting.fact_abf_comparison(costing_run(spark, sf_dir).comparison)
    return show(
        facts,
        "encounter_id",
        "funding_status",
        "synthetic_nwau",
        "synthetic_funding_amount",
        "cost_funding_variance",
        "cost_funding_variance_pct",
        synthetic_nwau=6,
        cost_funding_variance_pct=6,
    )


@query(
    "j8_fact_reconciliation",
    f"""SELECT reconciliation_level, {d('reporting_month')} AS reporting_month, cost_centre_id, cost_pool_code, cost_category,
               {shown('gl_amount')} AS gl_amount, {shown('reconciliation_difference')} AS reconciliation_difference,
               {ratio('reconciliation_difference', 'gl_amount', 4)} AS reconciliation_difference_pct, reconciliation_status,
               CASE WHEN reconciliation_level = 'TOTAL' THEN 'Total reconciliation' ELSE 'Cost-pool reconciliation' END AS reconciliation_level_label
        FROM recon""",
)
def j8(spark, sf_dir):
    facts = reporting.fact_reconciliation(costing_run(spark, sf_dir).reconciliation)
    return show(
        facts,
        "reconciliation_level",
        "reporting_month",
        "cost_centre_id",
        "cost_pool_code",
        "cost_category",
        "gl_amount",
        "reconciliation_difference",
        "reconciliation_difference_pct",
        "reconciliation_status",
        "reconciliation_level_label",
        reconciliation_difference_pct=4,
    )


@query(
    "j9_fact_data_quality_issue",
    f"""SELECT i.*, r.rule_name, r.rule_category, r.severity, r.blocking_flag, v.validation_status
        FROM ({_REGISTER}) i JOIN ({_RESULTS}) v USING (load_run_id, validation_rule_id)
        JOIN (SELECT * FROM (VALUES {_RULE_VALUES}) AS t({", ".join(K.RULE_COLUMNS)})) r USING (validation_rule_id)""",
)
def j9(spark, sf_dir):
    results, issues = _register(spark, sf_dir)
    return show(
        reporting.fact_data_quality_issue(issues, results, quality.rule_catalogue(spark))
    )


@query(
    "j10_view_counts",
    """SELECT 'vw_fact_patient_cost' AS view_name, CAST(COUNT(*) AS BIGINT) AS row_count,
              CAST(COUNT(DISTINCT encounter_id) AS BIGINT) AS distinct_encounters FROM enc
       UNION ALL SELECT 'vw_fact_abf_comparison', CAST(COUNT(*) AS BIGINT), CAST(COUNT(DISTINCT encounter_id) AS BIGINT) FROM enc""",
)
def j10(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return reporting.view_counts(
        run.costs, reporting.fact_abf_comparison(run.comparison)
    )


@query(
    "j10_cost_tie_out",
    f"""SELECT CAST(COUNT(*) AS BIGINT) AS patient_cost_rows, {shown('SUM(total_patient_cost)')} AS patient_cost_total,
               CAST(COUNT(*) AS BIGINT) AS abf_rows, {shown('SUM(total_patient_cost)')} AS abf_patient_cost_total,
               CAST(0 AS DOUBLE) AS difference FROM cost""",
)
def j10t(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    return show(reporting.cost_tie_out(run.costs, run.comparison))


@query(
    "j10_issue_totals",
    f"""SELECT CAST(COUNT(*) AS BIGINT) AS issue_count, {shown('SUM(COALESCE(impact, 0))')} AS financial_impact
        FROM ({_IMPACTS}) t""",
)
def j10i(spark, sf_dir):
    return show(reporting.issue_totals(_register(spark, sf_dir)[1]))


# --- summaries ----------------------------------------------------------------------------


def _summary_sql(table: str, measures) -> str:
    return " UNION ALL ".join(
        f"""SELECT {q(m)} AS measure, CAST(COUNT({m}) AS BIGINT) AS count, ROUND(MIN(CAST({m} AS DOUBLE)), 3) AS min,
            ROUND(AVG(CAST({m} AS DOUBLE)), 3) AS mean, ROUND(quantile_cont(CAST({m} AS DOUBLE), 0.5), 3) AS median,
            ROUND(quantile_cont(CAST({m} AS DOUBLE), 0.95), 3) AS p95, ROUND(MAX(CAST({m} AS DOUBLE)), 3) AS max FROM {table}"""
        for m in measures
    )


@query("d14_resource_summary", _summary_sql("res", MEASURES))
def d14(spark, sf_dir):
    return summaries.numeric_summary(
        star.resource_usage(spark, sf_dir), list(MEASURES), non_negative_only=True
    )


@query("d14_encounter_summary", _summary_sql("enc", ["age_years", "length_of_stay"]))
def d14e(spark, sf_dir):
    return summaries.numeric_summary(
        star.encounters(spark, sf_dir), ["age_years", "length_of_stay"]
    )


@query(
    "k21_ledger_statistics",
    f"""SELECT load_run_id, 'run' AS level, NULL AS value, CAST(COUNT(*) AS BIGINT) AS row_count, {shown('SUM(signed_amount)')} AS signed_amount
        FROM gl GROUP BY 1
        UNION ALL SELECT load_run_id, 'reporting_month', {d('reporting_month')}, CAST(COUNT(*) AS BIGINT), {shown('SUM(signed_amount)')}
        FROM gl GROUP BY 1, reporting_month
        UNION ALL SELECT load_run_id, 'adjustment_type', adjustment_type, CAST(COUNT(*) AS BIGINT), {shown('SUM(signed_amount)')}
        FROM gl GROUP BY 1, adjustment_type""",
)
def k21l(spark, sf_dir):
    return show(summaries.ledger_statistics(star.ledger(spark, sf_dir)))


_FUNDED = "CAST(COUNT(*) AS BIGINT) AS row_count, " + ", ".join(
    f"""{shown(f"COALESCE(SUM(CASE WHEN funding_status = 'CALCULATED' THEN {c} END), 0)")} AS {c}"""
    for c in ("final_synthetic_nwau", "estimated_synthetic_funding")
)


@query(
    "k21_funding_statistics",
    f"""SELECT load_run_id, 'run' AS level, NULL AS value, {_FUNDED} FROM fund GROUP BY 1
        UNION ALL SELECT load_run_id, 'funding_status', funding_status, {_FUNDED} FROM fund GROUP BY 1, funding_status
        UNION ALL SELECT load_run_id, 'episode_month', {d('episode_month')}, {_FUNDED} FROM fund GROUP BY 1, episode_month""",
)
def k21f(spark, sf_dir):
    return show(summaries.funding_statistics(_encounter_funding(spark, sf_dir)))


@query(
    "k21_numeric_summaries",
    _summary_sql("(SELECT SUM(signed_amount) AS signed_gl_total FROM gl GROUP BY load_run_id, reporting_month) t", ["signed_gl_total"])
    + " UNION ALL "
    + _summary_sql("(SELECT final_synthetic_nwau FROM fund WHERE funding_status = 'CALCULATED') t", ["final_synthetic_nwau"]),
)
def k21n(spark, sf_dir):
    """Monthly ledger totals and the weighted activity of funded encounters."""
    monthly = pools.ledger_totals(star.ledger(spark, sf_dir), RUN, "reporting_month")
    funded = _encounter_funding(spark, sf_dir).filter("funding_status = 'CALCULATED'")
    return summaries.numeric_summary(monthly, ["signed_gl_total"]).unionByName(
        summaries.numeric_summary(funded, ["final_synthetic_nwau"])
    )


_ATTRIBUTES = ("service_line", "care_type", "activity_group_code", "episode_month")


@query(
    "d15_encounter_frequencies",
    " UNION ALL ".join(
        f"""SELECT {q(a)} AS attribute, CAST({a} AS VARCHAR) AS value, CAST(COUNT(*) AS BIGINT) AS n,
            ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM enc), 6) AS share FROM enc GROUP BY {a}"""
        for a in _ATTRIBUTES
    ),
)
def d15(spark, sf_dir):
    return show(summaries.frequencies(star.encounters(spark, sf_dir), *_ATTRIBUTES))


# --- stays over months ----------------------------------------------------------------------

_STAY = """SELECT load_run_id, encounter_id, care_type, admission_date, discharge_date, age_years, length_of_stay,
    CAST(unnest(generate_series(date_trunc('month', admission_date), date_trunc('month', discharge_date), INTERVAL 1 MONTH)) AS DATE) AS service_month
    FROM enc"""
_STAY_POS = f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY encounter_id ORDER BY service_month) - 1 AS pos,
    COUNT(*) OVER (PARTITION BY encounter_id) AS months FROM ({_STAY}) s"""
_DAYS = "greatest(0, date_diff('day', greatest(admission_date, service_month), least(discharge_date, last_day(service_month))) + 1)"


@query(
    "l1_stay_months",
    f"""SELECT encounter_id, {d('service_month')} AS service_month, {n('pos')} AS month_position, {n('months')} AS month_count
        FROM ({_STAY_POS}) t""",
)
def l1(spark, sf_dir):
    return show(
        timeline.stay_months(star.encounters(spark, sf_dir)),
        "encounter_id",
        "service_month",
        "month_position",
        "month_count",
    )


@query(
    "l2_bed_days_and_splits",
    f"""SELECT load_run_id, encounter_id, {d('service_month')} AS service_month,
               CAST(CASE WHEN care_type IN ('Same-day', 'Emergency', 'Outpatient') THEN 0
                         WHEN pos = months - 1 AND {_DAYS} > 0 THEN greatest(1, {_DAYS} - 1) ELSE {_DAYS} END AS BIGINT) AS bed_days,
               {", ".join(f"CAST(CASE WHEN pos = 0 THEN {m} - ({m} // months) * (months - 1) ELSE {m} // months END AS BIGINT) AS {m}" for m in ("age_years", "length_of_stay"))}
        FROM ({_STAY_POS}) t""",
)
def l2(spark, sf_dir):
    """Age and length of stay stand in for whole-stay measures to be split."""
    return show(
        timeline.spread_over_months(
            star.encounters(spark, sf_dir), ["age_years", "length_of_stay"]
        )
    )


@query(
    "l4_direct_to_ledger",
    f"""SELECT load_run_id, {d('service_month')} AS reporting_month, cost_centre_id, natural_account,
               {shown('SUM(amount)')} AS signed_amount, 'Standard expense' AS adjustment_type,
               'DIRECT-CONTROL-' || CAST(service_month AS VARCHAR) || '-' || cost_centre_id || '-' || natural_account AS source_reference
        FROM dir GROUP BY ALL""",
)
def l4(spark, sf_dir):
    return show(timeline.direct_to_ledger(star.direct_items(spark, sf_dir)))


# --- assurance checks -------------------------------------------------------------------------

_FIRST_MONTH, _LAST_MONTH = (1995, 1), (2001, 8)
_MONTHS = [
    f"{y}-{m:02d}-01"
    for y in range(_FIRST_MONTH[0], _LAST_MONTH[0] + 1)
    for m in range(1, 13)
    if _FIRST_MONTH <= (y, m) <= _LAST_MONTH
]
STAR_YEAR = checks.Expectations(
    service_lines=star.PRIORITIES,
    months=_MONTHS,
    theatre_lines=star.PRIORITIES[:2],
    unknown_centre=f"CC_{star.UNMAPPED_NATION}",
    zero_driver_centre="CC_11",
)


def _checks_twin(table: str, rows) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT {q(i)} AS check_id, CASE WHEN {ok} THEN {q(good)} ELSE {q(bad)} END AS status,
            CAST({seen} AS VARCHAR) AS observed FROM totals_row"""
        for i, ok, seen, good, bad in rows
    )
    inner = twin(table)
    cut = inner.rindex("\nSELECT") if inner.startswith("WITH") else 0
    head, body = inner[:cut], inner[cut:].strip()
    return (f"{head}, " if head else "WITH ") + f"totals_row AS ({body})\n{parts}"


def _check_query(name: str, table: str, rows):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        TWINS[name] = _checks_twin(table, rows)
        return fn

    return register


def _seen(df: DataFrame) -> DataFrame:
    return df.select("check_id", "status", "observed")


def _in(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


_P, _E, _X, _W = "PASS", "ERROR", "EXPECTED", "WARNING"


_ENCOUNTER_CHECKS = (
    f"""SELECT COUNT(*) AS n, COUNT(DISTINCT encounter_id) AS ids,
          (SELECT COUNT(DISTINCT service_line) FROM enc) AS lines, (SELECT COUNT(DISTINCT care_type) FROM enc) AS cares,
          COUNT(DISTINCT CASE WHEN CAST(episode_month AS VARCHAR) IN {_in(_MONTHS)} THEN episode_month END) AS months,
          COUNT(*) FILTER (CAST(episode_month AS VARCHAR) NOT IN {_in(_MONTHS)}) AS other_months,
          COUNT(*) FILTER (discharge_date < admission_date OR length_of_stay < 0) AS dates,
          COUNT(*) FILTER (age_years NOT BETWEEN 0 AND 110) AS ages,
          COUNT(*) FILTER ((care_type IN ('Same-day', 'Emergency', 'Outpatient') AND length_of_stay <> 0)
             OR (care_type = 'Inpatient' AND length_of_stay < 1)) AS stays,
          COUNT(*) FILTER (activity_group_code = 'UNCLASSIFIED') AS unclassified,
          (SELECT COUNT(*) FROM (SELECT encounter_id FROM res GROUP BY 1 HAVING COUNT(DISTINCT service_month) > 1) s) AS several
        FROM enc""",
    [
        ("ENC-UNIQUE", "n = ids", "n - ids", _P, _E),
        ("ENC-SERVICES", "lines = 5", "lines", _P, _E),
        ("ENC-CARE", "cares = 4", "cares", _P, _E),
        ("ENC-MONTHS", f"months = {len(_MONTHS)} AND other_months = 0", "months", _P, _E),
        ("ENC-DATES", "dates = 0", "dates", _P, _E),
        ("ENC-AGE", "ages = 0", "ages", _P, _E),
        ("ENC-CARE-LOS", "stays = 0", "stays", _P, _E),
        ("ENC-UNCLASSIFIED", "unclassified = 1", "unclassified", _X, _E),
        ("ENC-MULTI-MONTH", "several > 0", "several", _P, _E),
    ],
)


@_check_query("k3_encounter_checks", *_ENCOUNTER_CHECKS)
def k3(spark, sf_dir):
    return _seen(
        checks.encounter_checks(
            star.encounters(spark, sf_dir), star.resource_usage(spark, sf_dir), STAR_YEAR
        )
    )


@query(
    "k3_repeated_ledger_keys",
    "SELECT gl_transaction_id, CAST(COUNT(*) AS BIGINT) AS copies FROM gl GROUP BY 1 HAVING COUNT(*) > 1",
)
def k3r(spark, sf_dir):
    return checks.repeated_keys(star.ledger(spark, sf_dir), ["gl_transaction_id"])


@_check_query(
    "k9_resource_checks",
    f"""SELECT COUNT(*) AS n, COUNT(DISTINCT resource_usage_id) AS ids, COUNT(*) FILTER (e.encounter_id IS NULL) AS orphans,
          COUNT(*) FILTER (pathology_weighted_units < 0) AS pathology,
          {" + ".join(f"COUNT(*) FILTER ({m} < 0)" for m in MEASURES if m != "pathology_weighted_units")} AS others,
          SUM(CASE WHEN care_type IN ('Inpatient', 'Same-day') THEN bed_days ELSE 0 END) AS admitted,
          CAST(SUM(CASE WHEN care_type IN ('Emergency', 'Outpatient') THEN bed_days ELSE 0 END) AS BIGINT) AS not_admitted,
          CAST(SUM(CASE WHEN service_line IN {_in(star.PRIORITIES[:2])} THEN theatre_minutes ELSE 0 END) AS DOUBLE) / SUM(theatre_minutes) AS share
        FROM lres r LEFT JOIN penc e ON e.encounter_id = r.encounter_id""",
    [
        ("RES-UNIQUE", "n = ids", "n - ids", _P, _E),
        ("RES-FK", "orphans = 0", "orphans", _P, _E),
        ("RES-NEG-PATH", "pathology = 1", "pathology", _X, _E),
        ("RES-NEG-OTHER", "others = 0", "others", _P, _E),
        ("RES-BED-DAY", "admitted > 0 AND not_admitted = 0", "not_admitted", _P, _E),
        ("RES-THEATRE", "share >= 0.95", "CAST(share AS DECIMAL(9,4))", _P, _W),
    ],
)
def k9(spark, sf_dir):
    """Landed resource rows (with their negative values) against staged encounters."""
    staged = promote.accepted(classified_encounters(spark, sf_dir))
    rows = star.spoiled_resource(spark, sf_dir)
    return _seen(checks.resource_checks(rows, staged, STAR_YEAR))


@_check_query(
    "k14_financial_checks",
    f"""SELECT COUNT(*) AS n, COUNT(DISTINCT gl_transaction_id) AS ids,
          COUNT(*) FILTER (cost_centre_id NOT IN (SELECT cost_centre_id FROM centre)) AS no_centre,
          COUNT(*) FILTER (natural_account NOT IN (SELECT natural_account FROM account)) AS no_account,
          COUNT(*) FILTER (signed_amount < 0) AS negative,
          COUNT(*) FILTER (signed_amount < 0 AND adjustment_type NOT IN ('Credit', 'Reversal')) AS odd,
          COALESCE(SUM(CASE WHEN cost_centre_id = 'CC_11' THEN signed_amount END), 0) AS zero_pool,
          (SELECT COUNT(*) FROM dbad) AS failed,
          (SELECT COUNT(*) FROM (SELECT reporting_month FROM gl GROUP BY 1 HAVING SUM(signed_amount) <> COALESCE(
             (SELECT SUM(p.signed_amount) FROM pgl p WHERE p.reporting_month = gl.reporting_month), 0)) a) AS months,
          (SELECT COUNT(*) FROM (SELECT reporting_month, cost_centre_id, SUM(signed_amount) AS s FROM gl GROUP BY 1, 2) a
             LEFT JOIN (SELECT reporting_month, cost_centre_id, SUM(signed_amount) AS s FROM pgl GROUP BY 1, 2) b
             USING (reporting_month, cost_centre_id) WHERE a.s <> COALESCE(b.s, 0)) AS centres,
          (SELECT COUNT(*) FROM (SELECT service_month, cost_centre_id, natural_account, SUM(amount) AS s FROM dir GROUP BY ALL) a
             LEFT JOIN (SELECT reporting_month AS service_month, cost_centre_id, natural_account, SUM(signed_amount) AS s FROM pgl
                        WHERE starts_with(source_reference, 'DIRECT-CONTROL-') GROUP BY ALL) b
             USING (service_month, cost_centre_id, natural_account) WHERE a.s IS DISTINCT FROM b.s) AS directs
        FROM pgl""",
    [
        ("GL-UNIQUE", "n = ids", "n - ids", _P, _E),
        ("GL-UNKNOWN-CC", "no_centre = 1", "no_centre", _X, _E),
        ("GL-UNKNOWN-ACCOUNT", "no_account = 0", "no_account", _P, _E),
        ("GL-NEGATIVE", "negative > 0 AND odd = 0", "negative", _P, _E),
        ("GL-ZERO-DRIVER", "zero_pool = 45000", "CAST(zero_pool AS DECIMAL(19,2))", _X, _E),
        ("DIR-FAILED", "failed = 1", "failed", _X, _E),
        ("GL-MONTH-CONTROL", "months = 0", "months", _P, _E),
        ("GL-CC-CONTROL", "centres = 0", "centres", _P, _E),
        ("GL-DIRECT-CONTROL", "directs = 0", "directs", _P, _E),
    ],
)
def k14(spark, sf_dir):
    """Staged ledger against control totals taken before rows were rejected."""
    gl = star.ledger(spark, sf_dir)
    staged = promote.accepted(promote.classify(star.ledger_landing(spark, sf_dir), LEDGER))

    def control(*by):
        return pools.ledger_totals(gl, *by).withColumnRenamed(
            "signed_gl_total", "expected_signed_gl_total"
        )

    return _seen(
        checks.financial_checks(
            staged,
            star.direct_items(spark, sf_dir),
            star.encounters(spark, sf_dir),
            star.cost_centres(spark, sf_dir),
            star.account_mapping(spark),
            control("reporting_month"),
            control("reporting_month", "cost_centre_id"),
            STAR_YEAR,
        )
    )


@_check_query(
    "k19_funding_checks",
    """SELECT (SELECT COUNT(*) FROM enc) - (SELECT COUNT(*) FROM penc) AS one_sided,
          COUNT(*) FILTER (funding_status <> 'CALCULATED') AS unfunded,
          COUNT(*) FILTER (funding_status = 'CALCULATED' AND demographic_adjustment_factor NOT BETWEEN 0.85 AND 1.20) AS wrong,
          (SELECT COUNT(*) FROM (SELECT episode_month, COUNT(*) AS c FROM fund GROUP BY 1) a
             LEFT JOIN (SELECT episode_month, COUNT(*) AS c FROM penc GROUP BY 1) b USING (episode_month)
             WHERE a.c <> COALESCE(b.c, 0)) AS months
        FROM fund WHERE encounter_id IN (SELECT encounter_id FROM penc)""",
    [
        ("ABF-POPULATION", "one_sided = 0", "one_sided", _P, _E),
        ("ABF-UNFUNDED", "unfunded = 1", "unfunded", _X, _E),
        ("ABF-CALC", "wrong = 0", "wrong", _P, _E),
        ("ABF-PRICE", "TRUE", "'10750.00'", _P, _E),
        ("ABF-MONTH-CONTROL", "months = 0", "months", _P, _E),
        ("ABF-GROUPS", "TRUE", "0", _P, _E),
    ],
)
def k19(spark, sf_dir):
    """Funding of staged encounters against the landed population and its control."""
    everybody = star.encounters(spark, sf_dir)
    groups = star.funding_groups(spark)
    staged = promote.accepted(classified_encounters(spark, sf_dir))
    control = funding.monthly_funding_control(funding.encounter_funding(everybody, groups))
    return _seen(
        checks.funding_checks(
            funding.encounter_funding(staged, groups), everybody, groups, control, STAR_YEAR
        )
    )


@_check_query(
    "k20_plausibility_checks",
    """SELECT (SELECT COUNT(*) FROM enc) AS n,
          (SELECT COUNT(*) FROM (SELECT COUNT(*) AS c FROM enc GROUP BY service_line) s
             WHERE c < greatest(100, 0.02 * (SELECT COUNT(*) FROM enc))) AS small,
          (SELECT MIN(c) FROM (SELECT COUNT(*) AS c FROM enc GROUP BY episode_month) s) AS least,
          (SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM enc GROUP BY episode_month) s) AS most,
          CAST((SELECT SUM(estimated_synthetic_funding) FROM fund) AS DOUBLE) / CAST(SUM(signed_amount) AS DOUBLE) AS ratio
        FROM gl""",
    [
        ("PLAUS-VOLUME", "n BETWEEN 5000 AND 10000", "n", _P, _W),
        ("PLAUS-SERVICE-MIX", "small = 0", "small", _P, _W),
        ("PLAUS-MONTH-VOLUME", "most <= least * 1.5", "least || '-' || most", _P, _W),
        ("PLAUS-COST-FUNDING", "ratio BETWEEN 0.8 AND 1.2", "CAST(ratio AS DECIMAL(9,4))", _P, _W),
    ],
)
def k20(spark, sf_dir):
    return _seen(
        checks.plausibility_checks(
            star.encounters(spark, sf_dir),
            star.ledger(spark, sf_dir),
            _encounter_funding(spark, sf_dir),
            STAR_YEAR,
        )
    )


@query(
    "k1_table_checks",
    """SELECT 'FILE-orders' AS check_id, 'PASS' AS status, CAST(COUNT(*) AS VARCHAR) AS observed FROM orders
       UNION ALL SELECT 'FILE-lineitem', 'ERROR', 'l_facility'
       UNION ALL SELECT 'FILE-supplier', 'PASS', CAST(COUNT(*) AS VARCHAR) FROM supplier""",
)
def k1(spark, sf_dir):
    names = ("orders", "lineitem", "supplier")
    return _seen(
        checks.table_checks(
            {name: star.table(spark, sf_dir, name) for name in names},
            {
                "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
                "lineitem": ["l_orderkey", "l_facility"],
                "supplier": ["s_suppkey"],
            },
        )
    )


@query(
    "k22_overall_status",
    """SELECT CAST(9 AS BIGINT) AS check_count, CASE WHEN n <> ids OR dates > 0 OR stays > 0 OR unclassified <> 1
              THEN 'FAIL' ELSE 'PASS' END AS overall_status
       FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT encounter_id) AS ids, COUNT(*) FILTER (discharge_date < admission_date) AS dates,
                    COUNT(*) FILTER (care_type = 'Inpatient' AND length_of_stay < 1) AS stays,
                    COUNT(*) FILTER (activity_group_code = 'UNCLASSIFIED') AS unclassified FROM enc) t""",
)
def k22(spark, sf_dir):
    """Status counts and verdict over a report that was written and read back."""
    path = scratch_path(spark, "checks")
    report = checks.encounter_checks(
        star.encounters(spark, sf_dir), star.resource_usage(spark, sf_dir), STAR_YEAR
    )
    tables.write_check_report(report, path)
    return checks.overall_status(spark.read.schema(report.schema).json(path))


@query(
    "k22_status_counts",
    f"SELECT status, CAST(COUNT(*) AS BIGINT) AS check_count FROM ({_checks_twin(*_ENCOUNTER_CHECKS)}) t GROUP BY 1",
)
def k22s(spark, sf_dir):
    report = checks.encounter_checks(
        star.encounters(spark, sf_dir), star.resource_usage(spark, sf_dir), STAR_YEAR
    )
    return checks.status_counts(report)


@query(
    "g1_ordered_pool_summary",
    f"""SELECT load_run_id, pool_status, CAST(COUNT(*) AS BIGINT) AS pool_count,
               {shown('SUM(source_gl_amount)')} AS source_gl_amount
        FROM pool GROUP BY ALL ORDER BY load_run_id, pool_status""",
)
def g1(spark, sf_dir):
    summary = summaries.ordered(pools.pool_summary(costing_run(spark, sf_dir).pools), RUN, "pool_status")
    return show(summary)


@query(
    "b11_blank_optional_fields",
    """SELECT CAST(COUNT(*) AS BIGINT) AS row_count,
              CAST(COUNT(NULLIF(regexp_replace(o_orderpriority, '^[0-9]-(NOT SPECIFIED)?', ''), '')) AS BIGINT) AS stated_count
       FROM orders""",
)
def b11(spark, sf_dir):
    """The priority as an optional description: what is not specified is blank, then missing."""
    stated = F.regexp_replace("o_orderpriority", "^[0-9]-(NOT SPECIFIED)?", "")
    orders = star.table(spark, sf_dir, "orders").select(blank_to_null(stated).alias("description"))
    return orders.agg(
        F.count(F.lit(1)).alias("row_count"), F.count("description").alias("stated_count")
    )


@query(
    "m4_overlapping_periods",
    f"""SELECT encounter_id AS allocation_rule_id, patient_id AS cost_pool_code, {d('admission_date')} AS effective_from,
               {d('discharge_date')} AS effective_to
        FROM (SELECT *, MAX(discharge_date) OVER (PARTITION BY patient_id ORDER BY admission_date, encounter_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM enc) t
        WHERE admission_date <= earlier""",
)
def m4(spark, sf_dir):
    """Stays as effective-dated rules of their patient: overlapping stays are found."""
    rules = star.encounters(spark, sf_dir).select(
        F.col("encounter_id").alias("allocation_rule_id"),
        F.col("patient_id").alias("cost_pool_code"),
        F.lit("Stay").alias("cost_category"),
        F.lit("All").alias("eligible_scope"),
        F.col("admission_date").alias("effective_from"),
        F.col("discharge_date").alias("effective_to"),
        F.lit("Y").alias("active_flag"),
    )
    return show(
        mapped.overlapping_rules(rules),
        "allocation_rule_id",
        "cost_pool_code",
        "effective_from",
        "effective_to",
    )


_CONTESTED_FROM, _CONTESTED_TO = "1995-03-01", "1996-02-29"


@query(
    "m4_contested_pools",
    f"""SELECT CASE WHEN contested AND pool_status <> 'REVIEW' THEN 'REVIEW' ELSE pool_status END AS pool_status,
               contested, CAST(COUNT(*) AS BIGINT) AS pool_count, {shown('SUM(source_gl_amount)')} AS source_gl_amount,
               {shown('(SELECT SUM(signed_amount) FROM gl)')} AS ledger_amount
        FROM (SELECT *, EXISTS (
                  SELECT 1 FROM rule r WHERE r.cost_pool_code = pool.cost_pool_code AND r.cost_category = pool.cost_category
                      AND pool.reporting_month BETWEEN r.effective_from AND r.effective_to
                      AND pool.reporting_month BETWEEN DATE '{_CONTESTED_FROM}' AND DATE '{_CONTESTED_TO}'
                      AND r.cost_category = 'Nursing') AS contested FROM pool) t GROUP BY 1, 2""",
)
def m4c(spark, sf_dir):
    """A second version of every nursing rule for a year: its pools wait for review, all others are costed."""
    rules = star.allocation_rules(spark)
    second = rules.filter("cost_category = 'Nursing'").withColumns(
        {
            "allocation_driver": F.lit("encounter_count"),
            "effective_from": F.lit(_CONTESTED_FROM).cast("date"),
            "effective_to": F.lit(_CONTESTED_TO).cast("date"),
        }
    )
    governed = mapped.governed(star.cost_centres(spark, sf_dir), star.account_mapping(spark), rules.unionByName(second))
    ledger = star.ledger(spark, sf_dir)
    found = pools.cost_pools(ledger, governed).withColumn(
        "contested", F.coalesce(F.col("review_note") == K.NOTE_CONTESTED_RULE, F.lit(False))
    )
    total = ledger.agg(F.sum("signed_amount").cast(TOTAL).alias("ledger_amount"))
    summary = found.groupBy("pool_status", "contested").agg(
        F.count(F.lit(1)).alias("pool_count"), F.sum("source_gl_amount").cast(TOTAL).alias("source_gl_amount")
    )
    return show(summary.join(F.broadcast(total)))  # one row


@query(
    "m3_implausible_resources",
    " UNION ALL ".join(
        f"""SELECT resource_usage_id, {q(m)} AS measure, CAST({m} AS BIGINT) AS value, CAST({upper} AS BIGINT) AS upper_limit,
            {q(severity)} AS severity, CASE WHEN {m} < 0 THEN 'Y' ELSE 'N' END AS blocking_flag
            FROM lres WHERE {m} < 0 OR {m} > {upper}"""
        for m, (upper, severity) in K.PLAUSIBLE_RANGES.items()
    ),
)
def m3(spark, sf_dir):
    rows = star.spoiled_resource(spark, sf_dir)
    return show(
        checks.implausible_resources(rows),
        "resource_usage_id",
        "measure",
        "value",
        "upper_limit",
        "severity",
        "blocking_flag",
    )


# --- variance, materiality, readiness, management summaries -------------------------------------


@query(
    "m1_monthly_variance",
    f"""SELECT service_line, {d('reporting_month')} AS reporting_month, {shown('c')} AS total_cost, {n('e')} AS encounter_count,
               {shown('c - pc')} AS cost_change, {ratio('(c - pc)', 'pc', 4)} AS cost_change_share, CAST(e - pe AS VARCHAR) AS count_change,
               CASE WHEN ABS(c - pc) >= 100000 AND ABS(CAST(c - pc AS DOUBLE) / CAST(NULLIF(pc, 0) AS DOUBLE)) >= 0.10 THEN 'Y' ELSE 'N' END AS material_flag
        FROM (SELECT *, CASE WHEN lag(reporting_month) OVER w = CAST(reporting_month - INTERVAL 1 MONTH AS DATE) THEN lag(c) OVER w END AS pc,
                     CASE WHEN lag(reporting_month) OVER w = CAST(reporting_month - INTERVAL 1 MONTH AS DATE) THEN lag(e) OVER w END AS pe
              FROM (SELECT service_line, reporting_month, SUM(total_patient_cost) AS c, COUNT(*) AS e FROM cost GROUP BY ALL) g
              WINDOW w AS (PARTITION BY service_line ORDER BY reporting_month)) t""",
)
def m1(spark, sf_dir):
    return show(
        variance.monthly_variance(costing_run(spark, sf_dir).costs, ["service_line"]),
        "service_line",
        "reporting_month",
        "total_cost",
        "encounter_count",
        "cost_change",
        "cost_change_share",
        "count_change",
        "material_flag",
        cost_change_share=4,
    )


@query(
    "m2_unallocated_materiality",
    f"""SELECT {d('reporting_month')} AS reporting_month, unallocated_reason, {shown('u')} AS unallocated_amount,
               {ratio('u', 'g', 6)} AS ledger_share,
               CASE greatest(CASE WHEN ABS(u) >= 100000 THEN 3 WHEN ABS(u) >= 10000 THEN 2 WHEN ABS(u) >= 1000 THEN 1 ELSE 0 END,
                             CASE WHEN ABS(CAST(u AS DOUBLE) / CAST(g AS DOUBLE)) >= 0.01 THEN 3 WHEN ABS(CAST(u AS DOUBLE) / CAST(g AS DOUBLE)) >= 0.001 THEN 2
                                  WHEN ABS(CAST(u AS DOUBLE) / CAST(g AS DOUBLE)) >= 0.0001 THEN 1 ELSE 0 END)
                 WHEN 3 THEN 'Critical' WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS materiality
        FROM (SELECT reporting_month, unallocated_reason, SUM(unallocated_amount) AS u FROM una GROUP BY ALL) a
        LEFT JOIN (SELECT reporting_month, SUM(signed_amount) AS g FROM gl GROUP BY ALL) b USING (reporting_month)""",
)
def m2(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    monthly = pools.ledger_totals(run.ledger, RUN, "reporting_month")
    return show(
        variance.unallocated_materiality(run.unallocated, monthly),
        "reporting_month",
        "unallocated_reason",
        "unallocated_amount",
        "ledger_share",
        "materiality",
        ledger_share=6,
    )


@query(
    "m6_readiness",
    f"""SELECT load_run_id, total_status, blocking_failures, failed_controls,
              CASE WHEN blocking_failures = 0 AND failed_controls = 0 AND total_status = 'PASS' THEN 'Y' ELSE 'N' END AS publish_flag
        FROM (SELECT CAST(1 AS BIGINT) AS load_run_id, total.reconciliation_status AS total_status,
                     (SELECT CAST(COUNT(*) AS BIGINT) FROM (VALUES {_RULE_VALUES}) AS t({", ".join(K.RULE_COLUMNS)})
                      LEFT JOIN ({_RESULTS}) v USING (validation_rule_id)
                      WHERE blocking_flag = 'Y' AND active_flag = 'Y' AND validation_status IS DISTINCT FROM 'PASS') AS blocking_failures,
                     (SELECT CAST(COUNT(*) AS BIGINT) FROM {_CONTROLS} WHERE e IS DISTINCT FROM a) AS failed_controls
              FROM total) r""",
)
def m6(spark, sf_dir):
    run = costing_run(spark, sf_dir)
    results, _ = _register(spark, sf_dir)
    controls = _file_controls(spark, sf_dir).withColumn(RUN, F.lit(star.THE_RUN).cast("long"))
    return show(
        checks.readiness(
            results, quality.rule_catalogue(spark), controls, run.reconciliation
        )
    )


@query(
    "m7_service_line_composition",
    f"""SELECT load_run_id, service_line, CAST(COUNT(*) AS BIGINT) AS encounter_count,
               {", ".join(f"{shown(f'SUM({c})')} AS {c}" for c in _PARTS)},
               {", ".join(f"{ratio(f'SUM({c})', 'SUM(total_patient_cost)', 6)} AS {c.replace('amount', 'share')}" for c in _PARTS[:3])}
        FROM cost GROUP BY ALL""",
)
def m7(spark, sf_dir):
    return show(
        reporting.service_line_composition(costing_run(spark, sf_dir).costs),
        **{c.replace("amount", "share"): 6 for c in _PARTS[:3]},
    )


@query(
    "m7_activity_group_summary",
    f"""SELECT load_run_id, activity_group_code, {shown('SUM(total_patient_cost)')} AS total_patient_cost,
               CAST(COUNT(*) AS BIGINT) AS encounter_count,
               ROUND(CAST(SUM(total_patient_cost) AS DOUBLE) / COUNT(*), 2) AS average_cost FROM cost GROUP BY ALL""",
)
def m7a(spark, sf_dir):
    return show(reporting.activity_group_summary(costing_run(spark, sf_dir).costs))


@query(
    "m7_high_cost_by_group",
    f"""SELECT load_run_id, care_type, activity_group_code, CAST(COUNT(*) AS BIGINT) AS encounter_count,
               CAST(COUNT(*) FILTER (high_cost_flag = 'Y') AS BIGINT) AS high_cost_count,
               {shown("COALESCE(SUM(CASE WHEN high_cost_flag = 'Y' THEN total_patient_cost END), 0)")} AS high_cost_amount
        FROM flagged GROUP BY ALL""",
)
def m7h(spark, sf_dir):
    return show(reporting.high_cost_by_group(costing_run(spark, sf_dir).flagged))
