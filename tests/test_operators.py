"""Operators on their own, against brute force or hand-computed values."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from costweave import constants as K
from costweave.functions.columns import (
    blank_to_null,
    clean_text,
    describe,
    first_of,
    inline,
    safe_cast,
    safe_ratio,
)
from costweave.operators import (
    allocate,
    checks,
    drivers,
    funding,
    mapping,
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
from costweave.schemas import ENCOUNTER, RUN
from costweave.session import fits_broadcast, lookup_join, stage
from costweave.sources import landing, reference, tables

FIRST, LAST = date(2024, 1, 1), date(2024, 12, 31)

ENCOUNTERS = (
    "load_run_id long, encounter_id string, care_type string, service_line string, "
    "episode_month date, admission_date date, discharge_date date"
)


def values(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_column_helpers(spark):
    df = inline(spark, [("  ab c ", "12", "", 6, 0), (None, "1x", "z", 6, 3)], "t string, n string, b string, x long, y long")
    out = df.select(
        clean_text("t", 2),
        safe_cast("n", "int"),
        blank_to_null("b"),
        first_of("t", F.lit("default")),
        safe_ratio("x", "y"),
        describe(t="t", n="n"),
    )
    assert [tuple(r) for r in out.collect()] == [
        ("ab", 12, None, "  ab c ", None, "t=  ab c ; n=12"),
        (None, None, "z", "default", 2.0, "t=; n=1x"),
    ]


# --- mapping ---------------------------------------------------------------------


def references(spark, centres=None, rules=None):
    return mapping.governed(
        inline(
            spark,
            centres
            or [
                ("C1", "WARD_NURSING", "Y", date(2024, 1, 1), date(2024, 6, 30)),
                ("C1", "THEATRE", "Y", date(2024, 7, 1), date(2024, 12, 31)),
                ("C1", "IMAGING", "N", date(2024, 1, 1), date(2024, 12, 31)),
            ],
            "cost_centre_id string, cost_pool_code string, active_flag string, effective_from date, effective_to date",
        ),
        inline(
            spark,
            [("A", "Nursing", "Indirect", "bed_days", "Y")],
            "natural_account string, cost_category string, costing_treatment string, default_driver string, active_flag string",
        ),
        inline(
            spark,
            rules or [("THEATRE", "Nursing", "theatre_minutes", date(2024, 8, 1), date(2024, 12, 31), "Y")],
            "cost_pool_code string, cost_category string, allocation_driver string, effective_from date, effective_to date, active_flag string",
        ),
    )


LEDGER = "load_run_id long, reporting_month date, facility string, cost_centre_id string, natural_account string, signed_amount decimal(19,6)"


def test_effective_dates_choose_the_version(spark):
    gl = inline(
        spark,
        [(1, date(2024, m, 1), "F", "C1", "A", Decimal(m)) for m in (1, 6, 7, 8, 12)]
        + [(1, date(2025, 1, 1), "F", "C1", "A", Decimal(13))],
        LEDGER,
    )
    found = values(
        pools.cost_pools(gl, references(spark)),
        "reporting_month",
        "cost_pool_code",
        "allocation_driver",
        "pool_status",
    )
    assert sorted(found) == [
        (date(2024, 1, 1), "WARD_NURSING", "bed_days", "READY"),
        (date(2024, 6, 1), "WARD_NURSING", "bed_days", "READY"),
        (date(2024, 7, 1), "THEATRE", "bed_days", "READY"),
        (date(2024, 8, 1), "THEATRE", "theatre_minutes", "READY"),
        (date(2024, 12, 1), "THEATRE", "theatre_minutes", "READY"),
        (date(2025, 1, 1), "UNMAPPED", "bed_days", "REVIEW"),
    ]


def test_overlapping_rules_are_reported(spark):
    rules = inline(
        spark,
        [
            ("R1", "P", "C", "All", date(2024, 1, 1), date(2024, 6, 30), "Y"),
            ("R2", "P", "C", "All", date(2024, 6, 1), date(2024, 12, 31), "Y"),
            ("R3", "P", "C", "All", date(2025, 1, 1), date(2025, 12, 31), "Y"),
            ("R4", "P", "C", "All", date(2024, 1, 1), date(2025, 12, 31), "N"),
            ("R5", "Q", "C", "All", date(2024, 1, 1), date(2024, 6, 30), "Y"),
            ("R6", "Q", "C", "Other", date(2024, 6, 1), date(2024, 7, 31), "Y"),
            ("R7", "Q", "D", "All", date(2024, 6, 1), date(2024, 7, 31), "Y"),
        ],
        "allocation_rule_id string, cost_pool_code string, cost_category string, eligible_scope string, effective_from date, effective_to date, active_flag string",
    )
    # a scope does not keep rules apart: the ledger meets both
    assert values(mapping.overlapping_rules(rules), "allocation_rule_id") == [("R2",), ("R6",)]


def test_segments_follow_the_versions(spark):
    """Every day of every version lies in one segment; days that two versions claim are contested."""
    rng = random.Random(4)
    day = date(2024, 1, 1)
    rows = []
    for key in range(12):
        for i in range(rng.randint(1, 5)):
            start = rng.randint(0, 60)
            rows.append((f"P{key}", f"D{key}-{i}", day + timedelta(start), day + timedelta(start + rng.randint(-1, 30))))
    rows += [rows[0], rows[0][:2] + (None, day), ("P0", "open", day, None)]
    versions = inline(spark, rows, "k string, v string, effective_from date, effective_to date")
    found = mapping.segments(versions, ["k"]).collect()
    for key in range(12):
        for i in range(-2, 100):
            at = day + timedelta(i)
            there = [r[1] for r in rows if r[0] == f"P{key}" and r[2] and r[3] and r[2] <= at <= r[3]]
            hit = [s for s in found if s.k == f"P{key}" and s.effective_from <= at <= s.effective_to]
            assert len(hit) == (1 if there else 0)
            if there:
                assert hit[0].contested == (len(there) > 1)
                assert hit[0].v == (there[0] if len(there) == 1 else None)


def test_contested_rules_block_their_pool_and_no_other(spark):
    centres = inline(
        spark,
        [("W1", "P", FIRST, LAST), ("W2", "Q", FIRST, LAST), ("W3", "P", FIRST, date(2024, 6, 30)), ("W3", "Q", date(2024, 6, 1), LAST)],
        "cost_centre_id string, cost_pool_code string, effective_from date, effective_to date",
    ).withColumn("active_flag", F.lit("Y"))
    accounts = inline(spark, [("A", "C", "Indirect", "bed_days", "Y")],
                      "natural_account string, cost_category string, costing_treatment string, default_driver string, active_flag string")
    rules = inline(
        spark,
        [("P", "C", "bed_days", FIRST, date(2024, 6, 30)), ("P", "C", "encounter_count", date(2024, 6, 1), LAST), ("Q", "C", "bed_days", FIRST, LAST)],
        "cost_pool_code string, cost_category string, allocation_driver string, effective_from date, effective_to date",
    ).withColumn("active_flag", F.lit("Y"))
    months = [date(2024, 5, 1), date(2024, 6, 1), date(2024, 7, 1)]
    ledger = inline(spark, [(1, m, "Main", w, "A", Decimal(100)) for m in months for w in ("W1", "W2", "W3")],
                    "load_run_id long, reporting_month date, facility string, cost_centre_id string, natural_account string, signed_amount decimal(19,6)")
    found = pools.cost_pools(ledger, mapping.governed(centres, accounts, rules))
    assert found.agg(F.sum("source_gl_amount")).first()[0] == 900 and found.count() == 9
    status = {(r.cost_centre_id, r.reporting_month.month): (r.cost_pool_code, r.pool_status, r.allocation_driver) for r in found.collect()}
    assert status["W1", 5] == ("P", "READY", "bed_days") and status["W1", 7] == ("P", "READY", "encounter_count")
    assert status["W1", 6][:2] == ("P", "REVIEW")
    assert {status["W2", m] for m in (5, 6, 7)} == {("Q", "READY", "bed_days")}
    assert status["W3", 6][:2] == ("UNMAPPED", "REVIEW") and status["W3", 7][0] == "Q"
    notes = {r.review_note for r in found.filter("pool_status = 'REVIEW'").collect()}
    assert notes == {K.NOTE_CONTESTED_RULE, K.NOTE_CONTESTED_CENTRE}
    reasons = unallocated.review_pools(found).select("unallocated_reason", "unallocated_amount").collect()
    assert [tuple(r) for r in reasons] == [("REVIEW", 100), ("REVIEW", 100)]


# --- allocation -------------------------------------------------------------------

POOLS = (
    "load_run_id long, reporting_month date, facility string, cost_centre_id string, natural_account string, "
    "cost_pool_code string, cost_category string, costing_treatment string, allocation_driver string, "
    "pool_status string, review_note string, source_transaction_count long, source_gl_amount decimal(19,6)"
)
DRIVERS = "load_run_id long, reporting_month date, encounter_id string, cost_pool_code string, allocation_driver string, driver_units decimal(19,6), driver_status string, review_note string"
JAN = date(2025, 1, 1)


def pool(centre, amount, code="WARD_NURSING", driver="bed_days", status="READY", treatment="Indirect", facility="F"):
    return (1, JAN, facility, centre, "A", code, "Nursing", treatment, driver, status, None, 1, Decimal(amount))


def allocation_case(spark):
    ps = [pool("C1", "1000"), pool("C2", "-333.33"), pool("C3", "77.777777"), pool("C4", "5", status="REVIEW"), pool("C5", "9", treatment="Direct"), pool("C6", "50", "PHARMACY", "pharmacy_units")]
    # one encounter brings a third of all units, and 200 rows of them
    ds = [(1, JAN, "HOT", "WARD_NURSING", "bed_days", Decimal(2), "VALID", None)] * 200
    ds += [(1, JAN, f"E{i}", "WARD_NURSING", "bed_days", Decimal(i % 7), "VALID" if i % 7 else "EXCLUDED", None) for i in range(300)]
    return inline(spark, ps, POOLS), inline(spark, ds, DRIVERS), ps, ds


def test_allocation_matches_brute_force(spark):
    pools_df, drivers_df, ps, ds = allocation_case(spark)
    rates = stage(allocate.pool_rates(pools_df, drivers.driver_totals(drivers_df), "Indirect"), "r")
    total = sum(d[5] for d in ds if d[6] == "VALID")
    money = sum(p[12] for p in ps if p[5] == "WARD_NURSING" and p[9] == "READY" and p[7] == "Indirect")
    expected = defaultdict(Decimal)
    for d in ds:
        if d[6] == "VALID":
            expected[d[2]] += d[5] * money / total
    detail = allocate.allocate(rates, drivers_df)
    assert detail.count() == 3 * sum(d[6] == "VALID" for d in ds)
    summed = allocate.allocate_units(stage(allocate.driver_rates(rates), "k"), drivers_df)
    for df in (detail, summed):
        found = dict(values(df.groupBy("encounter_id").agg(F.sum("allocated_amount")), "*"))
        assert found.keys() == expected.keys()
        assert all(abs(found[e] - expected[e]) < Decimal("0.001") for e in expected)
    by_pool = dict(values(allocate.allocated_by_pool(rates, summed), "cost_centre_id", "allocated_amount"))
    assert by_pool.keys() == {"C1", "C2", "C3"}
    assert all(abs(by_pool[p[3]] - p[12]) < Decimal("0.00001") for p in ps[:3])


def test_lost_allocation_rows_show_in_the_pool(spark):
    pools_df, drivers_df, *_ = allocation_case(spark)
    rates = allocate.pool_rates(pools_df, drivers.driver_totals(drivers_df), "Indirect")
    summed = allocate.allocate_units(allocate.driver_rates(rates), drivers_df)
    lost = summed.filter("encounter_id <> 'HOT'")
    found = dict(values(allocate.allocated_by_pool(rates, lost), "cost_centre_id", "allocated_amount"))
    assert found["C1"] < Decimal("900")


def test_salted_join_equals_broadcast_join(spark):
    pools_df, drivers_df, *_ = allocation_case(spark)
    keys = drivers.DRIVER_KEY
    small = pools_df.select(*keys, "source_gl_amount")
    assert not fits_broadcast(small, 2)
    broadcast = lookup_join(drivers_df, small, keys, "encounter_id")
    salted = lookup_join(drivers_df, small, keys, "encounter_id", max_rows=2, salts=8)
    plan = salted._jdf.queryExecution().toString()
    assert "_salt" in plan
    assert values(broadcast.select(*sorted(broadcast.columns))) == values(salted.select(*sorted(broadcast.columns)))


def test_wide_indirect_equals_driver_rows(spark):
    encounters = inline(
        spark,
        [(1, "A", "Inpatient", "Medical", JAN, JAN, JAN), (1, "B", "Emergency", "Emergency", JAN, JAN, JAN)],
        ENCOUNTERS,
    )
    measures = list(K.MEASURE_POOLS)
    resource = inline(
        spark,
        [(1, "A", JAN, *range(7)), (1, "A", JAN, *range(7)), (1, "B", JAN, *[0] * 7), (1, "B", date(2025, 2, 1), *[3] * 7)],
        "load_run_id long, encounter_id string, service_month date, " + ", ".join(f"{m} int" for m in measures),
    )
    ps = [pool(f"C{i}", str(100 + i / 7)[:8], code, driver) for i, (driver, code) in enumerate(K.MEASURE_POOLS.items())]
    ps += [pool(f"N{i}", "10", code, "encounter_count") for i, code in enumerate(K.COUNT_POOLS)]
    rows = drivers.encounter_drivers(resource, encounters)
    totals = drivers.driver_totals(rows)
    assert values(drivers.source_driver_totals(resource, encounters).select(*totals.columns)) == values(totals)
    rates = allocate.driver_rates(allocate.pool_rates(inline(spark, ps, POOLS), totals, "Indirect"))
    long = allocate.by_encounter_month(allocate.allocate_units(rates, rows), "allocated_amount")
    wide = allocate.indirect_by_encounter(stage(allocate.rates_by_month(rates), "m"), resource, encounters)
    assert values(wide.select(*long.columns)) == values(long)


def test_facility_keys_keep_facilities_apart(spark):
    ps = inline(spark, [pool("C1", "100"), pool("C1", "300", facility="G")], POOLS)
    ds = inline(
        spark,
        [(1, JAN, "A", "WARD_NURSING", "bed_days", Decimal(1), "VALID", None), (1, JAN, "B", "WARD_NURSING", "bed_days", Decimal(1), "VALID", None)],
        DRIVERS,
    ).withColumn("facility", F.when(F.col("encounter_id") == "A", "F").otherwise("G"))

    def cost(keys):
        rates = allocate.pool_rates(ps, drivers.driver_totals(ds, keys), "Indirect", keys)
        return dict(values(allocate.allocate_units(allocate.driver_rates(rates, keys), ds, keys), "encounter_id", "allocated_amount"))

    assert cost(drivers.DRIVER_KEY) == {"A": 200, "B": 200}
    assert cost([*drivers.DRIVER_KEY, "facility"]) == {"A": 100, "B": 300}
    assert recon.shared_direct_keys(ps).count() == 1


def test_scope_limits_drivers(spark):
    encounters = inline(
        spark,
        [(1, "A", "Inpatient", "Medical", JAN, JAN, JAN), (1, "B", "Emergency", "Emergency", JAN, JAN, JAN)],
        ENCOUNTERS,
    )
    ds = inline(spark, [(1, JAN, e, p, d, Decimal(1), "VALID", None) for e in "AB" for p, d in (("W", "x"), ("Z", "y"), ("N", "z"))], DRIVERS)
    rules = inline(
        spark,
        [("W", "x", "Inpatient|Same-day", "Y"), ("Z", "y", "All", "Y")],
        "cost_pool_code string, allocation_driver string, eligible_scope string, active_flag string",
    )
    kept = values(drivers.within_scope(ds, encounters, rules), "cost_pool_code", "encounter_id")
    assert kept == [("N", "A"), ("N", "B"), ("W", "A"), ("Z", "A"), ("Z", "B")]
    # an expired rule neither admits nor keeps out
    dated = rules.withColumns({"effective_from": F.lit(date(2020, 1, 1)), "effective_to": F.when(F.col("cost_pool_code") == "W", F.lit(date(2020, 6, 30))).otherwise(F.lit(date(2999, 1, 1)))})
    kept = values(drivers.within_scope(ds, encounters, dated), "cost_pool_code", "encounter_id")
    assert kept == [("N", "A"), ("N", "B"), ("W", "A"), ("W", "B"), ("Z", "A"), ("Z", "B")]


def test_overhead_without_denominator_is_optional(spark):
    ps = inline(spark, [pool("C1", "10", "OVERHEAD", "pre_overhead_cost", treatment="Overhead"), pool("C2", "5")], POOLS)
    none = inline(spark, [], DRIVERS + ", total_driver_units decimal(29,6)")
    assert values(unallocated.zero_driver_pools(ps, none), "cost_centre_id") == [("C2",)]
    both = unallocated.zero_driver_pools(ps, none, treatments=("Indirect", "Overhead"))
    assert values(both, "cost_centre_id") == [("C1",), ("C2",)]


# --- percentiles --------------------------------------------------------------------


def interpolated(numbers, p):
    ordered = sorted(numbers)
    at = (len(ordered) - 1) * p
    low = int(at)
    high = min(low + 1, len(ordered) - 1) if at > low else low
    return float(ordered[low]) + (float(ordered[high]) - float(ordered[low])) * (at - low)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_bracketed_percentile_is_exact(spark, p):
    groups = {
        "spread": [Decimal(i * i % 99991) / 7 for i in range(30000)],
        "ties": [Decimal(0)] * 20000 + [Decimal(i) for i in range(10000)],
        "tiny": [Decimal(1), Decimal(2), Decimal(4)],
        "same": [Decimal(5)] * 50,
    }
    rows = [(g, v.quantize(Decimal("0.000001"))) for g, vs in groups.items() for v in vs]
    df = stage(inline(spark, rows, "g string, v decimal(19,6)"), "values")
    found = {r.g: r for r in percentiles.group_percentile(df, ["g"], "v", p, "q").collect()}
    coarse = {r.g: r.q for r in percentiles.group_percentile(df, ["g"], "v", p, "q", accuracy=10).collect()}
    for g, vs in groups.items():
        exact = interpolated([v.quantize(Decimal("0.000001")) for v in vs], p)
        assert found[g].cohort_count == len(vs)
        assert found[g].q == pytest.approx(exact, abs=1e-9)
        assert coarse[g] == pytest.approx(exact, abs=1e-9)


def test_one_cohort_is_ranked_in_many_tasks(spark):
    """All rows in one group: what lies inside the bracket is dealt out by value."""
    df = stage(spark.range(40_000).select(F.lit("all").alias("g"), F.expr("(id * 7919) % 40000").alias("v")), "values")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # a coarse sketch leaves most rows inside
        placed = percentiles._placed(df.withColumnRenamed("v", "value"), ["g"], [("q", 0.5)], 0.4, 10)
        sizes = [r["count"] for r in placed.where("value IS NOT NULL").groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * min(sizes)
    several = percentiles.group_percentiles(df, ["g"], "v", {"p95": 0.95, "low": 0.01, "median": 0.5}).first()
    assert several.cohort_count == 40_000
    assert (several.low, several.median, several.p95) == pytest.approx((399.99, 19999.5, 37999.05), abs=1e-6)


def test_percentile_of_null_groups_and_values(spark):
    df = inline(spark, [(None, 1), (None, 3), ("a", None), ("b", 2), ("b", None)], "g string, v int")
    found = percentiles.group_percentile(df, ["g"], "v", 0.5, "q").collect()
    assert sorted(map(tuple, found), key=str) == [("b", 1, 2.0), (None, 2, 2.0)]


def test_numeric_summary_and_frequencies(spark):
    df = inline(spark, [(1,), (2,), (4,), (-7,), (None,)], "x int")
    row = summaries.numeric_summary(df, ["x"], non_negative_only=True).first()
    assert tuple(row) == ("x", 3, 1.0, 2.333, 2.0, 3.8, 4.0)
    shares = values(summaries.frequencies(inline(spark, [("a",), ("a",), ("b",), (None,)], "v string"), "v"), "value", "n", "share")
    assert shares == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]


# --- landing and tables ----------------------------------------------------------------


def test_line_numbers_across_file_blocks(spark, tmp_path):
    path = tmp_path / "patient_encounter.csv"
    columns = ENCOUNTER.columns
    lines = [",".join([f"E{i:05d}"] + ["x"] * (len(columns) - 1)) for i in range(5000)]
    path.write_text("\n".join([",".join(columns), *lines]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = landing.read_landing_csv(spark, str(path), ENCOUNTER)
        assert scan.select("_block").distinct().count() > 5
        rows = landing.add_lineage(scan, 7).select("source_row_number", "encounter_id", RUN, "source_file_name").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {(r[0], r[1]) for r in rows} == {(i + 2, f"E{i:05d}") for i in range(5000)}
    assert {(r[2], r[3]) for r in rows} == {(7, "patient_encounter.csv")}


def test_replacing_a_run_with_nothing_clears_it(spark, tmp_path):
    path = str(tmp_path / "t")
    df = inline(spark, [(1, "a"), (2, "b")], "load_run_id long, v string")
    for run in (1, 2):
        tables.replace_run(df.filter(F.col("load_run_id") == run), path, run)
    tables.replace_run(df.filter("v = 'none'"), path, 1)
    assert values(spark.read.schema(df.schema).parquet(path), "v") == [("b",)]


def test_replacing_a_slice_refuses_foreign_rows_and_escapes_its_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = inline(spark, [(1, "a/b:c%", "x"), (2, "a/b:c%", "y")], "load_run_id long, rule string, v string")
    with pytest.raises(ValueError, match="1 rows do not belong"):
        tables.replace_slice(df, path, {"load_run_id": 1, "rule": "a/b:c%"})
    tables.replace_slice(df.filter("v = 'x'"), path, {"load_run_id": 1, "rule": "a/b:c%"})
    assert values(spark.read.schema(df.schema).parquet(path)) == [(1, "a/b:c%", "x")] or values(
        spark.read.parquet(path), "rule", "v"
    ) == [("a/b:c%", "x")]


def _slice_of(spark, path):
    table = spark.read.schema("load_run_id long, rule string, v string").parquet(path)
    return values(table, "load_run_id", "rule", "v")


@pytest.fixture
def slices(spark, tmp_path):
    """Two slices: run 1 with rules a (10, 20) and b (30)."""
    path = str(tmp_path / "t")
    df = inline(
        spark, [(1, "a", "10"), (1, "a", "20"), (1, "b", "30")], "load_run_id long, rule string, v string"
    )
    for rule in "ab":
        tables.replace_slice(df.filter(F.col("rule") == rule), path, {"load_run_id": 1, "rule": rule})
    assert _slice_of(spark, path) == [(1, "a", "10"), (1, "a", "20"), (1, "b", "30")]
    return path


A = {"load_run_id": 1, "rule": "a"}


def _only_the_table(path):
    """Nothing is left beside the table or aside."""
    root = Path(path)
    return not [f for name in ("_beside", "_aside") for f in (root / name).rglob("*.parquet")]


def test_refused_rows_leave_the_slice(spark, slices):
    before = _slice_of(spark, slices)
    rows = inline(spark, [(1, "a", "99"), (1, "foreign", "7")], "load_run_id long, rule string, v string")
    with pytest.raises(tables.ForeignRows, match="1 rows do not belong"):
        tables.replace_slice(rows, slices, A)
    assert _slice_of(spark, slices) == before and _only_the_table(slices)


def test_failed_write_leaves_the_slice(spark, slices):
    before = _slice_of(spark, slices)
    broken = spark.range(1000, numPartitions=8).select(
        F.lit(1).cast("long").alias("load_run_id"),
        F.lit("a").alias("rule"),
        F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("v"),
    )
    with pytest.raises(Exception, match="lost"):
        tables.replace_slice(broken, slices, A)
    assert _slice_of(spark, slices) == before and _only_the_table(slices)


def test_slice_may_be_made_from_itself(spark, slices):
    table = spark.read.schema("load_run_id long, rule string, v string").parquet(slices)
    doubled = table.filter("rule = 'a'").withColumn("v", F.concat("v", F.lit("0")))
    tables.replace_slice(doubled, slices, A)
    assert _slice_of(spark, slices) == [(1, "a", "100"), (1, "a", "200"), (1, "b", "30")]
    assert _only_the_table(slices)


@pytest.mark.parametrize("lost_at", [1, 2])
def test_interrupted_replacement_is_settled(spark, slices, monkeypatch, lost_at):
    """The driver goes after the given number of renames; the next replacement finds the table whole."""
    before = _slice_of(spark, slices)
    real, calls = tables._rename, []

    class Gone(BaseException):
        pass

    def rename(*args):
        if len(calls) == lost_at:
            raise Gone
        calls.append(args)
        real(*args)

    rows = inline(spark, [(1, "a", "99")], "load_run_id long, rule string, v string")
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_rename", rename)
        patched.setattr(tables._Files, "delete", lambda self, path: None if lost_at == 1 else rename())
        with pytest.raises(Gone):
            tables.replace_slice(rows, slices, A)
    tables.settle(spark, slices, A)
    assert _slice_of(spark, slices) == (before if lost_at == 1 else [(1, "a", "99"), (1, "b", "30")])
    tables.replace_slice(rows, slices, A)
    assert _slice_of(spark, slices) == [(1, "a", "99"), (1, "b", "30")]


def test_totals_beyond_thirteen_digits(spark):
    big = Decimal("9000000000000.000000")
    rows = [("COST_POOL", 1, date(2024, m, 1), *[big if c == "gl_amount" else Decimal(0) for c in recon.AMOUNTS]) for m in (1, 2, 3)]
    ddl = "reconciliation_level string, load_run_id long, reporting_month date, " + ", ".join(
        f"{c} decimal(19,6)" for c in recon.AMOUNTS
    )
    total = recon.reconcile_total(inline(spark, rows, ddl)).first()
    assert total["gl_amount"] == 3 * big == total["reconciliation_difference"]
    ledger = inline(spark, [(date(2024, 1, 1), big)] * 3, "reporting_month date, signed_amount decimal(19,6)")
    assert pools.ledger_totals(ledger).first()["signed_gl_total"] == 3 * big


def test_readiness_fails_closed(spark):
    rules = inline(
        spark, [("A", "Y", "Y"), ("B", "Y", "Y"), ("C", "N", "Y"), ("D", "Y", "N")],
        "validation_rule_id string, blocking_flag string, active_flag string",
    )
    result_ddl, control_ddl = "load_run_id long, validation_rule_id string, validation_status string", "load_run_id long, control_status string"
    total = inline(spark, [(1, "TOTAL", "PASS")], "load_run_id long, reconciliation_level string, reconciliation_status string")
    both = [(1, "A", "PASS"), (1, "B", "PASS"), (1, "C", "REVIEW"), (1, "D", "FAIL")]

    def flag(results, controls):
        frames = inline(spark, results, result_ddl), inline(spark, controls, control_ddl)
        return checks.readiness(frames[0], rules, frames[1], total).first()["publish_flag"]

    assert flag(both, [(1, "PASS")]) == "Y"
    assert flag(both[1:], [(1, "PASS")]) == "N"
    assert flag([(1, "A", "FAIL"), *both[1:]], [(1, "PASS")]) == "N"
    assert flag(both, [(2, "PASS")]) == "N"
    assert flag(both, [(1, "PASS"), (1, "FAIL")]) == "N"
    assert flag([(2, "A", "PASS")], [(1, "PASS")]) == "N"
    empty = inline(spark, both, result_ddl).filter("false")
    padded = quality.with_missing(
        empty.selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in zip(quality.RESULT_COLUMNS, ("LONG", "STRING", "LONG", "LONG", "DECIMAL(38,6)", "STRING", "STRING"))]),
        1, ["RU_NOT_PROMOTED"],
    )
    assert values(padded, "validation_rule_id", "validation_status") == [("RU_NOT_PROMOTED", "PASS")]


def test_two_factors_for_one_adjustment_are_refused(spark):
    rules = inline(spark, [("REMOTE", "1.1"), ("REMOTE", "1.1"), ("REMOTE", "1.2")], "adjustment_code string, factor string")
    with pytest.raises(ValueError, match="REMOTE"):
        funding.adjustment_factors(rules)
    assert funding.adjustment_factors(rules.limit(2))["REMOTE"] == Decimal("1.100000")


def test_append_new_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "load_run_id long, source_file_name string, source_row_number long, v string"
    first = inline(spark, [(1, "f", 2, "a")], schema)
    more = inline(spark, [(1, "f", 2, "a"), (1, "f", 3, "b")], schema)
    tables.append_new(first, path, None)
    for _ in range(2):
        tables.append_new(more, path, spark.read.schema(more.schema).parquet(path))
    assert values(spark.read.schema(more.schema).parquet(path), "v") == [("a",), ("b",)]


def test_upsert_keeps_target_only_rows(spark):
    target = inline(spark, [("a", "old"), ("b", "kept")], "k string, v string")
    source = inline(spark, [("a", "new"), ("c", "added")], "k string, v string")
    assert values(reference.upsert(target, source, ["k"])) == [("a", "new"), ("b", "kept"), ("c", "added")]


def test_repeated_keys_can_be_rejected(spark):
    text = {c: "x" for c in ENCOUNTER.columns}
    text |= {"admission_date": "2025-01-01", "discharge_date": "2025-01-02", "episode_month": "2025-01-01", "length_of_stay": "1", "age_years": "30"}
    rows = [(1, "f", i, *{**text, "encounter_id": key}.values()) for i, key in enumerate(["A", "A", "B", ""])]
    landed = inline(spark, rows, "load_run_id long, source_file_name string, source_row_number long, " + ", ".join(f"{c} string" for c in text))
    refs = {c: inline(spark, [("x",)], f"{c} string") for c in ENCOUNTER.conforms}
    assert promote.accepted(promote.classify(landed, ENCOUNTER, refs)).count() == 4
    strict = promote.classify(landed, ENCOUNTER, refs, unique=True, blank_is_null=True)
    assert values(promote.accepted(strict), "encounter_id") == [("B",)]
    assert values(promote.rejected(strict), "reject_reason") == [
        ("invalid encounter_id",),
        ("repeated encounter_id",),
        ("repeated encounter_id",),
    ]
    assert values(checks.repeated_keys(promote.accepted(promote.classify(landed, ENCOUNTER, refs)), ["encounter_id"])) == [("A", 2)]


# --- stays, funding, variance -------------------------------------------------------------


def test_stay_over_two_months(spark):
    stays = inline(
        spark,
        [
            (1, "M", "Inpatient", "x", JAN, date(2025, 1, 28), date(2025, 2, 6)),
            (1, "F", "Inpatient", "x", JAN, date(2025, 1, 30), date(2025, 2, 1)),
            (1, "S", "Same-day", "x", JAN, date(2025, 1, 5), date(2025, 1, 5)),
        ],
        ENCOUNTERS,
    ).withColumn("units", F.lit(7))
    found = values(timeline.spread_over_months(stays, ["units"]), "encounter_id", "service_month", "bed_days", "units")
    feb = date(2025, 2, 1)
    assert found == [("F", JAN, 2, 4), ("F", feb, 1, 3), ("M", JAN, 4, 4), ("M", feb, 5, 3), ("S", JAN, 0, 7)]


def test_encounter_funding_matches_exact_decimals(spark):
    groups = inline(
        spark,
        [("AG01", "Admitted acute", Decimal("1.85"), 12, Decimal("0.055")), ("AG04", "Admitted acute", Decimal("0.75"), 1, Decimal("0.03"))],
        "activity_group_code string, service_stream string, synthetic_base_weight decimal(12,6), high_length_of_stay_trim_days short, synthetic_outlier_nwau_per_day decimal(12,6)",
    )
    people = [
        (1, f"E{i}", JAN, code, los, age, ind, area, care)
        for i, (code, los, age, ind, area, care) in enumerate(
            [("AG01", 15, 17, "Y", "Remote", "Inpatient"), ("AG04", 0, 50, "N", "x", "Same-day"), ("AG01", 1, 50, "N", "x", "Inpatient"), ("NONE", 1, 5, "Y", "x", "Inpatient")]
        )
    ]
    df = inline(spark, people, "load_run_id long, encounter_id string, episode_month date, activity_group_code string, length_of_stay short, age_years short, indigenous_status string, remoteness_area string, care_type string")
    rows = {r.encounter_id: r for r in funding.encounter_funding(df, groups).collect()}
    factor = Decimal("1.04") * Decimal("1.06") * Decimal("1.05")
    nwau = Decimal("1.85") * factor + 3 * Decimal("0.055")
    cents = Decimal("0.01")
    assert rows["E0"].final_synthetic_nwau == nwau.quantize(Decimal("0.000001"), ROUND_HALF_UP)
    assert rows["E0"].estimated_synthetic_funding == (nwau * 10750).quantize(cents, ROUND_HALF_UP)
    assert rows["E0"].funding_note == (
        "Synthetic Indigenous adjustment; Synthetic remote adjustment; "
        "Synthetic paediatric adjustment; Synthetic long-stay outlier: 3 days"
    )
    assert rows["E1"].funding_note == "Synthetic same-day adjustment"
    assert rows["E2"].funding_note == "Base synthetic weight only"
    assert (rows["E3"].funding_status, rows["E3"].final_synthetic_nwau) == ("UNFUNDED_REVIEW", None)
    control = funding.monthly_funding_control(funding.encounter_funding(df, groups)).first()
    assert (control.encounter_count, control.funded_encounter_count, control.unfunded_review_count) == (4, 3, 1)


def test_adjustment_table_overrides_defaults(spark):
    rules = inline(spark, [("REMOTE", "1.10"), ("LONG_STAY", "Varies by group")], "adjustment_code string, factor string")
    factors = funding.adjustment_factors(rules)
    assert factors["REMOTE"] == Decimal("1.10") and factors["INDIGENOUS"] == Decimal("1.04")
    assert "LONG_STAY" not in factors


def test_material_variance_needs_both_thresholds(spark):
    rows = [(1, date(2025, m, 1), "L", Decimal(c)) for m, c in ((1, 1000000), (2, 1100000), (3, 1190000), (5, 3000000))]
    df = inline(spark, rows, "load_run_id long, reporting_month date, service_line string, total_patient_cost decimal(19,6)")
    found = values(variance.monthly_variance(df, ["service_line"]), "reporting_month", "cost_change", "material_flag")
    assert [(r[0].month, r[1], r[2]) for r in found] == [(1, None, "N"), (2, 100000, "Y"), (3, 90000, "N"), (5, None, "N")]


@pytest.mark.parametrize(
    "amount, gl, level",
    [("999.99", "100000000", "Low"), ("1000", "100000000000", "Medium"), ("5", "50000", "Medium"), ("10000", "100000000", "High"), ("50", "5000", "Critical"), ("-100000", "100000000000", "Critical")],
)
def test_materiality_takes_the_higher_level(spark, amount, gl, level):
    lost = inline(spark, [(1, JAN, "REVIEW", Decimal(amount))], "load_run_id long, reporting_month date, unallocated_reason string, unallocated_amount decimal(19,6)")
    monthly = inline(spark, [(1, JAN, Decimal(gl))], "load_run_id long, reporting_month date, signed_gl_total decimal(19,6)")
    assert variance.unallocated_materiality(lost, monthly).first().materiality == level


def test_control_totals_ignore_keys_without_control(spark):
    control = inline(spark, [("a", Decimal(5)), ("b", Decimal(1)), ("c", Decimal(0))], "k string, expected_signed_gl_total decimal(19,6)")
    actual = inline(spark, [("a", Decimal(5)), ("b", Decimal(2)), ("d", Decimal(9))], "k string, signed_gl_total decimal(19,6)")
    assert values(checks.control_differences(control, actual, ["k"]), "k") == [("b",)]


def test_numeric_summary_of_many_values_and_groups(spark):
    df = inline(spark, [(float(i), float(i % 3), i % 2) for i in range(2001)], "x double, y double, odd int")
    found = summaries.numeric_summary(df, ["x", "y"])
    assert values(found, "measure", "median", "p95") == [("x", 1000.0, 1900.0), ("y", 1.0, 2.0)]
    grouped = summaries.numeric_summary(df, ["x"], by=("odd",))
    assert values(grouped, "odd", "count", "median") == [(0, 1001, 1000.0), (1, 1000, 1000.0)]


def test_clear_staging_removes_only_own_files(spark, tmp_path):
    from costweave import session

    df = stage(inline(spark, [(1,)], "x int"), "thing")
    path = df.inputFiles()[0].removeprefix("file:")
    from pathlib import Path

    assert Path(path).exists()
    session.clear_staging(spark)
    assert not Path(path).exists()
