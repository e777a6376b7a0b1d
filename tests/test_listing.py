"""What large listings do once and beside the rows that they multiply, on hand-written tables."""

from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from costweave import constants as K
from costweave.functions.columns import inline
from costweave.operators import allocate
from costweave.plans.catalog import costing_run
from costweave.sources import star

JAN = date(2025, 1, 1)
RATES = (
    "load_run_id long, reporting_month date, facility string, cost_centre_id string, natural_account string, "
    "cost_pool_code string, allocation_driver string, costing_treatment string, total_driver_units decimal(29,6), "
    "allocation_rate decimal(38,13)"
)
UNITS = (
    "load_run_id long, reporting_month date, cost_pool_code string, allocation_driver string, encounter_id string, "
    "driver_units decimal(19,6), driver_status string, place string"
)


@pytest.fixture(scope="module")
def star_dir(spark, tmp_path_factory):
    """Two facilities, three orders of two lines; order 2 is there twice."""
    folder = str(tmp_path_factory.mktemp("star"))
    day = datetime(1996, 3, 5)
    rows = {
        "region": [(0, "NORTH"), (1, "SOUTH")],
        "nation": [(0, "N0", 0), (4, "N4", 1)],
        "customer": [(1, "c1", 0, 0.0, "BUILDING"), (2, "c2", 4, 0.0, "BUILDING")],
        "supplier": [(1, "s1", 0, 0.0), (2, "s2", 4, 0.0)],
        "orders": [(k, c, s, 1.0, day, "1-URGENT") for k, c, s in [(1, 1, "F"), (2, 2, "O"), (2, 2, "O"), (3, 1, "P")]],
        "lineitem": [
            (k, 1, supplier, number, 3.0 * k, 100.0 + k, 0.0, 0.0, "N", "F", day)
            for k in (1, 2, 3)
            for number, supplier in ((1, 1), (2, 2))
        ],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, star.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_listing_carries_columns_of_drivers_and_prices_exactly(spark):
    rate = [Decimal("12.3456789012345"), Decimal("-0.0000005000000"), Decimal("999999999999.1234567890123")]
    rates = inline(
        spark,
        [(1, JAN, "F", f"C{i}", "A", "WARD_NURSING", "bed_days", "Indirect", Decimal(9), r) for i, r in enumerate(rate)],
        RATES,
    )
    units = [Decimal(1), Decimal(7), Decimal("0.000001"), Decimal("2.5"), Decimal("3.333333")]
    rows = inline(
        spark,
        [(1, JAN, "WARD_NURSING", "bed_days", f"E{i}", u, K.VALID, f"P{i}") for i, u in enumerate(units)],
        UNITS,
    )
    listed = allocate.allocate(rates, rows, carried=("place",))
    found = {(r.encounter_id, r.cost_centre_id): (r.place, r.allocated_amount) for r in listed.collect()}
    six = Decimal("0.000001")
    rates_of = {f"C{i}": r.quantize(Decimal("1e-13"), ROUND_HALF_UP) for i, r in enumerate(rate)}
    assert found == {
        (f"E{i}", centre): (f"P{i}", (u * r).quantize(six, ROUND_HALF_UP))
        for i, u in enumerate(units)
        for centre, r in rates_of.items()
    }


def test_facility_listing_is_summed_where_it_is_made(spark, star_dir):
    """The places of encounters meet driver rows; the listing of pools times drivers meets nothing."""
    df = queries()["h4_facility_allocations"](spark, star_dir)
    assert "Join" not in optimized(df).split("Union")[0]
    rows = df.collect()
    assert rows and all(r.foreign_rows == 0 for r in rows)


def test_detail_shows_months_and_units_before_pools_multiply_rows(spark, star_dir):
    df = queries()["h4_indirect_allocation_detail"](spark, star_dir)
    above = optimized(df).split("Join")[0]
    assert "reporting_month" in above and "as string)" not in above and "driver_units" in above
    assert above.count("as double)") == 1  # the amount; units were shown below
    assert df.schema["reporting_month"].dataType.simpleString() == "string"
    assert df.filter(F.col("reporting_month") == "1996-03-01").count() > 0


def test_gap_prices_indirect_cost_once(spark, star_dir):
    df = queries()["h7_attribution_gap"](spark, star_dir)
    assert optimized(df).count("Join") == 1  # allocated with carried; both are sums of stored rows
    row = df.collect()[0]
    assert row.allocated_amount > 0 and round(row.allocated_amount - row.attributed_amount, 2) == row.unattributed_amount


def test_run_stores_no_row_keys_that_it_never_reads(spark, star_dir):
    used = costing_run(spark, star_dir).resource
    assert "resource_usage_id" not in used.columns and used.count() == 8  # two months of four orders
