"""Queries against their SQL twins, and the contract of the entry module."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from costweave.plans.catalog import QUERIES, TWINS

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")
COMPARED = [
    "a2_lineage",
    "a7_upsert",
    "a8_replace_run",
    "a9_replace_slice",
    "a10_append_new",
    "b7_promote_resource",
    "d2_driver_totals",
    "h1_cost_pools",
    "h7_patient_level_cost",
    "h7_facility_costs",
    "h11_facility_reconciliation",
    "h4_facility_allocations",
    "h14_encounter_funding",
    "i7_issue_life_cycle",
    "b6_repeated_keys",
    "k21_funding_statistics",
    "k21_ledger_statistics",
    "m4_contested_pools",
    "k3_encounter_checks",
    "l2_bed_days_and_splits",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(rows):
    return sorted((tuple("" if v is None else v for v in row) for row in rows), key=str)


def result(df):
    names = sorted(df.columns)
    return normal(tuple(r) for r in df.select(*names).collect())


def test_every_query_has_a_twin_that_binds(duck):
    assert TWINS.keys() == QUERIES.keys()
    assert QUERIES.keys() <= queries().keys() and TWINS.keys() <= oracle_sql().keys() <= queries().keys()
    for sql in TWINS.values():
        duck.sql(f"EXPLAIN {sql}")


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_twin(spark, duck, name):
    relation = duck.sql(oracle_sql()[name])
    names = sorted(relation.columns)
    picked = ", ".join(f'"{n}"' for n in names)
    expected = normal(duck.sql(f"SELECT {picked} FROM relation").fetchall())
    df = queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == names
    assert result(df) == expected


def test_entry_runs(spark):
    assert entry(spark).count() == 1500


def test_partition_count_does_not_change_results(spark):
    query = queries()["h7_patient_level_cost"]
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            results.append(result(query(spark, SF_DIR)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert results[0] == results[1]


def test_plan_keeps_drivers_in_place(spark):
    """Pricing a driver row is a broadcast join: drivers shuffle only to be summed."""
    plan = queries()["d4_indirect_by_encounter"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all lines on one order, a third on one supplier, a third of all
    orders on one customer and day."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changes = {
        "orders": """* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1997-03-05' ELSE o_orderdate END AS o_orderdate)""",
        "lineitem": """* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN l_partkey % 3 = 1 THEN 5 ELSE l_suppkey END AS l_suppkey)""",
    }
    for name in TABLES:
        columns = changes.get(name, "*")
        con.sql(
            f"COPY (SELECT {columns} FROM '{SF_DIR}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize(
    "name",
    ["b7_promote_resource", "h7_patient_level_cost", "h13_reconciliation_total", "m4_overlapping_periods"],
)
def test_hot_keys_change_nothing(spark, skewed, name):
    folder, con = skewed
    relation = con.sql(oracle_sql()[name])
    names = sorted(relation.columns)
    picked = ", ".join(f'"{n}"' for n in names)
    expected = normal(con.sql(f"SELECT {picked} FROM relation").fetchall())
    assert result(queries()[name](spark, folder)) == expected


class FakeContext:
    def __init__(self, master):
        self.master, self.checkpoint = master, None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


class FakeSession:
    def __init__(self, master):
        self.conf, self.sparkContext = {}, FakeContext(master)


def test_staging_folder(spark):
    from costweave.session import CHECKPOINT_DIR, stage, staging_root

    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        df = stage(spark.range(3), "numbers")
        assert df.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(
            f"{configured.strip('/')}/costweave/"
        )
    with pytest.raises(RuntimeError):
        staging_root(FakeSession("spark://master:7077"))
    local = FakeSession("local[2]")
    assert staging_root(local) == staging_root(local) == local.sparkContext.checkpoint
