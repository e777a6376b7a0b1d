"""Landing: delimited text with lineage, row controls and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costweave.functions.columns import inline
from costweave.schemas import RUN, Entity
from costweave.session import lookup, stage

LOAD_NAME = "LOAD_RAW_CSV_TO_LANDING"
RUN_LOG = (
    "load_run_id long, load_name string, financial_year string, source_root_path string, "
    "load_status string, event_at_utc timestamp, error_message string"
)
HEADER_LINES = 1


def read_landing_csv(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """Every column as nullable text, so malformed values land and can be reported.

    Carries the file and the block each row came from for ``add_lineage``.
    """
    df = (
        spark.read.schema(entity.landing_schema)
        .option("header", True)
        .option("quote", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return with_position(df)


def with_position(df: DataFrame) -> DataFrame:
    """File name, block start and reading order of each row of a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    )


def add_lineage(scan: DataFrame, run: int) -> DataFrame:
    """Run, file name and 1-based line of each row.

    Rows are numbered inside the file block they were read from and shifted by
    the rows of the blocks before it, so no file is ever sorted in one task.
    The scan is stored first: reading it again could split the files another way.
    The header takes line 1.
    """
    scan = stage(scan, "landing")
    block = ["source_file_name", "_block"]
    counted = scan.groupBy(*block).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_order").alias("_first")
    )
    before = (
        Window.partitionBy("source_file_name")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = stage(
        counted.select(
            *block,
            "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        ),
        "offsets",
    )
    line = F.col("_order") - F.col("_first") + F.col("_offset") + 1 + HEADER_LINES
    return (
        scan.join(lookup(offsets), block)
        .withColumn(RUN, F.lit(run).cast("long"))
        .withColumn("source_row_number", line)
        .drop("_block", "_order", "_first", "_offset")
    )


def file_row_control(landing: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against landed rows per file; a file that never landed fails."""
    actual = landing.groupBy(RUN, F.col("source_file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("actual_row_count")
    )
    return expected.join(actual, "file_name", "left").withColumn(
        "control_status",
        F.when(F.col("actual_row_count") == F.col("expected_row_count"), "PASS").otherwise("FAIL"),
    )


def log_event(
    spark: SparkSession,
    path: str,
    run: int,
    status: str,
    at: datetime,
    financial_year: str | None = None,
    source_root: str | None = None,
    error: str | None = None,
) -> None:
    """Append STARTED, COMPLETED or FAILED to the run log."""
    row = (run, LOAD_NAME, financial_year, source_root, status, at, error)
    inline(spark, [row], RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def latest_status(events: DataFrame) -> DataFrame:
    """Status of every run after its last event; an outcome beats its own start."""
    last = F.struct("event_at_utc", F.col("load_status") != "STARTED")
    return events.groupBy(RUN, "load_name").agg(
        F.max_by("load_status", last).alias("load_status")
    )


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """Latest status of every run in the log."""
    return latest_status(spark.read.schema(RUN_LOG).parquet(path))


def current_run(log: DataFrame, load_name: str = LOAD_NAME) -> DataFrame:
    """Highest completed run, as one row."""
    return log.filter(
        (F.col("load_name") == load_name) & (F.col("load_status") == "COMPLETED")
    ).agg(F.max(RUN).alias(RUN))
