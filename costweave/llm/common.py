"""What the operators share: reading tables, learning splits, and places in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costweave.session import stage

SPACES = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str, parts: int, part: int) -> Column:
    """True for rows outside the learning part; a null key is learned from."""
    remainder = F.crc32(F.col(key).cast("string")) % F.lit(parts)
    return F.coalesce(remainder == part, F.lit(False))


def spare(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores at the end of those that ``docs`` already has."""
    taken = {c.lower() for c in docs.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        free.append(name)
        taken.add(name.lower())
    return free


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """``df``, sorted into range partitions: ``part`` and ``place`` (1, 2, ...) within it.

    The rows are stored, so that the partition of a row is a fact and not the
    outcome of a repeated sampling. Give it keys, not texts.
    """
    spread = df.repartitionByRange(task_count(df.sparkSession), *order)
    placed = stage(spread.withColumn("part", F.spark_partition_id()), "in_order")
    inside = Window.partitionBy("part").orderBy(*order)
    return placed.withColumn("place", F.row_number().over(inside))


def part_heads(placed: DataFrame, **firsts: Column) -> DataFrame:
    """One row for each partition of ``in_order``: bounded by the number of partitions."""
    return placed.groupBy("part").agg(*[c.alias(name) for name, c in firsts.items()])
