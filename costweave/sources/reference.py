"""Typed readers of the governed reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costweave.functions.columns import blank_to_null
from costweave.schemas import REFERENCES


def read_reference(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """``<folder>/<name>.csv`` with its declared schema."""
    ref = REFERENCES[name]
    df = (
        spark.read.schema(ref.ddl)
        .option("header", True)
        .option("quote", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(f"{folder}/{name}.csv")
    )
    return df.withColumns({c: blank_to_null(c) for c in ref.blank_to_null})


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows win on ``keys``; rows only the target has are kept.

    A key that the source repeats is an error: which row should win is not said.
    """
    if repeated := source.groupBy(*keys).count().where("count > 1").select(*keys).head():
        raise ValueError(f"the source repeats the key {tuple(repeated)}")
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source)
