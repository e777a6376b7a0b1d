"""Promotion of landed text to typed rows, keeping every rejected row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.schemas import LINEAGE, RUN, Entity, Field
from costweave.session import lookups, stage

ENCOUNTER_KEY = [RUN, "encounter_id"]


def typed_value(field: Field, source: str, blank_is_null: bool = False) -> str:
    """SQL for the cleaned text or safely converted value of one landing column."""
    if not isinstance(field.kind, T.StringType):
        return f"try_cast({source} AS {field.kind.simpleString()})"
    text = f"substring(trim({source}), 1, {field.width})"
    return f"nullif({text}, '')" if blank_is_null else text


def classify(
    landing: DataFrame,
    entity: Entity,
    references: Mapping[str, DataFrame] | None = None,
    encounters: DataFrame | None = None,
    blank_is_null: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Typed columns, the landed text and ``reject_reason`` (null = accepted).

    Accepted and rejected rows come out of the same pass, so nothing is joined
    back to landing to find what is missing. ``references`` maps a column to the
    table its values must be in; ``encounters`` are the staged parents;
    ``unique`` also rejects every copy of a repeated business key.
    """
    typed = {f.name: typed_value(f, f"landed.{f.name}", blank_is_null) for f in entity.fields}
    checks: dict[str, str] = {}
    rows = landing.select(*LINEAGE, F.struct(*entity.columns).alias("landed")).selectExpr(
        *LINEAGE, "landed", *[f"{value} AS {name}" for name, value in typed.items()]
    )
    if entity.needs_encounter:
        # whatever the copies of a key, a row meets its parent once
        parents = encounters.select(*ENCOUNTER_KEY).distinct().withColumn("_parent", F.lit(True))
        rows = rows.join(parents, ENCOUNTER_KEY, "left")
        checks["unknown encounter"] = "_parent IS NULL"
    if entity.conforms:
        known = lookups(*[references[c].select(c).distinct() for c in entity.conforms])
        for column, values in zip(entity.conforms, known):
            rows = rows.join(values.withColumn(f"_known_{column}", F.lit(True)), column, "left")
            checks[f"unknown {column}"] = f"_known_{column} IS NULL"
    if unique:
        # a first pass over keys alone; what repeats is stored, so that its size decides the join
        # and the rows themselves stay where they are
        copies = rows.groupBy(RUN, entity.key).agg(F.count(F.lit(1)).alias("_copies"))
        repeated = stage(copies.filter(F.col("_copies") > 1), "repeated_keys")
        rows = rows.join(repeated, [RUN, entity.key], "left")
        checks[f"repeated {entity.key}"] = "_copies IS NOT NULL"
    checks |= {f"invalid {name}": f"{name} IS NULL" for name in typed}
    checks |= {f"negative {name}": f"{name} < 0" for name in entity.non_negative}
    if entity.ordered:
        start, end = entity.ordered
        checks[f"{end} before {start}"] = f"{end} < {start}"
    reasons = ", ".join(f"IF({failed}, '{why}', NULL)" for why, failed in checks.items())
    return rows.selectExpr(
        *LINEAGE,
        *entity.columns,
        "landed",
        f"nullif(concat_ws('; ', {reasons}), '') AS reject_reason",
    )


def accepted(classified: DataFrame) -> DataFrame:
    """Rows for staging."""
    return classified.filter(F.col("reject_reason").isNull()).drop("landed", "reject_reason")


def rejected(classified: DataFrame) -> DataFrame:
    """Rows kept out of staging, with what landed and why."""
    return classified.filter(F.col("reject_reason").isNotNull())


def not_staged(landing: DataFrame, staged: DataFrame) -> DataFrame:
    """Landed rows without a staged row, when both already are tables."""
    return landing.join(staged.select(*LINEAGE), LINEAGE, "left_anti")


def promotion_summary(classified: Mapping[str, DataFrame]) -> DataFrame:
    """Landed, staged and not staged rows per entity in one grouping."""
    union = None
    for name, df in classified.items():
        part = df.select(
            RUN, F.lit(name).alias("source_entity"), F.col("reject_reason").isNull().alias("ok")
        )
        union = part if union is None else union.unionByName(part)
    staged = F.count(F.when(F.col("ok"), 1))
    return union.groupBy(RUN, "source_entity").agg(
        F.count(F.lit(1)).alias("landing_count"),
        staged.alias("staged_count"),
        (F.count(F.lit(1)) - staged).alias("not_staged_count"),
    )
