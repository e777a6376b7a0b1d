"""Exact interpolated percentiles of groups that may hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.session import stage

#: The sketch's rank error is at most one in so many rows of a group.
ACCURACY = 10_000


def group_percentile(
    df: DataFrame, keys: list[str], value: str, p: float, name: str = "percentile", accuracy: int = ACCURACY
) -> DataFrame:
    """``group_percentiles`` for one percentile."""
    return group_percentiles(df, keys, value, {name: p}, accuracy)


def group_percentiles(
    df: DataFrame, keys: list[str], value: str, ps: Mapping[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """``cohort_count`` and exact percentiles, linearly interpolated, as double, of every group.

    Pass a stored table: it is read twice. A first aggregate counts each group and
    sketches a bracket around each percentile, all mergeable. A second one counts equal
    values inside the brackets and, without their values, the rows between brackets: a
    few parts in ``accuracy`` of the rows are left. Those are dealt out by group *and*
    value, so a group of any size is ranked in many tasks: each part is ranked by
    itself and starts where the parts before it end. Should a rank fall between the
    brackets, the brackets are widened, so the result is exact whatever the sketch says.

    Null values are left out; groups may have null keys. ``copies`` of equal values cost
    one row. The route is the same at every size.
    """
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"))
    wanted = sorted(ps.items(), key=lambda item: item[1])
    margin = 2.0 / accuracy
    while True:
        found = stage(_interpolated(_placed(known, keys, wanted, margin, accuracy), keys, wanted), "percentiles")
        missed = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in ps])
        if margin >= 1 or found.filter(missed).isEmpty():
            return found
        margin *= 8


def _placed(known: DataFrame, keys: list[str], ps: list[tuple[str, float]], margin: float, accuracy: int) -> DataFrame:
    """Values inside brackets with their ``copies``, and the rows between brackets, by range partition."""
    points = [min(max(p + side, 0.0), 1.0) for _, p in ps for side in (-margin, margin)]
    # a bracket of few rows could lie beside the two ranks it is for: such a group, of less than
    # 2 * accuracy rows, counts all its values
    few = F.col("cohort_count") * F.lit(margin) < 4
    groups = stage(
        known.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("cohort_count"),
            F.percentile_approx("value", points, accuracy).alias("q"),
            F.min("value").alias("least"),
            F.max("value").alias("most"),
        )
        .select(
            *[F.col(k).alias(f"_{k}") for k in keys],
            "cohort_count",
            F.array(*[F.when(few | F.lit(q <= 0), F.col("least")).otherwise(F.col("q")[i])
                      for i, q in enumerate(points)][::2]).alias("low"),
            F.array(*[F.when(few | F.lit(q >= 1), F.col("most")).otherwise(F.col("q")[i])
                      for i, q in enumerate(points)][1::2]).alias("high"),
        ),
        "brackets",
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    x = F.col("value")
    inside = reduce(
        lambda a, b: a | b, [(x >= F.col("low")[i]) & (x <= F.col("high")[i]) for i in range(len(ps))]
    )
    counted = (
        known.join(groups, same)
        .select(
            *keys,
            "cohort_count",
            # how many brackets lie below: rows between brackets have their place by this alone
            reduce(lambda a, b: a + b, [(F.col("high")[i] < x).cast("int") for i in range(len(ps))]).alias("piece"),
            F.when(inside, x).alias("value"),
        )
        .groupBy(*keys, "cohort_count", "piece", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    spread = counted.repartitionByRange(*keys, "piece", "value")
    return stage(spread.withColumn("part", F.spark_partition_id()), "placed")


def _interpolated(placed: DataFrame, keys: list[str], ps: list[tuple[str, float]]) -> DataFrame:
    """Percentiles from the parts that hold a wanted rank; null where the rank has no value."""
    position = {name: (F.col("cohort_count") - 1) * F.lit(p) for name, p in ps}
    ranks = [f(at) for at in position.values() for f in (F.floor, F.ceil)]

    def any_rank(first: Column, end: Column) -> Column:
        return reduce(lambda a, b: a | b, [(first <= r) & (r < end) for r in ranks])

    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each part of a group
    parts = (
        placed.groupBy(*keys, "cohort_count", "part")
        .agg(F.sum("copies").alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .filter(any_rank(F.col("before"), F.col("before") + F.col("rows")))
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), "before")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    running = Window.partitionBy(*keys, "part").orderBy("piece", F.col("value").asc_nulls_first())
    ranked = placed.join(parts, same & (F.col("part") == F.col("_part"))).withColumn(
        "upto", F.col("before") + F.sum("copies").over(running)
    )

    def at(rank: Column) -> Column:
        hit = (F.col("upto") > rank) & (F.col("upto") - F.col("copies") <= rank)
        return F.max(F.when(hit, F.col("value"))).cast("double")

    bounds = [
        at(f(position[name])).alias(f"_{side}{i}")
        for i, (name, _) in enumerate(ps) for side, f in (("low", F.floor), ("high", F.ceil))
    ]
    out = []
    for i, (name, _) in enumerate(ps):
        low, high, share = F.col(f"_low{i}"), F.col(f"_high{i}"), position[name] - F.floor(position[name])
        out.append(F.when(low == high, low).otherwise((1 - share) * low + share * high).alias(name))
    return ranked.groupBy(*keys, "cohort_count").agg(*bounds).select(*keys, "cohort_count", *out)
