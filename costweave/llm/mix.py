"""Mixing sources to target weights, in DataFrame operations only.

Tokens are summed per source, targets follow from the weights, and a source's
repetition rate is its target over its size. A document is emitted floor(rate)
times, and once more when a coin seeded by its key and text falls below the fraction.

Only a hash of both decides, so reruns and other partitionings agree. The table
of sources is never assumed small: it is placed in order by range partitions, its
water level is found by sums over the stored table, and it is broadcast only when
counted within the limit of ``costweave.session``; a larger one is joined by
shuffle, where adaptive execution splits a hot source.

Defined results: a null text has size 0; a null source is a source of its own and
sorts last; rows with the same key (or none) and other texts have coins of their own, rows
with the same key and text share one; an empty table gives no rows; a mix without words takes nothing and has target 0. Every column is kept: an
added one whose name is taken has an underscore at its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.llm.common import SPACES, in_order, part_heads, spare
from costweave.session import lookup, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1:"


def size(text: str = "text") -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPACES)), F.lit(0)).cast("long")


def coin(key: str = "doc_id", text: str = "text") -> Column:
    """A number in [0, 1) that depends on the key, the text and the seed alone."""
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), body))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2**52)


def _weighed(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """A weight for every source by its place in code point order, null last."""
    placed = in_order(sources, F.col("source").asc_nulls_last())
    parts = part_heads(placed, rows=F.count("*"))
    # one row for each partition, so one task can add them up
    before = F.coalesce(
        F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = parts.select("part", before.alias("before"))
    place = (F.col("before") + F.col("place") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    return placed.join(F.broadcast(offsets), "part").select("source", "source_size", weight.alias("weight"))


def targets(
    sized: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """``source, source_size, target, rate`` from rows of ``source, size``.

    A source stops at ``most`` times its size; what it cannot take goes to the
    others by weight. The level per unit of weight only rises from one round to
    the next, so the rounds end; each needs two sums.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(_weighed(stage(per_source, "source_sizes"), weights), "source_weights")
    whole = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.col("source_size") * most
    level, stopped = 0.0, -1
    while True:
        full = cap < F.lit(level) * F.col("weight")
        taken, weight, count = sources.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))
        ).first()
        if count == stopped or not weight:
            break
        level, stopped = (whole - (taken or 0)) / weight, count
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return sources.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def with_copies(docs: DataFrame, rates: DataFrame, drawn: Column) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, how often a row is taken.

    ``drawn`` is the ``coin`` of a row.
    """
    source, rate, *added = spare(docs, "_source", "_rate", "source_size", "target", "copies")
    rated = rates.toDF(source, *added[:2], rate)
    joined = docs.join(lookup(rated), F.col("source").eqNullSafe(F.col(source)))
    whole = F.floor(rate)
    copies = whole + (drawn < F.col(rate) - whole).cast("long")
    return joined.withColumn(added[2], copies).drop(source, rate)


def mix(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as it is taken."""
    rates = stage(targets(docs.select("source", size().alias("size")), **settings), "mix_rates")
    copies, copy = spare(docs, "copies", "copy")
    taken = with_copies(docs, rates, coin(key)).where(F.col(copies) > 0)
    return taken.select(
        *docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(copy)
    )
