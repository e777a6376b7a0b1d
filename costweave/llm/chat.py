"""Chat formatting: collapse cumulative snapshots of a conversation, then render.

Every turn gets the hash of the conversation up to it. A conversation goes when its
full hash is the hash of a proper prefix of another; of equal ones the smallest id
stays. DataFrame operations only.

The rolling hash is a sum of hashes of (place, role, text), three words of 40 bits,
so a long conversation can be summed in blocks of ``BLOCK`` turns: no task orders
more than a block, however many turns one conversation has. Prefix hashes are made
distinct before the anti-join, so a first turn that everybody shares is one row.

Defined results: turns are ordered by turn (null first), role and text; a row
repeated with the same id, turn, role and text counts once; null roles and texts
differ from empty ones when comparing and render as empty; rows with a null id are
one conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.session import stage

BLOCK = 1024
WORDS = 3
_BITS = 40


def _hashed(seed: int, *values: Column) -> Column:
    """A hash of 40 bits, so that eight million of them fit into a sum."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *values), 64 - _BITS)


def _marked(name: str) -> list[Column]:
    return [F.col(name).isNull(), F.coalesce(F.col(name).cast("string"), F.lit(""))]


def _running(blocks: DataFrame, names: list[str]) -> DataFrame:
    """For each block of a conversation the sums over the blocks before it."""
    earlier = (
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return blocks.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"before_{n}") for n in names],
    )


def _with_blocks(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return turns.join(blocks, same).drop("_conv", "_block")


def prefixes(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, p0..p2``: the hash of each conversation up to each turn."""
    hashes = [f"h{i}" for i in range(WORDS)]
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).alias("block"),
        "role",
        *[_hashed(i, *_marked("role"), *_marked("text")).alias(h) for i, h in enumerate(hashes)],
    ).distinct()
    order = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), *hashes
    )
    counted = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    placed = _with_blocks(turns, _running(counted, ["n"])).withColumn(
        "place", F.col("before_n") + F.row_number().over(order)
    )
    sums = [f"s{i}" for i in range(WORDS)]
    keyed = placed.select(
        "conv_id",
        "block",
        "place",
        *[_hashed(16 + i, F.col("place"), F.col(h)).alias(s) for i, (h, s) in enumerate(zip(hashes, sums))],
    )
    keyed = stage(keyed, "turn_hashes")
    totals = keyed.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in sums])
    running = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return _with_blocks(keyed, _running(totals, sums)).select(
        "conv_id",
        "place",
        *[(F.col(f"before_{s}") + F.sum(s).over(running)).alias(f"p{i}") for i, s in enumerate(sums)],
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_logged``: conversations that no other one continues.

    ``n_logged`` counts the equal conversations it stands for, itself included.
    """
    hashed = stage(prefixes(conversations), "prefix_hashes")
    lengths = hashed.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    # one row per conversation; its id is joined null-safe
    length = lengths.withColumnRenamed("conv_id", "_conv")
    marked = hashed.join(length, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    key = ["place", *[f"p{i}" for i in range(WORDS)]]
    whole = marked.where("place = n_turns").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged")
    )
    partly = marked.where("place < n_turns").select(*key).distinct()
    return whole.join(partly, key, "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_logged"
    )


def render(conversations: DataFrame, kept: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_logged, text`` with every turn as ``<|role|>``, line end, text, line end."""
    texted = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n")
    )
    stays = kept.withColumnRenamed("conv_id", "_conv")
    turns = (
        conversations.select("conv_id", "turn", "role", "text")
        .join(stays, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .select("conv_id", "turn", "role", "text", "n_turns", "n_logged")
        .distinct()
    )
    order = F.array_sort(
        F.collect_list(
            F.struct(
                F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
                F.struct(*_marked_first("role")).alias("role"),
                *[
                    _hashed(i, *_marked("role"), *_marked("text")).alias(f"h{i}")
                    for i in range(WORDS)
                ],
                texted.alias("shown"),
            )
        )
    )
    return turns.groupBy("conv_id", "n_turns", "n_logged").agg(
        F.array_join(F.transform(order, lambda t: t["shown"]), "").alias("text")
    )


def _marked_first(name: str) -> list[Column]:
    """Sorts null before every text."""
    return [F.col(name).isNotNull().alias("given"), F.coalesce(F.col(name), F.lit("")).alias("value")]


def format_chats(conversations: DataFrame) -> DataFrame:
    return render(conversations, stage(maximal(conversations), "maximal_conversations"))
