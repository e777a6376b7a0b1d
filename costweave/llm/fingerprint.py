"""Document fingerprints: a homomorphic multiset hash, in DataFrame operations only.

A text is a multiset of paragraphs: its lines, of which long ones are cut every
``PIECE`` words. Each paragraph is hashed to a wide vector of bits and the vectors
are summed, so equal multisets have equal sums in any order, and a paragraph can
be added or taken away by adding or subtracting its vector (``combine``). Three
counters of 20 bits share a word; words are sums modulo 2**60.

Likeness compares sums: with bits read as signs, the squared distance of two vectors
over their length estimates how many paragraphs they do not share.

The first word is the number of paragraphs. Each text is read in one row, so nothing
but finished vectors is shuffled; the text that follows in order of the key sends
only the prefix that is needed.

Defined results: a null text is an empty text and has the fingerprint of nothing;
likeness of two empty texts is 1; rows with the same key are each returned, and the
next document is the one of the next larger key (of several, the one whose
text has the smallest hash);
a null key is the smallest; one key alone follows itself. Texts of any length are summed,
in blocks of paragraphs; beyond a million of them counters carry into their neighbours,
which leaves equality as it is and makes likeness a rough figure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costweave.llm.common import in_order
from costweave.session import stage

PIECE = 4
SEEDS = 2
_FIELD = 20
_MASK = 1 | 1 << _FIELD | 1 << 2 * _FIELD
_MODULUS = 1 << 3 * _FIELD
WORDS = SEEDS * _FIELD
# 2**22 words of 40 bits fit into a sum
BLOCK_BITS = 22
_NO_KEY = -(2**63)
LANES = 3 * WORDS

# a run of up to PIECE words with what follows them on the line, or other white space
_PARAGRAPH = rf"(?:[^\s]+[^\S\n]*){{1,{PIECE}}}\n?|\s"


def paragraphs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0))


def _word(seed: int, shift: int) -> Column:
    h = F.xxhash64(F.lit(seed), F.col("paragraph"))
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_MASK))


def _block_vectors(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``vector`` for every block of paragraphs of a text."""
    pieces = texts.select(*keys, F.posexplode_outer(paragraphs(F.col(text))).alias("pos", "paragraph"))
    block = F.shiftright(F.coalesce("pos", F.lit(0)), BLOCK_BITS).alias("block")
    # the hashes are computed once for all shifts by common subexpressions
    sums = [
        F.coalesce(F.sum(F.when(F.col("paragraph").isNotNull(), _word(seed, shift))), F.lit(0)) % _MODULUS
        for seed in range(SEEDS)
        for shift in range(_FIELD)
    ]
    return pieces.groupBy(*keys, block).agg(F.array(F.count("paragraph"), *sums).alias("vector"))


def _added(vectors: Column) -> Column:
    """The sum of the vectors that a group has."""
    zero = F.array_repeat(F.lit(0).cast("long"), WORDS + 1)
    return F.aggregate(F.collect_list(vectors), zero, lambda a, b: combine(a, b))


def vectors(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``vector``: an array of the paragraph count and the summed words."""
    return _block_vectors(texts, keys, text).groupBy(*keys).agg(_added(F.col("vector")).alias("vector"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector with the paragraphs of ``b`` added, or taken away for ``sign`` -1."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(_MODULUS)))


def as_text(vector: Column) -> Column:
    """The vector in hexadecimal, 15 digits for each word."""
    return F.array_join(F.transform(vector, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal multisets, near 0 for disjoint ones."""
    count_a, count_b = F.element_at(a, 1), F.element_at(b, 1)
    field = lambda x, i: F.shiftright(x, i * _FIELD).bitwiseAND(F.lit((1 << _FIELD) - 1))
    pairs = F.slice(F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), 2, WORDS)

    def squares(value):
        """Sums over the lanes, with ``value`` of the two signed counters."""
        each = lambda p: reduce(
            lambda s, i: s + value(2 * field(p["x"], i) - count_a, 2 * field(p["y"], i) - count_b), range(3), F.lit(0).cast("double")
        )
        return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + each(p))

    apart = squares(lambda x, y: ((x - y) * (x - y)).cast("double"))
    size = squares(lambda x, y: (x * x + y * y).cast("double"))
    value = F.when(a == b, 1.0).when(size == 0, 0.0).otherwise(1.0 - apart / size)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def _followers(keyed: DataFrame) -> DataFrame:
    """``_key, wanted_by, wanted``: the key before each key, and how much of its follower it wants."""
    least = keyed.groupBy("_key").agg((F.max(F.length("text")) / 4).cast("int").alias("quarter"))
    placed = in_order(least, F.col("_key"))
    me = F.struct("_key", "quarter")
    # one row for each partition
    tails = placed.groupBy("part").agg(F.max_by(me, "place").alias("tail"))
    around = Window.orderBy("part")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = tails.select(
        "part", F.coalesce(F.lag("tail").over(around), F.last("tail").over(whole)).alias("tail")
    )
    before = F.coalesce(F.lag(me).over(Window.partitionBy("part").orderBy("place")), F.col("tail"))
    return (
        placed.withColumn("me", me)
        .join(F.broadcast(tails), "part")
        .select("_key", before["_key"].alias("wanted_by"), before["quarter"].alias("wanted"))
    )


def _edited(keyed: DataFrame, before: DataFrame) -> DataFrame:
    """``_key, text, edited`` for every row; the texts are shuffled once and read twice."""
    starts = (
        keyed.join(before, "_key")
        .select("wanted_by", F.expr("substring(text, 1, wanted)").alias("start"), F.xxhash64("text").alias("h"))
        .groupBy("wanted_by")
        .agg(F.min_by("start", "h").alias("start"))
    )
    joined = keyed.join(starts, F.col("_key") == F.col("wanted_by"))
    n = F.length("text")
    quarter = (n / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("start"), F.lit(1), quarter)
    )
    return joined.select("_key", "text", edited.alias("edited"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last quarter replaced by the start of the next text.
    """
    keyed = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    before = stage(_followers(keyed), "followers")
    numbered = _edited(keyed, before).select(
        "_key",
        "text",
        "edited",
        # tells rows of one key apart inside the task that has them
        F.monotonically_increasing_id().alias("row"),
        F.length("text").cast("long").alias("n_chars"),
        F.xxhash64("text").alias("h"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    versions = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")),
    )
    both = numbered.withColumn("version", F.explode(versions)).select(
        "_key", "row", "n_chars", "h", "edited_sha256", "version.which", "version.body"
    )
    keys = ["_key", "row", "n_chars", "h", "edited_sha256"]
    vector = lambda which: _added(F.when(F.col("which") == which, F.col("vector")))
    summed = (
        _block_vectors(both, [*keys, "which"], "body")
        .groupBy(*keys)
        .agg(vector(0).alias("vector"), vector(1).alias("edited_vector"))
    )
    stored = stage(summed, "vectors")
    nexts = (
        stored.join(before, "_key").groupBy("wanted_by").agg(F.min_by("vector", "h").alias("next_vector"))
    )
    key_again = F.when(F.col("_key") != _NO_KEY, F.col("_key")).alias(key)
    return stored.join(nexts, F.col("_key") == F.col("wanted_by")).select(
        key_again,
        "n_chars",
        "edited_sha256",
        as_text(F.col("vector")).alias("fingerprint"),
        as_text(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )
