"""Near-duplicates by BagMinHash: signatures of multisets, bands, exact verification.

A text is the multiset of its five-word shingles. A shingle owns a Poisson process over
(weight, time): its weight axis is divided into the blocks [0, 1), [1, 2), [2, 4),
[4, 8) and so on, and each block yields points at a rate in proportion to its width,
with a slot, a time and a weight. A shingle that occurs c times sees the points whose
weight is below c, so two texts see the same points as far as their counts agree, and
each slot keeps its earliest point: the chance that two texts keep the same one is
their weighted Jaccard similarity. Points later than the time by which a text has
filled its slots are never made, which is what makes it quick.

``BANDS`` bands of ``ROWS`` slots give candidates: at similarity 0.8 a pair shares none
with probability 3e-6. In a bucket everybody is compared with one leader, first the one
with the smallest key, then others of other classes, so copies are never expanded into
all pairs. Links make classes. What is then still in one bucket but in different
classes is compared exactly: in small buckets pair by pair, in larger ones by products
of incidence matrices, block by block, of which only links leave the task. So no
candidate that could join two classes is left out. Every link is verified by exact
multiset overlap.

Equal texts are one node from the start (a hash of 64 bits names a text).

Defined results: a null text, and one without words, is alone in its class; a text
of fewer than five words is one shingle; rows are returned one to one, with the
smallest key among the class as ``class_id`` (null where all keys of the class are
null); rows that share a key but not their text are judged apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm.common import spare
from costweave.llm.components import components
from costweave.llm.text import Words, column, mix, returning, seeded, slices
from costweave.session import stage

WIDTH = 5
THRESHOLD = 0.8
ROWS = 4
BANDS = 24
SLOTS = ROWS * BANDS
#: Rounds in which members of a bucket are compared with one leader.
ROUNDS = 3
#: Buckets of up to so many members are then compared pair by pair, larger ones in blocks.
SMALL = 24
BLOCK = 512
FEATURES = 4096

_STEP = np.uint64(0xD1342543DE82EF95)
_UNIT = 2.0**-53


def multisets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in order, their counts, and the text of each."""
    hashes, counts = Words(*column(texts, lower=True), "punctuation").shingles(WIDTH)
    of = np.repeat(np.arange(counts.size), counts)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    first = np.ones(hashes.size, bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(first)
    return hashes[at], np.diff(np.append(at, hashes.size)), of[at]


def signatures(shingles: np.ndarray, weights: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """The earliest point of every slot, a row for each text; rows without weight are zero."""
    out = np.zeros((texts, SLOTS), np.uint64)
    total = np.bincount(of, weights, minlength=texts)
    # blocks 0, 1, 2, ... of the weight axis begin at 0, 1, 2, 4, ...
    blocks = 1 + np.ceil(np.log2(weights)).astype(np.int64)
    element = np.repeat(np.arange(weights.size), blocks)
    block = np.arange(element.size) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.where(block > 0, 2.0 ** (block - 1), 0.0)
    width = np.maximum(begin, 1.0)
    seed = seeded(shingles[element] + block.astype(np.uint64) * _STEP, 3)
    of, most = of[element], weights[element]
    horizon = np.where(total > 0, (np.log(SLOTS) + 6) / np.maximum(total, 1), 0.0)
    open_texts = total > 0
    while open_texts.any():
        use = open_texts[of]
        best = np.full(texts * SLOTS, np.inf)
        mark = np.zeros(texts * SLOTS, np.uint64)
        g, doc, lo, wide, top = seed[use], of[use], begin[use], width[use], most[use]
        time = np.zeros(g.size)
        while g.size:
            g = mix(g + _STEP)
            time = time - np.log1p(-((g >> np.uint64(11)) * _UNIT)) / (SLOTS * wide)
            early = time <= horizon[doc]
            g, doc, lo, wide, top, time = g[early], doc[early], lo[early], wide[early], top[early], time[early]
            place = seeded(g, 5)
            seen = lo + wide * ((place >> np.uint64(20)) * 2.0**-44) < top
            slot = ((place & np.uint64(0xFFFFF)) * np.uint64(SLOTS) >> np.uint64(20)).astype(np.int64)
            cell = (doc * SLOTS + slot)[seen]
            before = best[cell]
            np.minimum.at(best, cell, time[seen])
            won = (time[seen] == best[cell]) & (time[seen] < before)
            mark[cell[won]] = place[seen][won]
        filled = np.isfinite(best.reshape(texts, SLOTS)).all(axis=1)
        done = open_texts & filled
        out[done] = mark.reshape(texts, SLOTS)[done]
        open_texts &= ~filled
        horizon = horizon * 2
    return out


def band_hashes(marks: np.ndarray) -> np.ndarray:
    """One hash for every band of every row."""
    rows = marks.reshape(marks.shape[0], BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, rows.shape[:2]).copy()
    for i in range(ROWS):
        h = mix(h * np.uint64(31) + rows[:, :, i])
    return h


@returning
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            shingles, weights, of = multisets(piece.column("text"))
            marks = signatures(shingles, weights, of, piece.num_rows)
            empty = np.bincount(of, minlength=piece.num_rows) == 0
            bands = band_hashes(marks).view(np.int64)
            lengths = np.where(empty, 0, BANDS)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"),
                    piece.column("node"),
                    pa.ListArray.from_arrays(offsets, pa.array(bands[~empty].reshape(-1))),
                ],
                ["key", "node", "bands"],
            )


def overlap(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of each pair of texts."""
    rows = len(a)
    left, right = multisets(a), multisets(b)
    h = np.concatenate((left[0], right[0]))
    w = np.concatenate((left[1], right[1])).astype(np.float64)
    of = np.concatenate((left[2], right[2]))
    order = np.lexsort((h, of))
    h, w, of = h[order], w[order], of[order]
    same = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    shared = np.bincount(of[1:][same], np.minimum(w[1:], w[:-1])[same], minlength=rows)
    either = np.bincount(of, w, minlength=rows) - shared
    return np.where(either > 0, shared / np.maximum(either, 1), 0.0)


@returning
def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text_a", 1 << 20):
            keep = pa.array(overlap(piece.column("text_a"), piece.column("text_b")) >= threshold)
            yield piece.select(["a", "b"]).append_column("linked", keep)


def _verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``a, b, linked`` for pairs of nodes; only texts that a pair names are moved."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.mapInArrow(lambda batches: _verified(batches, threshold), "a long, b long, linked boolean")


def _oldest_first(buckets: DataFrame) -> DataFrame:
    """Every member of a bucket with the member that has the smallest key, each pair once.

    Copies mostly follow their original, so this links most of what is linked.
    """
    first = buckets.groupBy("band").agg(
        F.min(F.struct("key", "node")).alias("least"), F.count("*").alias("members")
    )
    led = first.where("members > 1").select("band", F.col("least.node").alias("leader"))
    return _each_once(buckets.join(led, "band"))


def _leaders_of_others(mixed: DataFrame, salt: int) -> DataFrame:
    """Every member of a bucket of several classes with one leader of another class.

    The leader is the smallest node after flipping bits by the bucket's own hash: another
    one in every band, found by a minimum that combines before the shuffle.
    """
    flip = F.xxhash64(F.col("band"), F.lit(salt))
    leaders = mixed.groupBy("band").agg(
        F.min(F.struct(F.col("node").bitwiseXOR(flip).alias("order"), "node", F.col("label").alias("other"))).alias("l")
    )
    led = leaders.select("band", F.col("l.node").alias("leader"), F.col("l.other").alias("other"))
    return _each_once(mixed.join(led, "band").where("label != other"))


def _each_once(led: DataFrame) -> DataFrame:
    return (
        led.where("node != leader")
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        .distinct()
    )


def _texts_in_company(read: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """``node, text``, once each, of the nodes that share a bucket with another one."""
    shared = buckets.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    named = buckets.join(shared, "band", "left_semi").select("node").distinct()
    wanted = nodes.join(named, "node", "left_semi").select(
        F.col("node").alias("_node"), F.col("least_key").alias("_key")
    )
    same = (F.col("node") == F.col("_node")) & F.col("key").eqNullSafe(F.col("_key"))
    return read.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their class, of buckets that hold several classes."""
    classed = buckets.select("band", "node").join(labels, "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label")
    )
    mixed = classed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return classed.join(mixed.where("low < high").select("band"), "band")


def _pairs_across(mixed: DataFrame) -> DataFrame:
    """Pairs of different classes in buckets of at most ``SMALL`` members: so many for each at most."""
    sizes = mixed.groupBy("band").agg(F.count("*").alias("members"))
    small = mixed.join(sizes.where(F.col("members") <= SMALL).select("band"), "band")
    other = small.select("band", F.col("node").alias("b"), F.col("label").alias("other"))
    return (
        small.join(other, "band")
        .where("label < other")
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
        .distinct()
    )


def _links_in_blocks(mixed: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` between classes in the larger buckets, without making their pairs.

    A bucket is dealt into blocks of about ``BLOCK`` texts. Two blocks meet in a task, which
    multiplies their incidence matrices and returns only what reaches the threshold.
    """
    sizes = mixed.groupBy("band").agg(F.count("*").alias("members"))
    large = mixed.join(sizes.where(F.col("members") > SMALL), "band").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int")
    )
    own = F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int")
    met = large.withColumn("own", own).select(
        "band", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    )
    placed = met.select(
        "band", "node", "label", "own", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high")
    ).join(texts, "node")
    return (
        placed.groupBy("band", "low", "high")
        .applyInArrow(lambda t: _block_links(t, threshold), "a long, b long")
        .distinct()
    )


def _block_links(rows: pa.Table, threshold: float) -> pa.Table:
    label = rows.column("label").to_numpy()
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if (label == label[0]).all():
        return none
    shingles, weights, of = multisets(rows.column("text"))
    # the minimum of counts is a product once a shingle that occurs c times is c features
    level = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    feature = mix(np.repeat(shingles, weights) + level.astype(np.uint64) * _STEP)
    row = np.repeat(of, weights)
    size = np.bincount(row, minlength=rows.num_rows)
    _, number, times = np.unique(feature, return_inverse=True, return_counts=True)
    # a feature of one text is shared by none
    kept = times[number] > 1
    number = np.unique(number[kept], return_inverse=True)[1]
    row = row[kept]
    order = np.argsort(number, kind="stable")
    number, row = number[order], row[order]
    left = np.flatnonzero(rows.column("own").to_numpy() == rows.column("low")[0].as_py())
    right = np.flatnonzero(rows.column("own").to_numpy() == rows.column("high")[0].as_py())
    shared = np.zeros((left.size, right.size), np.float64)
    for start in range(0, int(number[-1]) + 1 if number.size else 0, FEATURES):
        a, z = np.searchsorted(number, [start, start + FEATURES])
        part = np.zeros((rows.num_rows, FEATURES), np.float32)
        part[row[a:z], number[a:z] - start] = 1
        shared += part[left] @ part[right].T
    either = size[left][:, None] + size[right][None, :] - shared
    linked = (shared >= threshold * either) & (label[left][:, None] != label[right][None, :]) & (shared > 0)
    i, j = np.nonzero(linked)
    node = rows.column("node").to_numpy()
    x, y = node[left[i]], node[right[j]]
    return pa.table({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})


def _with_links(links: DataFrame | None, labels: DataFrame | None, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and class labels with the (stored) links of another round."""
    if links is None:
        return more, components(more)
    if more.isEmpty():
        return links, labels
    return links.unionAll(more), stage(_merged(labels, more), "labels")


def _merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``labels`` after more links: only the classes that they join are looked at again."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    lifted = (
        more.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
        .where("a != b")
    )
    joined = components(lifted).select(F.col("node").alias("label"), F.col("label").alias("merged"))
    new = joined.select(F.col("label").alias("node"), F.col("merged").alias("label"))
    return (
        labels.join(joined, "label", "left")
        .select("node", F.coalesce("merged", "label").alias("label"))
        .unionByName(new.join(labels, "node", "left_anti"))
    )


def classes(docs: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key, class_id, n_copies, n_links, node, label``: the class of every row.

    ``n_copies`` counts rows with an equal text; ``node`` names the text and ``label`` the
    class. ``n_links`` counts the links of the text that the search verified, no more than
    it needed for the class: not all its near-duplicates, since texts that share a class
    already are not compared.
    """
    read = docs.select(F.col(key).alias("key"), F.xxhash64("text").alias("node"), "text")
    key_type = docs.schema[key].dataType.simpleString()
    signed = stage(read.mapInArrow(_signed, f"key {key_type}, node long, bands array<long>"), "signatures")
    # a text without words has no bands and stays alone
    worded = signed.where(F.size("bands") > 0)
    nodes = stage(
        worded.groupBy("node").agg(F.min("key").alias("least_key"), F.count("*").alias("n_copies")), "nodes"
    )
    # equal texts have equal bands, so they may meet before the shuffle
    buckets = stage(
        worded.select("node", "key", F.explode("bands").alias("band"))
        .groupBy("node", "band")
        .agg(F.min("key").alias("key")),
        "buckets",
    )
    texts = stage(_texts_in_company(read, nodes, buckets), "texts")
    links = labels = None
    for round_number in range(ROUNDS):
        if links is None:
            pairs = _oldest_first(buckets)
        else:
            pairs = _leaders_of_others(stage(_mixed(buckets, labels), "mixed"), round_number)
        pairs = stage(pairs, "pairs")
        more = stage(_verify(pairs, texts, threshold).where("linked"), "linked").select("a", "b")
        links, labels = _with_links(links, labels, more)
    mixed = stage(_mixed(buckets, labels), "mixed")
    small = _verify(_pairs_across(mixed), texts, threshold).where("linked").select("a", "b")
    large = _links_in_blocks(mixed, texts, threshold)
    links, labels = _with_links(links, labels, stage(small.unionAll(large).distinct(), "linked"))
    ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    classed = (
        nodes.join(labels, "node", "left")
        .join(degree, "node", "left")
        .select("node", "least_key", "n_copies", "n_links", F.coalesce("label", "node").alias("label"))
    )
    smallest = classed.groupBy("label").agg(F.min("least_key").alias("class_id"))
    named = classed.join(smallest, "label").select("node", "class_id", "n_copies", "n_links", "label")
    rows = signed.select("key", "node", (F.size("bands") > 0).alias("worded"))
    return rows.join(named.withColumn("worded", F.lit(True)), ["node", "worded"], "left").select(
        F.col("key").alias(key),
        F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "node",
        F.when(F.col("worded"), F.col("label")).otherwise(F.xxhash64("key", "node")).alias("label"),
    )


def representatives(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row for each class: the one with the smallest key.

    Of several such rows the one with the smallest text hash stays, and of rows equal in
    both, one. Texts without words are no copies of each other and all stay.
    """
    found = classes(docs, key).where(F.col(key).eqNullSafe(F.col("class_id")))
    kept = found.groupBy("label").agg(F.min(F.struct(F.col("node"), F.col(key).alias("key"))).alias("least"))
    digest = F.xxhash64(F.col(key), F.xxhash64("text"))
    (name,) = spare(docs, "_digest")
    return (
        docs.withColumn(name, digest)
        .join(kept.select(F.xxhash64("least.key", "least.node").alias(name)), name, "left_semi")
        .dropDuplicates([name])
        .select(*docs.columns)
    )
