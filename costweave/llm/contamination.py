"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is short and a document is long, so their Jaccard similarity says nothing;
what counts is how much of the item the document holds. Items are partitioned by
their number of distinct shingles. Each keeps a MinHash sketch of its smallest
hashes, and a document is a candidate when it holds a sketched shingle. A class
of items of up to u shingles keeps floor((1 - threshold) * u) + 1 of them: an
item of which the threshold is present cannot have lost them all, so no document
is missed. Candidates are verified by exact containment of the item's shingles.

Items are searched in blocks of at most about ``BLOCK`` shingles, each against all
documents; a block is the only thing sent to the tasks. Documents are not moved.

Defined results: a null text, or one without words, contains nothing and is
contained in nothing; a text of fewer than five words is one shingle, so a shorter
item is found only in an equal text; repeated rows and keys are each reported; of
items with the same key, every text is searched; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from costweave.llm.common import spare
from costweave.llm.text import Words, column, returning, seeded, slices
from costweave.session import stage

WIDTH = 5
THRESHOLD = 0.8
BLOCK = 1_000_000
_FILTER_BITS = 22


@returning
def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            hashes, counts = Words(*column(piece.column("text"), lower=True), "punctuation").shingles(WIDTH)
            parts = [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("item_id"),
                    pa.array([p.size for p in parts], pa.int64()),
                    pa.array([p.view(np.int64) for p in parts], pa.list_(pa.int64())),
                ],
                ["item_id", "n_shingles", "shingles"],
            )


@dataclass
class Block:
    """Items laid end to end, the sketch of all, and a bit filter for it."""

    ids: np.ndarray
    sizes: np.ndarray
    shingles: np.ndarray
    needed: np.ndarray
    sketch: np.ndarray
    sketch_item: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, ids: list, sets: list[np.ndarray], threshold: float) -> Block:
        sizes = np.array([s.size for s in sets], np.int64)
        # size classes are powers of two; a class is sketched for its largest item
        bound = np.minimum(1 << np.ceil(np.log2(sizes)).astype(np.int64), sizes.max())
        # whole shingles may be missing; the small number guards against 0.2 * 5 = 0.999...
        length = np.floor((1 - threshold) * bound + 1e-9).astype(np.int64) + 1
        smallest = [s[np.argsort(seeded(s, 11))[:k]] for s, k in zip(sets, length)]
        sketch = np.concatenate(smallest)
        item = np.repeat(np.arange(len(sets)), [s.size for s in smallest])
        order = np.argsort(sketch, kind="stable")
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[sketch >> np.uint64(64 - _FILTER_BITS)] = True
        needed = np.ceil(threshold * sizes - 1e-9).astype(np.int64)
        return cls(np.array(ids), sizes, np.concatenate(sets), needed, sketch[order], item[order], bits)

    def search(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Document, item and number of shingles found, for every pair at the threshold."""
        maybe = np.flatnonzero(self.bits[hashes >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.sketch, hashes[maybe], "left")
        high = np.searchsorted(self.sketch, hashes[maybe], "right")
        ends = np.cumsum(counts)
        doc = np.searchsorted(ends, maybe, "right")
        pairs = np.unique(
            np.repeat(doc, high - low) * self.sizes.size
            + self.sketch_item[np.repeat(low - np.concatenate(([0], np.cumsum(high - low)[:-1])), high - low) + np.arange((high - low).sum())]
        )
        item_ends = np.cumsum(self.sizes)
        known, held = -1, None
        for pair in pairs.tolist():
            d, i = divmod(pair, self.sizes.size)
            if d != known:
                known, held = d, np.unique(hashes[ends[d] - counts[d] : ends[d]])
            own = self.shingles[item_ends[i] - self.sizes[i] : item_ends[i]]
            at = np.searchsorted(held, own)
            found = int((held[np.minimum(at, held.size - 1)] == own).sum())
            if found >= self.needed[i]:
                yield d, i, found


@returning
def _searched(batches: Iterator[pa.RecordBatch], key: str, block: Block, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            hashes, counts = Words(*column(piece.column("text"), lower=True), "punctuation").shingles(WIDTH)
            hits = list(block.search(hashes, counts))
            doc = np.array([h[0] for h in hits], np.int64)
            item = np.array([h[1] for h in hits], np.int64)
            found = np.array([h[2] for h in hits], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(key).take(pa.array(doc)),
                    pa.array(block.ids[item].tolist() if hits else [], kind),
                    pa.array(block.sizes[item]),
                    pa.array(found),
                    pa.array(found / block.sizes[item]),
                ],
                [key, "item_id", "n_shingles", "n_found", "containment"],
            )


def contained(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """``key, item_id, n_shingles, n_found, containment`` of every item held by a document."""
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    key_type = docs.schema[key].dataType.simpleString()
    items = stage(
        benchmark.select("item_id", "text").mapInArrow(
            _item_shingles, f"item_id {id_type}, n_shingles long, shingles array<long>"
        ).where("n_shingles > 0"),
        "item_shingles",
    )
    total = items.agg(F.sum("n_shingles")).first()[0] or 0
    schema = f"{key} {key_type}, item_id {id_type}, n_shingles long, n_found long, containment double"
    blocks = -(-total // block)
    kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    parts = []
    for number in range(blocks):
        # dealt by id and shingles: items without an id, or with a common one, share no block
        rows = items.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == number).select("item_id", "shingles").collect()
        if not rows:
            continue
        own = Block.of(
            [r[0] for r in rows], [np.array(r[1], np.int64).view(np.uint64) for r in rows], threshold
        )
        sent = docs.sparkSession.sparkContext.broadcast(own)
        parts.append(
            docs.select(key, "text").mapInArrow(
                lambda batches, sent=sent: _searched(batches, key, sent.value, kind), schema
            )
        )
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item.

    Rows are matched by a hash of key and text, so rows that share a key are judged apart.
    """
    digest = F.xxhash64(F.col(key), F.col("text"))
    (name,) = spare(docs, "_digest")
    found = contained(docs.select(digest.alias(name), "text"), benchmark, name)
    return (
        docs.withColumn(name, digest)
        .join(found.select(name).distinct(), name, "left_anti")
        .select(*docs.columns)
    )
