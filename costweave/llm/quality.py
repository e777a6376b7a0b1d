"""Quality classifier: hashed word n-gram logistic regression, learned by FTRL-proximal.

Features are hashed words, pairs of words, and pairs of word shapes (the kinds of
characters a word is made of, and whether it repeats the word before), each text's vector scaled to unit length. Learning
reads at most about ``SAMPLE`` labelled keys, drawn by their hash, with one text each; the
sample is dealt to ``SHARDS`` tasks that each follow the regularised leader over
their rows, and the shards' weights are averaged. Scores are sparse dot products
in one pass that moves nothing.

Defined results: a null or empty text has no features and scores by the bias alone; when
no row has a label every score is 0.5. Labels other than 0 and 1 are not learned
from. A key with several labels is learned once for each of them, however often it is
repeated, with the text of the smallest hash if it has several. Rows are kept one to one;
columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.llm.text import Words, column, mix, slices
from costweave.session import lookup

FEATURE_BITS = 18
SAMPLE = 16_384
SHARDS = 8
EPOCHS = 3
THRESHOLD = 0.7

ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1

_RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

# kinds of bytes: lower, upper, digit, beyond ASCII, full stop or comma, any other mark
_KIND = np.full(256, 5, np.uint8)
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[128:] = 3
_KIND[[*b".,"]] = 4


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts one after the other, and how many each text has."""
    words = Words(data, offsets)
    owner = words.owner()
    kinds = np.zeros(words.hashes.size, np.uint64)
    flags = np.uint64(1) << _KIND.astype(np.uint64)
    flag = flags[data]
    if kinds.size:
        kinds = np.bitwise_or.reduceat(np.append(flag, np.uint64(0)), _edges(words))[::2]
    last = np.where(words.ends > words.starts, data[words.ends - 1], 0).astype(np.uint64) if kinds.size else kinds
    is_mark = (_KIND[last.astype(np.uint8)] >= 4).astype(np.uint64)
    shape = kinds * np.uint64(257) + last * is_mark
    pairs = owner[1:] == owner[:-1]
    # whether a word repeats the one before tells looping text
    again = (words.hashes[1:] == words.hashes[:-1]).astype(np.uint64)
    groups = [
        (words.hashes, owner),
        ((words.hashes[:-1] * np.uint64(3) + words.hashes[1:])[pairs], owner[1:][pairs]),
        (mix(shape + np.uint64(1 << 40)), owner),
        (mix(shape[:-1] * np.uint64(1 << 20) + shape[1:] + again * np.uint64(1 << 50) + np.uint64(1 << 41))[pairs], owner[1:][pairs]),
    ]
    number = np.concatenate([(mix(h) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64) for h, _ in groups])
    of = np.concatenate([o for _, o in groups])
    order = np.argsort(of, kind="stable")
    return number[order], np.bincount(of, minlength=offsets.size - 1)


def _edges(words: Words) -> np.ndarray:
    edges = np.empty(2 * words.starts.size, np.int64)
    edges[0::2], edges[1::2] = words.starts, words.ends
    return edges


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Leader:
    """FTRL-proximal state; weights follow from the sums and are zero while a sum is small."""

    def __init__(self):
        self.z = np.zeros((1 << FEATURE_BITS) + 1)
        self.n = np.zeros((1 << FEATURE_BITS) + 1)

    def weights(self, at=slice(None)):
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (_sigmoid(float(w @ value)) - label) * value
        n = self.n[at]
        sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient**2


def _vector(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(numbers, return_counts=True)
    value = np.log1p(count)
    norm = np.sqrt((value**2).sum()) or 1.0
    # the bias is the last entry
    return np.append(at, 1 << FEATURE_BITS), np.append(value / norm * 4.0, 1.0)


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["draw", "text"], na_position="first")
    data, offsets = column(pa.array(rows["text"], pa.string()))
    numbers, counts = features(data, offsets)
    ends = np.cumsum(counts)
    vectors = [_vector(numbers[e - c : e]) for e, c in zip(ends, counts)]
    leader = Leader()
    for _ in range(EPOCHS):
        for (at, value), label in zip(vectors, rows["quality"]):
            leader.learn(at, value, int(label))
    w = leader.weights()
    at = np.flatnonzero(w)
    return pd.DataFrame({"feature": at, "weight": w[at]})


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from labelled texts, at most about ``sample`` of them."""
    usable = labels.select(key, "quality").where(F.col(key).isNotNull() & F.col("quality").isin(0, 1)).distinct()
    total = usable.count()
    weights = np.zeros((1 << FEATURE_BITS) + 1)
    if not total:
        return weights
    draw = F.xxhash64(F.lit(17), F.col(key))
    share = min(1.0, sample / total)
    drawn = usable.withColumn("draw", draw).where(
        (F.pmod(F.col("draw"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else F.lit(True)
    )
    # distinct keys: the sample is bounded, so it may travel to the texts; copies of a key end in the map tasks
    texts = (
        docs.select(key, "text")
        .join(lookup(drawn), key)
        .groupBy(key, "quality", "draw")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    shards = max(1, min(SHARDS, total // 512))
    sums = (
        texts.withColumn("shard", F.pmod(F.hash(F.lit(5), key), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(_shard, "feature long, weight double")
        .groupBy("feature")
        .agg(F.sum("weight").alias("weight"))
        .toPandas()
    )
    weights[sums["feature"]] = sums["weight"] / shards
    return weights


def _scored(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    bias = weights[-1]
    for batch in batches:
        for piece in slices(batch, "text", 2 << 20):
            numbers, counts = features(*column(piece.column("text")))
            ends = np.cumsum(counts)
            # a feature's value depends on its count in the text, so count first
            keyed = np.repeat(np.arange(counts.size, dtype=np.int64), counts) << FEATURE_BITS | numbers
            distinct, times = np.unique(keyed, return_counts=True)
            value = np.log1p(times)
            owner = distinct >> FEATURE_BITS
            norm = np.sqrt(np.bincount(owner, value**2, minlength=ends.size))
            dot = np.bincount(owner, value * weights[distinct & ((1 << FEATURE_BITS) - 1)], minlength=ends.size)
            score = _sigmoid(bias + 4.0 * dot / np.where(norm > 0, norm, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=[*piece.schema.names, *_RESULT.names],
            )


def predict(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on)."""
    kept = docs.drop(*_RESULT.names)
    schema = T.StructType([*kept.schema.fields, *_RESULT.fields])
    return kept.mapInArrow(lambda batches: _scored(batches, weights), schema)
