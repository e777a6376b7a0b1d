"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over
hashed byte n-grams says how far a text leans to the languages whose bit is one;
loss-weighted decoding picks the language whose codeword costs least.

The classifiers are log-odds of n-gram counts, so learning is one pass that sums
counts per language: a matrix of languages x ``2**FEATURE_BITS`` however large
the corpus. Prediction is one pass over the texts and moves nothing.

Defined results: a null text, or one without letters, is ``und`` with score 0 and
counts as ambiguous; so is every text when nothing could be learned. Ties go to
the language that sorts first. Rows are kept one to one, repeated rows and null
keys included; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.llm.text import LOWER, column, returning, slices

FEATURE_BITS = 16
ORDERS = (2, 3, 4)
UNDETERMINED = "und"
AMBIGUOUS_BELOW = 0.6
MAX_LANGUAGES = 1024

_RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)

# letters keep their byte, anything else in ASCII is a word boundary
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def features(data: np.ndarray) -> list[np.ndarray]:
    """For each n-gram order, the feature of the n-gram that starts at each byte.

    The array is padded with boundaries, so every order has one entry per byte.
    Runs of boundaries carry no information and are mapped to feature 0.
    """
    symbols = np.concatenate((_LETTERS[data], np.full(max(ORDERS), 32, np.uint8)))
    out = []
    code = symbols.astype(np.uint32)
    n = data.size
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            code = (code[: symbols.size - order + 1] << np.uint32(8)) | symbols[order - 1 :]
        if order in ORDERS:
            gram = code[:n]
            hashed = (gram * np.uint32(0x9E3779B1 + 2 * order)) >> np.uint32(32 - FEATURE_BITS)
            blank = (symbols[:n] == 32) & (symbols[1 : n + 1] == 32)
            out.append(np.where(blank, np.uint32(0), hashed))
    return out


def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """A codeword of +1/-1 for every language: all dichotomies for up to five, else random rows.

    Random codes are as long as 12 bits for every doubling of the languages, and the
    draw with the largest smallest distance out of some is taken.
    """
    if languages <= 2:
        return np.array([[1], [-1]], np.int8)[:languages]
    if languages <= 5:
        masks = np.arange(1, 2 ** (languages - 1))
        bits = (masks[None, :] >> np.arange(languages)[:, None]) & 1
        return (2 * bits - 1).astype(np.int8)
    length = 12 * int(np.ceil(np.log2(languages)))
    rng = np.random.default_rng(seed)
    best, distance = None, -1
    for _ in range(32):
        code = rng.integers(0, 2, (languages, length)) * 2 - 1
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        agree = code @ code.T
        np.fill_diagonal(agree, -length)
        if (far := int((code.shape[1] - agree.max()) // 2)) > distance:
            best, distance = code.astype(np.int8), far
    return best


@dataclass
class Model:
    """Languages, codewords and per-bit weights; at most a few MB whatever the corpus."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    importance: np.ndarray
    scale: np.ndarray

    def decode(self, lean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language index and probability-like score from the lean of each bit."""
        margin = self.code[None, :, :] * (lean * self.scale)[:, None, :]
        loss = (np.logaddexp(0, -margin) * self.importance).sum(axis=2)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        best = loss.argmin(axis=1)
        return best, likely[np.arange(best.size), best] / likely.sum(axis=1)


@returning
def _counted(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    table = np.zeros((len(languages), 1 << FEATURE_BITS), np.int64)
    at = {name: i for i, name in enumerate(languages)}
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            data, offsets = column(piece.column("text"))
            grams = features(data)
            row = np.array([at[x] for x in piece.column("lang").to_pylist()], np.int64)
            for i in np.unique(row):
                of = np.repeat(row == i, np.diff(offsets))
                for gram in grams:
                    table[i] += np.bincount(gram[of], minlength=table.shape[1])
    i, feature = np.nonzero(table)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.astype(np.int32)), pa.array(feature.astype(np.int32)), pa.array(table[i, feature])],
        ["language", "feature", "n"],
    )


def fit(docs: DataFrame) -> Model:
    """Learn from all rows of ``docs`` (text, lang) with a language."""
    known = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    languages = [r[0] for r in known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    languages.sort()
    if not languages:
        none = np.zeros(0)
        return Model([], np.zeros((0, 0), np.int8), np.zeros((0, 1 << FEATURE_BITS), np.float32), none, none)
    sums = (
        known.mapInArrow(lambda batches: _counted(batches, languages), "language int, feature int, n long")
        .groupBy("language", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros((len(languages), 1 << FEATURE_BITS))
    counts[sums["language"], sums["feature"]] = sums["n"]
    counts[:, 0] = 0
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    code = codebook(len(languages))
    yes, no = (code > 0).T.astype(float), (code < 0).T.astype(float)
    # each bit weighs its languages alike, so a rare language is no weaker than a common one
    log_odds = [
        np.log(w @ share / max(w.sum(), 1)) if w.sum() else np.zeros(share.shape[1]) for w in np.vstack((yes, no))
    ]
    bits = code.shape[1]
    weights = np.array([log_odds[b] - log_odds[bits + b] for b in range(bits)])
    weights[:, 0] = 0
    # how far a bit separates its two sides on average: weak bits count for less
    strength = np.abs((share @ weights.T) * code).mean(axis=0)
    importance = strength / strength.mean() if strength.mean() > 0 else np.ones(bits)
    scale = 6.0 / np.maximum(strength, 1e-6)
    return Model(languages, code, weights.astype(np.float32), importance, scale)


def _lettered(piece: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have a letter; Python looks only at texts whose sole candidates are not ASCII."""
    cumulated = lambda mask: np.concatenate(([0], np.cumsum(mask)))
    low = LOWER[data]
    ascii_letters = cumulated((low >= 97) & (low <= 122))
    wide = cumulated(data >= 128)
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    unsure = ~found & (wide[offsets[1:]] > wide[offsets[:-1]])
    for i in np.flatnonzero(unsure):
        found[i] = any(c.isalpha() for c in piece.column("text")[int(i)].as_py())
    return found


@returning
def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = np.array([*model.languages, UNDETERMINED], object)
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            data, offsets = column(piece.column("text"))
            sizes = np.diff(offsets)
            grams = features(data)
            informative = sum((g != 0).astype(np.int64) for g in grams)
            total = np.maximum(_summed(informative, offsets), 1)
            lean = np.zeros((sizes.size, model.code.shape[1]))
            for b in range(lean.shape[1]):
                weight = model.weights[b]
                value = weight[grams[0]]
                for g in grams[1:]:
                    value = value + weight[g]
                lean[:, b] = _summed(value.astype(np.float64), offsets) / total
            known = _lettered(piece, data, offsets)
            if model.languages:
                best, score = model.decode(lean)
            else:
                best, score, known = np.zeros(sizes.size, int), np.zeros(sizes.size), np.zeros(sizes.size, bool)
            best = np.where(known, best, len(model.languages))
            score = np.where(known, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(names[best], pa.string()), pa.array(score), pa.array(score < AMBIGUOUS_BELOW)],
                names=[*piece.schema.names, *_RESULT.names],
            )


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    kept = docs.drop(*_RESULT.names)
    schema = T.StructType([*kept.schema.fields, *_RESULT.fields])
    return kept.mapInArrow(lambda batches: _predicted(batches, model), schema)
