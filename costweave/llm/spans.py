"""Substring dedup over sliding spans of sentences.

A text is cut into sentences; one of more than ``LONG`` words is divided further at
words chosen by their hash, so the same passage is divided alike wherever it
stands. From every sentence a span runs over the next ones until it has
``MIN_WORDS`` words, two sentences at least. A span found in several documents
stays in the one with the smallest key, and one repeated in a document stays where
it stands first; sentences that any other span covers are removed.

Where that finds nothing, runs of ``RUN`` words are compared too. They start at the
smallest word hash of every ``WINDOW`` words, so of 50 words that two texts share one
run at least is in both, whatever the punctuation around them. A run found again is
cut out of its text under the same rule, unless a removed span reaches into it;
``n_removed`` counts the sentences that it shortens.

Span hashes are joined globally: counting combines before the shuffle, so a passage
that many documents share is one row for each task, and the join that returns the
verdicts is one that adaptive execution splits. A document hears only of the
hashes that it must lose, and finds their place again itself.

Defined results: a null text stays null and an empty one empty; a text shorter than
a span is never touched; rows with the same key, null included, count as one
document and keep what they share (null is the smallest key); repeated sentences
alone, below the length of a span, are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.llm.common import spare
from costweave.llm.text import Words, _power_tables, column, mix, returning, slices

LONG = 16
MIN_WORDS = 25
_CUT_MASK = np.uint64(7)
_NO_KEY = -(2**63)

# passages of WINDOW + RUN - 1 words and more are found by runs of words where no span is
WINDOW = 8
RUN = 43

_STOPS = np.zeros(256, bool)
_STOPS[[*b".!?"]] = True
_CLOSERS = [c.encode() for c in "\"')]}\u201d\u2019\u00bb\u300d\u300f\uff09"]
_WIDE_STOPS = [c.encode() for c in "\u3002\uff01\uff1f\uff0e\uff61"]


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, endings: list[bytes]) -> np.ndarray:
    """The length in bytes of the one of ``endings`` at the end of every word, or 0."""
    out = np.zeros(ends.size, np.int64)
    for e in endings:
        met = ends - starts >= len(e)
        for i, byte in enumerate(reversed(e)):
            met[met] = data[ends[met] - 1 - i] == byte
        out[met] = len(e)
    return out


def _stop(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a word ends a sentence, quotes and brackets behind the stop left aside."""
    ends = ends.copy()
    at = np.arange(ends.size)
    while at.size:
        closed = _endings(data, starts[at], ends[at], _CLOSERS)
        at, closed = at[closed > 0], closed[closed > 0]
        ends[at] -= closed
    out = (ends > starts) & _STOPS[data[np.maximum(ends, 1) - 1]]
    return out | (_endings(data, starts, ends, _WIDE_STOPS) > 0)


class Sentences:
    """Sentences and spans of a column of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.words = words = Words(data, offsets)
        n = words.starts.size
        owner = words.owner()
        ends = np.zeros(n, bool)
        if n:
            newlines = np.concatenate(([0], np.cumsum(data == 10)))
            upto = np.append(words.starts[1:], data.size)
            ends = _stop(data, words.starts, words.ends) | (newlines[upto] > newlines[words.ends])
            last = words.first[1:][words.counts > 0] - 1
            ends[last] = True
            bounds = ends.copy()
            sentence = np.concatenate(([0], np.cumsum(ends)[:-1]))
            length = np.bincount(sentence)[sentence]
            ends |= (length > LONG) & ((words.hashes & _CUT_MASK) == 0)
        last_word = np.flatnonzero(ends)
        first_word = np.concatenate(([0], last_word[:-1] + 1)) if n else last_word
        self.counts = np.bincount(owner[first_word], minlength=offsets.size - 1) if n else np.zeros(offsets.size - 1, np.int64)
        self.n_words = last_word - first_word + 1
        # a sentence reaches to the start of the next one, or to the end of its text
        self.starts = words.starts[first_word]
        of = np.repeat(np.arange(self.counts.size), self.counts)
        self.stops = np.append(self.starts[1:], 0)
        if n:
            final = np.cumsum(self.counts)[self.counts > 0] - 1
            self.stops[final] = offsets[1:][self.counts > 0]
        within = np.arange(n) - np.repeat(first_word, self.n_words)
        mixed = mix(words.hashes + within.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed)))
        self.hashes = sums[last_word + 1] - sums[first_word]
        self.first_word, self.last_word = first_word, last_word
        self._spans(of)
        self._runs(owner, bounds if n else ends)

    def _spans(self, of: np.ndarray) -> None:
        """For each sentence the last one of its span, and the span's hash; -1 where the text ends first."""
        n = self.n_words.size
        upto = np.cumsum(self.n_words)
        before = upto - self.n_words
        last = np.searchsorted(upto, before + MIN_WORDS, "left")
        last = np.maximum(last, np.arange(n) + 1)
        text_end = np.cumsum(self.counts)[of] - 1 if n else last
        self.last = np.where(last <= text_end, last, -1)
        power, inverse = _power_tables(n + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * power[:n])))
        at = np.arange(n)
        self.span = mix((sums[np.maximum(self.last, 0) + 1] - sums[at]) * inverse[at] + (self.last - at).astype(np.uint64))
        self.of = of


    def _runs(self, owner: np.ndarray, bounds: np.ndarray) -> None:
        """First words, texts and hashes of the runs of ``RUN`` words.

        A run starts at the word with the smallest hash of some ``WINDOW`` words, so equal
        passages have equal starts wherever they stand. Left out is a run in which a whole
        span stands between ends of sentences: that span is in every copy.
        """
        n = owner.size
        self.run_start = self.run_of = np.zeros(0, np.int64)
        self.run = np.zeros(0, np.uint64)
        if n < RUN:
            return
        rank = mix(self.words.hashes ^ np.uint64(0xA0761D6478BD642F))
        windows = np.lib.stride_tricks.sliding_window_view(rank, WINDOW)
        least = np.arange(n - WINDOW + 1) + windows.argmin(axis=1)
        least = least[owner[: n - WINDOW + 1] == owner[WINDOW - 1 :]]
        start = np.unique(least)
        start = start[start + RUN <= n]
        start = start[owner[start] == owner[start + RUN - 1]]
        # the first sentence that begins in the run by what stands in it, and its span
        after = np.append(np.flatnonzero(bounds), n - 1)
        begin = after[np.searchsorted(after, start)] + 1
        at = np.searchsorted(self.first_word, begin)
        known = at < self.last.size
        at = np.minimum(at, self.last.size - 1)
        last = self.last[at]
        # divided sentences count only when their end stands in the run, too
        to = np.where(last >= 0, self.last_word[last], n)
        end = after[np.minimum(np.searchsorted(after, to), after.size - 1)]
        start = start[~(known & (last >= 0) & (end < start + RUN - 1))]
        power, inverse = _power_tables(n + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.words.hashes * power[:n])))
        self.run_start, self.run_of = start, owner[start]
        self.run = mix((sums[start + RUN] - sums[start]) * inverse[start] + np.uint64(0x5851F42D4C957F2D))


@returning
def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            s = Sentences(*column(piece.column("text")))
            valid = s.last >= 0
            of = np.concatenate((s.of[valid], s.run_of)).astype(np.int64)
            span = np.concatenate((s.span[valid], s.run)).view(np.int64)
            key = piece.column("key").to_numpy(zero_copy_only=False)[of]
            rows = np.unique(np.stack((of, span)), axis=1, return_index=True)[1] if of.size else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(span[rows])], ["key", "span"])


def _again(of: np.ndarray, span: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Whether the same span was met before in the same text."""
    order = valid[np.lexsort((valid, span[valid], of[valid]))]
    again = np.zeros(span.size, bool)
    if order.size:
        again[order[1:]] = (span[order][1:] == span[order][:-1]) & (of[order][1:] == of[order][:-1])
    return again


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the stretches."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps)[:n] > 0


@returning
def _cut(batches: Iterator[pa.RecordBatch], names: list[str], lost_name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            data, offsets = column(piece.column("text"))
            s = Sentences(data, offsets)
            n = s.last.size
            lost = piece.column(lost_name)
            lost_of = np.repeat(np.arange(piece.num_rows), pc.fill_null(pc.list_value_length(lost), 0).to_numpy(zero_copy_only=False))
            lost_hash = pc.list_flatten(lost).to_numpy(zero_copy_only=False).astype(np.int64)
            span, run = s.span.view(np.int64), s.run.view(np.int64)
            again = _again(s.of, span, np.flatnonzero(s.last >= 0))
            run_again = _again(s.run_of, run, np.arange(run.size))
            ruled = np.zeros(n, bool)
            run_ruled = np.zeros(run.size, bool)
            if lost_hash.size:
                touched, first = np.unique(lost_of, return_index=True)
                for row, own in zip(touched.tolist(), np.split(lost_hash, first[1:])):
                    a, b = np.searchsorted(s.of, [row, row + 1])
                    ruled[a:b] = np.isin(span[a:b], own) & (s.last[a:b] >= 0)
                    a, b = np.searchsorted(s.run_of, [row, row + 1])
                    run_ruled[a:b] = np.isin(run[a:b], own)
            start = np.flatnonzero((again | ruled) & (s.last >= 0))
            removed = _covered(n, start, s.last[start] + 1)
            # a run counts where no span in it was removed
            n_words = s.words.starts.size
            gone = np.concatenate(([0], np.cumsum(np.repeat(removed, s.n_words))))
            alone = np.flatnonzero((run_again | run_ruled) & (gone[s.run_start + RUN] == gone[s.run_start]))
            lost_words = _covered(n_words, s.run_start[alone], s.run_start[alone] + RUN)
            cut = np.add.reduceat(lost_words, s.first_word) > 0 if n else removed
            removed_whole, removed = removed, removed | cut
            n_removed = np.bincount(s.of[removed], minlength=piece.num_rows)
            texts = piece.column("text").to_pylist()
            raw = data.tobytes()
            for row in np.flatnonzero(n_removed).tolist():
                a, b = np.searchsorted(s.of, [row, row + 1])
                keep = [raw[offsets[row] : s.starts[a]]]
                for i in range(a, b):
                    if cut[i]:
                        words = np.flatnonzero(~lost_words[s.first_word[i] : s.last_word[i] + 1]) + s.first_word[i]
                        keep += [
                            raw[s.words.starts[w] : s.words.starts[w + 1] if w < s.last_word[i] else s.stops[i]]
                            for w in words.tolist()
                        ]
                    elif not removed_whole[i]:
                        keep.append(raw[s.starts[i] : s.stops[i]])
                texts[row] = b"".join(keep).decode("utf-8").rstrip()
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(texts, pa.string()) if c == "text" else piece.column(c) for c in names],
                    pa.array(s.counts.astype(np.int64)),
                    pa.array(n_removed.astype(np.int64)),
                ],
                names=[*names, "n_sentences", "n_removed"],
            )


def dedup(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with repeated spans cut from ``text``, and ``n_sentences, n_removed``.

    ``key`` is an integer column.
    """
    whole = F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY))
    owner, gone = spare(docs, "__key", "__lost")
    spans = docs.select(whole.alias("key"), "text").mapInArrow(_hashed, "key long, span long")
    owners = spans.groupBy("span").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    lost = (
        spans.join(owners.select("span", "first"), "span")
        .where("key > first")
        .groupBy(F.col("key").alias(owner))
        .agg(F.collect_set("span").alias(gone))
    )
    names = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    joined = docs.select(*names).join(lost, whole == F.col(owner), "left").select(*names, gone)
    schema = T.StructType(
        [
            *[docs.schema[c] for c in names],
            T.StructField("n_sentences", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    return joined.mapInArrow(lambda batches: _cut(batches, names, gone), schema)
