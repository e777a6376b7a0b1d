"""Substring dedup on bytes: buckets of a suffix array, refined by bucket pointers.

Every byte that lies in a string of ``span`` bytes which also starts anywhere else is
removed. Sorting all suffixes would shuffle a row for each byte, so three steps narrow
them down; none of them loses an equal pair:

1. *Initial buckets.* In every string of ``span`` bytes the q-gram with the smallest
   hash is its anchor. Equal strings have equal anchors at the same place, so a bucket
   is all strings of one anchor. Consecutive strings with the same anchor form a run,
   about one for each ``span / 2`` bytes; only runs are shuffled.
2. *Equal runs.* Runs of a bucket whose bytes are the same are counted with a map-side
   sum. Two or more: all their strings occur elsewhere. One of each sort stays as a
   witness for the others of its bucket.
3. *Refinement.* Buckets that hold different runs are dealt out, and in each task their
   suffixes are sorted: buckets of 8-byte q-grams first, then by the bucket pointers of
   the suffixes 8, 16, 32, ... bytes later. Each round uses the pointers that the round
   before refined, so the depth doubles until it is ``span``; suffixes alone in their
   bucket leave. Suffixes that still share a bucket are equal strings.

A bucket of step 3 with very many runs is cut beforehand: the strings of a run are
divided by their distance to the anchor, and the bytes which all strings of a part
share name the part's bucket. Equal strings meet again; parts end at single strings,
where a bucket holds one sort only, so no bucket has to be compared in one task.

Rows are named by 128 bits of hash of their text; rows with equal texts have equal
results. Run bytes are compared by 64-bit hashes inside a bucket, which is named by 64
bits of its own. Null texts are empty, and texts shorter than ``span`` keep everything.
Texts of any length are read in pieces of a megabyte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.llm import text as words
from costweave.llm.common import task_count
from costweave.session import stage

SPAN = 400
GRAM = 100
#: Bytes of text, or of runs, that a task works on at a time.
PIECE = 1 << 20
#: Different runs that a bucket may hold before it is cut.
BUCKET = 1024
#: Strings of a part when buckets are cut, round by round.
PARTS = (64, 8, 1)

_PLACE = np.uint64((1 << 24) - 1)
_RUN = "t1 long, t2 long, a long, k int"
_ANCHORED = f"key long, content long, {_RUN}, at int, n long"
_REGION = f"key long, {_RUN}, at int, known boolean, size long, bytes binary"
_CUT = f"key long, content long, {_RUN}, at int, known boolean, n long, bytes binary"

ROW = ["t1", "t2"]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` for every row; ``kept`` is binary.

    ``kept`` holds the bytes that are left, concatenated; ``n_spans`` counts the maximal
    removed runs. Repeated rows, also with a null key, each give a row. Other columns are
    left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", F.col("text").cast("binary").alias("bytes"), *_names("text"))
    spans = removed(rows.where(F.octet_length("bytes") >= span).select(*ROW, "bytes"), span, gram)
    listed = spans.groupBy(*ROW).agg(F.collect_list(F.struct("a", "k")).alias("spans"))
    out = (
        rows.join(listed, ROW, "left")
        .select(F.struct("key").alias("key"), "bytes", "spans")
        .mapInArrow(_take_out(span), f"key struct<key: {docs.schema[key].dataType.simpleString()}>, "
                    "n_bytes long, n_removed long, n_spans long, kept binary")
    )
    return out.select(F.col("key.key").alias(key), "n_bytes", "n_removed", "n_spans", "kept")


def removed(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``t1, t2, a, k``: stretches of ``k`` starts from byte ``a`` whose strings start elsewhere too.

    ``texts`` holds ``t1, t2`` (the name of the text) and ``bytes``, at least ``span`` of them.
    """
    runs = stage(texts.mapInArrow(_anchored(span, gram), _ANCHORED), "runs")
    # stretches that repeat inside one piece are known already
    found = [runs.where("key IS NULL").select(*ROW, "a", "k")]
    runs = runs.where("key IS NOT NULL")
    sorts = stage(
        runs.groupBy("key", "content").agg(F.sum("n").alias("n"), F.min(F.struct(*ROW, "a", "k", "at")).alias("first")),
        "sorts",
    )
    found.append(_of_repeated(runs, sorts))
    wanted = sorts.join(_mixed(sorts), "key").select(
        "key", "first.*", (F.col("n") > 1).alias("known"), "size"
    )
    asked = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("key", "a", "k", "at", "known", "size")).alias("asked"))
    regions = texts.join(asked, ROW).select(*ROW, "bytes", "asked").mapInArrow(_regions(span), _REGION)
    regions = stage(regions, "regions")
    for part in PARTS:
        large = regions.where(F.col("size") > BUCKET)
        if large.isEmpty():
            break
        found.append(_equal_strings(regions.where(F.col("size") <= BUCKET), span))
        cut = stage(large.mapInArrow(_cut(part, span), _CUT), "cut")
        place = [*ROW, "a"]
        sorts = stage(
            cut.groupBy("key", "content").agg(
                F.sum("n").alias("n"), F.max("known").alias("known"), F.min(F.struct(*place)).alias("first")
            ),
            "sorts",
        )
        found.append(_of_repeated(cut.where("NOT known"), sorts))
        kept = sorts.join(_mixed(sorts), "key").select(
            "key", "content", "first.*", ((F.col("n") > 1) | F.col("known")).alias("known"), "size"
        )
        regions = stage(
            cut.drop("known", "n").join(kept, ["key", "content", *place])
            .select("key", *ROW, "a", "k", "at", "known", "size", "bytes"),
            "regions",
        )
    found.append(_equal_strings(regions, span))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _names(text: str) -> list:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def _mixed(sorts: DataFrame) -> DataFrame:
    """``key, size``: buckets that hold more than one sort of run."""
    return sorts.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")


def _of_repeated(runs: DataFrame, sorts: DataFrame) -> DataFrame:
    """All runs of a sort that occurs more than once."""
    again = sorts.where("n > 1").select("key", "content")
    return runs.join(again, ["key", "content"], "left_semi").select(*ROW, "a", "k")


def _equal_strings(regions: DataFrame, span: int) -> DataFrame:
    """Refinement of buckets, each whole in one task; a task reads them piece by piece."""
    dealt = regions.drop("size", "at").repartition(task_count(regions.sparkSession), "key").sortWithinPartitions("key")
    return dealt.mapInArrow(_refined(span), _RUN)


# ---- step 1: anchors ------------------------------------------------------------------


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values, from block minima in both directions."""
    n = values.size
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs_of(data: np.ndarray, owner_ends: np.ndarray, span: int, gram: int):
    """Runs ``a, k, at, key, content`` of strings with one anchor.

    ``owner_ends`` has the end of the text of every byte that may start a string.
    """
    size = data.size
    power, inverse = words._power_tables(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(words._BYTES[data] * power[:size], out=sums[1:])
    grams = words.mix((sums[gram:] - sums[:-gram]) * inverse[: size - gram + 1])
    order = (grams & ~_PLACE) | np.arange(grams.size, dtype=np.uint64)
    anchor = (_sliding_min(order, span - gram + 1) & _PLACE).astype(np.int64)
    del order
    starts = np.flatnonzero(np.arange(owner_ends.size) + span <= owner_ends)
    if not starts.size:
        return None
    anchor = anchor[starts]
    new = np.ones(starts.size, bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    k = np.diff(np.append(first, starts.size))
    a, p = starts[first], anchor[first]
    end = a + k - 1 + span
    content = words.mix((sums[end] - sums[a]) * inverse[a] + k.astype(np.uint64) * words._ODD)
    return a, k, p - a, grams[p].view(np.int64), content.view(np.int64)


def _pieces(offsets: np.ndarray, span: int) -> Iterator[tuple[int, int, int, int]]:
    """``first row, end row, first byte, end of starts``: whole short texts, or a part of a long one.

    Long texts are cut at distances from their own start, so equal texts give equal runs.
    """
    row, rows = 0, offsets.size - 1
    while row < rows:
        size = offsets[row + 1] - offsets[row]
        if size > PIECE:
            for at in range(0, int(size) - span + 1, PIECE):
                stop = min(at + PIECE, int(size) - span + 1)
                yield row, row + 1, int(offsets[row]) + at, int(offsets[row]) + stop
            row += 1
            continue
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        # a long text ends the piece
        long = np.flatnonzero(np.diff(offsets[row : upto + 1]) > PIECE)
        upto = row + int(long[0]) if long.size else upto
        yield row, upto, int(offsets[row]), int(offsets[upto])
        row = upto


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _batch(columns: dict[str, np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_LONGS = {"t1": pa.int64(), "t2": pa.int64(), "a": pa.int64(), "k": pa.int32()}
_RUN_ARROW = pa.schema(_LONGS)
_ANCHORED_ARROW = pa.schema(
    {"key": pa.int64(), "content": pa.int64(), **_LONGS, "at": pa.int32(), "n": pa.int64()}
)


def _anchored(span: int, gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _binary(batch.column("bytes"))
            t1, t2 = (batch.column(c).to_numpy() for c in ROW)
            for lo, hi, first, stop in _pieces(offsets, span):
                upto = min(stop + span - 1, int(offsets[hi]))
                ends = offsets[lo + 1 : hi + 1] - first
                sizes = np.minimum(ends, stop - first) - np.maximum(offsets[lo:hi] - first, 0)
                found = runs_of(data[first:upto], np.repeat(ends, sizes), span, gram)
                if found is None:
                    continue
                a, k, at, key, content = found
                row = lo + np.searchsorted(ends, a, "right")
                a = a + first - offsets[row]
                yield _collapsed(t1[row], t2[row], row, a, k, at, key, content)

    return work


def _collapsed(t1, t2, row, a, k, at, key, content) -> pa.RecordBatch:
    """Runs of a piece; of those that occur several times in it one is left, with their number.

    Their stretches go out joined, without a key. A text that repeats a short period has a
    run for each period or byte, which leaves as one row here.
    """
    order = np.lexsort((content, key))
    new = np.ones(order.size, bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(content[order]) != 0)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, order.size))
    lead = order[first]
    again = np.sort(order[np.repeat(n > 1, n)])
    joins = np.zeros(again.size, bool)
    if again.size:
        joins[1:] = (np.diff(row[again]) == 0) & (a[again][1:] == (a + k)[again][:-1])
    heads = np.flatnonzero(~joins)
    long = np.add.reduceat(k[again], heads) if again.size else np.zeros(0, np.int64)
    head = again[heads]
    none, ones = head.size, lead.size
    columns = {
        "t1": np.concatenate((t1[lead], t1[head])),
        "t2": np.concatenate((t2[lead], t2[head])),
        "a": np.concatenate((a[lead], a[head])),
        "k": np.concatenate((k[lead], long)).astype(np.int32),
        "at": np.concatenate((at[lead], np.zeros(none, np.int64))).astype(np.int32),
        "n": np.concatenate((n, np.zeros(none, np.int64))),
    }
    known = np.concatenate((np.zeros(ones, bool), np.ones(none, bool)))
    columns["key"] = pa.array(np.concatenate((key[lead], np.zeros(none, np.int64))), pa.int64(), mask=known)
    columns["content"] = pa.array(np.concatenate((content[lead], np.zeros(none, np.int64))), pa.int64(), mask=known)
    return _batch(columns, _ANCHORED_ARROW)


# ---- the bytes of runs that are compared ------------------------------------------------

_REGION_ARROW = pa.schema(
    {"key": pa.int64(), **_LONGS, "at": pa.int32(), "known": pa.bool_(), "size": pa.int64(), "bytes": pa.binary()}
)
_CUT_ARROW = pa.schema(
    {"key": pa.int64(), "content": pa.int64(), **_LONGS, "at": pa.int32(), "known": pa.bool_(), "n": pa.int64(),
     "bytes": pa.binary()}
)


def _sent(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about ``PIECE`` bytes; the last field of a row holds the bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 64
        if size > PIECE:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _regions(span: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen = None
        for batch in batches:
            texts = batch.column("bytes")
            names = zip(*(batch.column(c).to_pylist() for c in ROW))
            for i, name in enumerate(names):
                if name == seen:  # equal texts stand together
                    continue
                seen = name
                text = memoryview(texts[i].as_buffer())
                for r in batch.column("asked")[i].as_py():
                    a, k = r["a"], r["k"]
                    yield r["key"], *name, a, k, r["at"], r["known"], r["size"], bytes(text[a : a + k - 1 + span])

    return lambda batches: _sent(rows(batches), _REGION_ARROW)


def _name64(*parts: bytes) -> int:
    digest = hashlib.blake2b(digest_size=8)
    for part in parts:
        digest.update(part)
    return int.from_bytes(digest.digest(), "big", signed=True)


def _cut(part: int, span: int):
    """Runs divided by distance to the anchor, ``part`` distances each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("key", "t1", "t2", "a", "k", "at", "known", "bytes")}
                data, at, k = r["bytes"], r["at"], r["k"]
                for o in range(max(at - k + 1, 0) // part, at // part + 1):
                    low = max(at - (o + 1) * part + 1, 0)
                    high = min(at - o * part, k - 1)
                    # what every string at these distances holds, whichever of them this run has
                    core = data[at - o * part : max(at - (o + 1) * part + 1 + span, 0)]
                    mine = data[low : high + span]
                    head = b"%d %d %d " % (r["key"], o, part)
                    content = _name64(b"%d " % (at - low), mine)
                    yield (_name64(head, core), content, r["t1"], r["t2"], r["a"] + low, high - low + 1,
                           at - low, r["known"], 1, mine)

    return lambda batches: _sent(rows(batches), _CUT_ARROW)


# ---- step 3: refinement by bucket pointers ----------------------------------------------

_FIRST = 8


def equal_suffixes(data: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The bucket pointer of every suffix with at least ``depth`` bytes ``left``; else -1.

    Two suffixes share a pointer exactly if their first ``depth`` bytes are equal.
    A pointer is the place of the bucket's first suffix in the array of sorted suffixes.
    """
    size = data.size
    padded = np.concatenate((data, np.zeros(_FIRST, np.uint8)))
    grams = np.lib.stride_tricks.sliding_window_view(padded, _FIRST)[:size].copy().view(">u8").ravel()
    array = np.flatnonzero(left >= _FIRST)
    grams = grams[array].astype(np.uint64)
    order = np.argsort(grams, kind="stable")
    array, grams = array[order], grams[order]
    pointer = np.full(size, -1, np.int64)
    active = np.arange(array.size)
    new = np.ones(array.size, bool)
    new[1:] = grams[1:] != grams[:-1]
    reached = _FIRST
    while True:
        bucket = active[np.flatnonzero(new)[np.cumsum(new) - 1]]
        pointer[array[active]] = bucket
        if reached >= depth:
            break
        # suffixes that share their bucket and are long enough go on
        alone = new & np.append(new[1:], True)
        later = min(reached, depth - reached)
        on = ~alone & (left[array[active]] >= reached + later)
        active, bucket = active[on], bucket[on]
        if not active.size:
            break
        suffix = array[active]
        rank = bucket * np.int64(array.size + 1) + pointer[suffix + later]
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        array[active] = suffix[order]
        new = np.ones(active.size, bool)
        new[1:] = rank[1:] != rank[:-1]
        reached += later
    pointer[left < depth] = -1
    return pointer


def _refined(span: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            lengths = np.diff(_binary(batch.column("bytes"))[1])
            cuts = np.flatnonzero(np.diff(keys)) + 1
            edges = [0, *cuts.tolist(), len(keys)]
            begin = 0
            for x, y in zip(edges, edges[1:]):
                if x or (held and held[-1].column("key")[-1].as_py() != keys[0]):
                    if size > PIECE:  # the next bucket starts a new piece
                        if x > begin:
                            held.append(batch.slice(begin, x - begin))
                        yield from _repeats(held, span)
                        held, size, begin = [], 0, x
                size += int(lengths[x:y].sum())
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        yield from _repeats(held, span)

    return work


def _repeats(held: list[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    t1, t2, a, k, known = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2", "a", "k", "known"))
    data, offsets = _binary(rows.column("bytes"))
    # a run that was sent twice, from two parts of a large join, is one run
    order = np.lexsort((a, t2, t1))
    twice = np.zeros(a.size, bool)
    twice[order[1:]] = (np.diff(a[order]) == 0) & (np.diff(t1[order]) == 0) & (np.diff(t2[order]) == 0)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(data.size)
    pointer = equal_suffixes(data, left, span)
    starts = (np.arange(data.size) - np.repeat(offsets[:-1], np.diff(offsets))) < np.repeat(k, np.diff(offsets))
    starts &= ~np.repeat(twice, np.diff(offsets))
    at = np.flatnonzero(starts)
    bucket = pointer[at]
    shared = np.bincount(bucket)[bucket] > 1
    owner = np.searchsorted(offsets, at, "right") - 1
    hit = shared & ~known[owner]
    at, owner = at[hit], owner[hit]
    if not at.size:
        return
    new = np.ones(at.size, bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(owner) != 0)
    first = np.flatnonzero(new)
    own = owner[first]
    yield _batch(
        {"t1": t1[own], "t2": t2[own], "a": a[own] + at[first] - offsets[own],
         "k": np.diff(np.append(first, at.size)).astype(np.int32)},
        _RUN_ARROW,
    )


# ---- the result -------------------------------------------------------------------------

_KEPT = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.large_binary())]


def without(text: bytes, spans: np.ndarray | None, span: int) -> tuple[int, int, bytes]:
    """``n_removed, n_spans, kept`` of a text; ``spans`` holds pairs of start and number of starts."""
    if spans is None or not len(spans):
        return 0, 0, text
    begin, order = np.sort(spans[:, 0]), np.argsort(spans[:, 0], kind="stable")
    reach = np.maximum.accumulate((spans[:, 0] + spans[:, 1] - 1 + span)[order])
    new = np.ones(begin.size, bool)
    new[1:] = begin[1:] > reach[:-1]
    first = np.flatnonzero(new)
    begin, end = begin[first], reach[np.append(first[1:], reach.size) - 1]
    edges = np.concatenate(([0], np.column_stack((begin, end)).ravel(), [len(text)]))
    view = memoryview(text)
    kept = b"".join(view[x:y] for x, y in edges.reshape(-1, 2).tolist())
    return int((end - begin).sum()), int(begin.size), kept


def _take_out(span: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step, sizes = 0, np.diff(_binary(batch.column("bytes"))[1]) if batch.num_rows else np.zeros(0, int)
            group = np.cumsum(sizes) // (4 * PIECE)
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for x, y in zip(edges, edges[1:]):
                if x == y:
                    continue
                out = []
                for i in range(x, y):
                    text, spans = batch.column("bytes")[i].as_py(), batch.column("spans")[i]
                    pairs = None
                    if spans.is_valid:
                        inner = spans.values
                        pairs = np.column_stack([inner.field(c).to_numpy().astype(np.int64) for c in ("a", "k")])
                    out.append((len(text), *without(text, pairs, span)))
                step = y
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*out), _KEPT)]
                columns[-1] = columns[-1].cast(pa.binary())
                yield pa.record_batch([batch.column("key").slice(x, y - x), *columns], names=["key", *(n for n, _ in _KEPT)])

    return work
