"""Language-model scoring with a weighted backoff automaton.

Every n-gram of the learning texts is a state. From the state of the last two words an
arc leads on for each word that has followed them, weighing the smoothed share of
that word; otherwise a failure arc, weighing what smoothing set aside, leads to the
state of the last word alone, and from there to the empty state. A text is read
once from left to right: the state is the longest known suffix, and the weights of
the arcs taken add up to its log-probability, the end of the text included.

Smoothing interpolates: a context seen c times trusts its counts by c / (c + a * c**b) and
leaves the rest to the shorter context. The empty state knows the learned words by
their frequency, discounted by the Good-Turing mass of words seen once, which is the
weight of the one arc for all unknown words.

The automaton is never in one place. Texts are dealt into chunks; a chunk asks for the
n-grams it contains, each once, and sends along how often its learning texts have
it. The requests are dealt by hash into buckets that sum the counts and answer in
the order of the request. So each chunk gets the states and arcs that its texts can
visit, and nothing grows but the number of chunks and buckets, which is
``spark.sql.shuffle.partitions``: set it so that a partition of the texts fits a task.
A common n-gram is one request of each chunk, so no bucket is hot.

Words are named by 64-bit hashes. Pairs and triples are named by 40 bits besides their
bucket: of the n-grams of a bucket about one in 10**5 shares its counts with another, at
every size of the corpus.

Defined results: a null text is an empty one and scores its end; ASCII letters are
lower-cased; repeated rows and keys are scored each; where nothing was learned, every
word is unknown; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costweave.llm.common import task_count
from costweave.llm.text import SLICE_BYTES, Words, column, give_back, mix, slices

ORDER = 3
END = np.uint64(0x5851F42D4C957F2D)
#: (a, b) of the trust in contexts of one and two words.
TRUST = {2: (20.0, 0.65), 3: (1.0, 0.8)}
_BITS = 40
_FACTOR = np.uint64(0x9FB21C651E98DF25)


@dataclass
class Totals:
    """What the empty state needs: learned tokens, distinct ones, and those seen once."""

    tokens: int
    distinct: int
    once: int

    @property
    def unknown(self) -> float:
        return (self.once + 0.5) / (self.tokens + 1.0)


class Tokens:
    """Tokens of some texts, an end after each, and the n-grams that end at every token."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        hashes, counts = [], []
        batch = pa.RecordBatch.from_arrays([texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts], ["text"])
        for piece in slices(batch, "text", SLICE_BYTES):
            words = Words(*column(piece.column("text")))
            hashes.append(words.hashes)
            counts.append(words.counts)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.counts = n + 1
        self.owner = np.repeat(np.arange(n.size), self.counts)
        self.token = np.full(words.size + n.size, END)
        self.token[np.arange(words.size) + np.repeat(np.arange(n.size), n)] = words
        self.first = np.cumsum(self.counts) - self.counts

    def grams(self, order: int) -> np.ndarray:
        # before a text stands the end of another, so its state is that of an end
        if order == 1:
            return self.token
        last = np.concatenate(([END], self.token[:-1]))[: self.token.size]
        if order == 2:
            return mix(last * _FACTOR + self.token)
        last2 = np.concatenate(([END, END], self.token[:-2]))[: self.token.size]
        last2[self.first] = END
        return mix(mix(last2 * _FACTOR + last) * _FACTOR + self.token)


@dataclass
class Deal:
    """How n-grams are named and dealt into buckets, in the order of their names."""

    buckets: int

    def name(self, grams: np.ndarray, order: int) -> np.ndarray:
        bits = 62 if order == 1 else _BITS + self.buckets.bit_length() - 1
        return grams >> np.uint64(64 - bits)

    def starts(self, order: int) -> np.ndarray:
        """The first name of each bucket, and the end of the last."""
        bits = 62 if order == 1 else _BITS + self.buckets.bit_length() - 1
        return np.array([-(-(b << bits) // self.buckets) for b in range(self.buckets + 1)], np.uint64)

    def pack(self, names: np.ndarray, start: np.uint64, order: int) -> bytes:
        # the names are sorted: gaps are short, and bytes of equal weight side by side compress
        gaps = np.diff(names, prepend=start)
        width = 8 if order == 1 else _BITS // 8
        return np.ascontiguousarray(gaps).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()

    def unpack(self, packed: bytes, start: np.uint64, order: int) -> np.ndarray:
        width = 8 if order == 1 else _BITS // 8
        planes = np.frombuffer(packed, np.uint8).reshape(width, -1)
        raw = np.zeros((planes.shape[1], 8), np.uint8)
        raw[:, :width] = planes.T
        return np.cumsum(raw.view(np.uint64).reshape(-1)) + start


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte each, and eight for every count that a byte cannot hold."""
    large = counts >= 255
    return np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype(np.int64).tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, np.int64, offset=n) if len(packed) > n else 0
    return counts


def _requested(texts: pa.Table, deal: Deal) -> pa.Table:
    tokens = Tokens(texts.column("text"))
    learned = ~texts.column("held_out").to_numpy()[tokens.owner]
    chunk = texts.column("chunk")[0].as_py()
    rows = []
    for order in range(1, ORDER + 1):
        # the lowest bit tells learning tokens, so one sort counts them
        keyed = np.sort(deal.name(tokens.grams(order), order) << np.uint64(1) | learned.astype(np.uint64))
        names = keyed >> np.uint64(1)
        at = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        counts = np.add.reduceat((keyed & np.uint64(1)).astype(np.int64), at)
        names = names[at]
        starts = deal.starts(order)
        edges = np.searchsorted(names, starts)
        for b in range(deal.buckets):
            a, z = edges[b], edges[b + 1]
            if z > a:
                rows.append((order, b, chunk, deal.pack(names[a:z], starts[b], order), pack_counts(counts[a:z])))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["order", "bucket", "chunk", "names", "counts"]
    )


def _answered(requests: pa.Table, deal: Deal) -> pa.Table:
    order, bucket = requests.column("order")[0].as_py(), requests.column("bucket")[0].as_py()
    start = deal.starts(order)[bucket]
    chunks = requests.column("chunk").to_pylist()
    names = [deal.unpack(x.as_py(), start, order) for x in requests.column("names")]
    counts = np.concatenate(
        [unpack_counts(x.as_py(), n.size) for x, n in zip(requests.column("counts"), names)]
    )
    sizes = [n.size for n in names]
    every = np.concatenate(names)
    by_name = np.argsort(every, kind="stable")
    every = every[by_name]
    at = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    sums = np.add.reduceat(counts[by_name], at)
    total = np.empty_like(counts)
    total[by_name] = np.repeat(sums, np.diff(np.append(at, every.size)))
    parts = np.split(total, np.cumsum(sizes)[:-1])
    return pa.table(
        [
            pa.array([order] * len(chunks), pa.int32()),
            pa.array([bucket] * len(chunks), pa.int32()),
            pa.array(chunks, pa.int32()),
            pa.array(sizes, pa.int32()),
            pa.array([pack_counts(p) for p in parts], pa.binary()),
        ],
        names=["order", "bucket", "chunk", "n", "totals"],
    )


def trust(seen: np.ndarray, order: int) -> np.ndarray:
    a, b = TRUST[order]
    c = np.maximum(seen, 1).astype(np.float64)
    return np.where(seen > 0, c / (c + a * c**b), 0.0)


@dataclass
class Automaton:
    """The states and arcs that the texts of a chunk can visit.

    State 0 is the empty one; then come the words, then the pairs of words. The arcs that
    read a word are numbered in the same way, single words first, pairs and triples after
    them: an arc named by an n-gram leaves the state of its first words. ``weight`` is NaN for an
    n-gram that was not learned, which is no arc. All weights are log10 probabilities.
    """

    order: np.ndarray  # of each state: how many words it remembers
    fail_to: np.ndarray
    fail: np.ndarray  # weight of the failure arc
    to: np.ndarray  # of each arc
    weight: np.ndarray
    start: int  # a text starts after an end


def build(counts: dict[int, np.ndarray], at: dict[int, np.ndarray], tokens: Tokens, totals: Totals) -> Automaton:
    """``counts`` holds the learned count of each n-gram of the chunk, ``at`` the n-gram that ends at each token."""
    words, pairs, triples = (counts[order].size for order in (1, 2, 3))
    ending = at[1][tokens.first + tokens.counts - 1][0]
    # the state before a token, by the n-gram that ends at the token before it
    word_before, pair_before = (np.concatenate(([0], at[order][:-1])) for order in (1, 2))
    word_before[tokens.first] = ending
    pair = {part: np.zeros(pairs, np.int32) for part in ("first", "last")}
    pair["first"][at[2]], pair["last"][at[2]] = word_before, at[1]
    # the state of a text's start remembers one word, so no arc of three words leaves it
    inner = np.ones(at[3].size, bool)
    inner[tokens.first] = False
    triple = {part: np.zeros(triples, np.int32) for part in ("first", "last")}
    triple["first"][at[3][inner]], triple["last"][at[3][inner]] = pair_before[inner], at[2][inner]

    known = {order: c > 0 for order, c in counts.items()}
    p = {1: np.where(known[1], (1 - totals.unknown) * counts[1] / max(totals.tokens, 1), totals.unknown)}
    trusted = {order: trust(counts[order - 1], order) for order in (2, 3)}
    for order, parts in ((2, pair), (3, triple)):
        t = trusted[order][parts["first"]]
        share = counts[order] / np.maximum(counts[order - 1][parts["first"]], 1)
        p[order] = t * share + (1 - t) * p[order - 1][parts["last"]]
    with np.errstate(divide="ignore", invalid="ignore"):
        log = {order: np.log10(np.where(known[order] | (order == 1), p[order], np.nan)) for order in p}
        fail = np.concatenate(([0.0], np.log10(1 - trusted[2]), np.log10(1 - trusted[3])))
    word_state = np.where(known[1], 1 + np.arange(words), 0)
    pair_state = np.where(known[2], 1 + words + np.arange(pairs), 0)
    return Automaton(
        order=np.repeat(np.arange(3, dtype=np.int8), (1, words, pairs)),
        fail_to=np.concatenate(([0], np.zeros(words, np.int64), word_state[pair["last"]])).astype(np.int32),
        fail=fail,
        to=np.concatenate((word_state, pair_state, pair_state[triple["last"]])).astype(np.int32),
        weight=np.concatenate((log[1], log[2], log[3])),
        start=int(word_state[ending]),
    )


#: Tokens of a text that are read in one go; a state remembers two words, so a walk can be
#: taken up anywhere by reading the two words before.
STRETCH = 512


def walk(automaton: Automaton, arcs: np.ndarray, tokens: Tokens) -> np.ndarray:
    """The log10 probability of every text, read from left to right, many texts abreast.

    ``arcs[order, i]`` is the arc by which token ``i`` leaves a state of ``order`` words. A
    reader takes it if it was learned, and otherwise the failure arc, whose weight it adds, until
    some arc reads the token; the empty state has an arc for every word. Long texts are
    read in stretches, each by its own reader, that starts two tokens earlier without adding.
    """
    pieces = -(-tokens.counts // STRETCH)
    text = np.repeat(np.arange(tokens.counts.size), pieces)
    place = np.arange(text.size) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = tokens.first[text] + place * STRETCH
    end = np.minimum(begin + STRETCH, (tokens.first + tokens.counts)[text])
    lead = np.where(place > 0, 2, 0)
    at = begin - lead
    # longest first: those still reading stay in front
    rank = np.argsort(at - end, kind="stable")
    at, end, begin, text = at[rank], end[rank], begin[rank], text[rank]
    state = np.where(at == begin, automaton.start, 0).astype(np.int32)
    score = np.zeros(at.size)
    lengths = end - at
    reading = np.searchsorted(-lengths, -np.arange(lengths[0] if lengths.size else 0), "left")
    for step, n in enumerate(reading.tolist()):
        i = at[:n] + step
        s = state[:n]
        gained = np.zeros(n)
        arc = arcs[automaton.order[s], i]
        weight = automaton.weight[arc]
        stuck = np.flatnonzero(np.isnan(weight))
        while stuck.size:
            left = s[stuck]
            gained[stuck] += automaton.fail[left]
            s[stuck] = automaton.fail_to[left]
            arc[stuck] = arcs[automaton.order[s[stuck]], i[stuck]]
            weight[stuck] = automaton.weight[arc[stuck]]
            stuck = stuck[np.isnan(weight[stuck])]
        state[:n] = automaton.to[arc]
        score[:n] += np.where(i >= begin[:n], gained + weight, 0.0)
    return np.bincount(text, score, minlength=tokens.counts.size)


def _scored(answers: pa.Table, texts: pa.Table, deal: Deal, totals: Totals, key: str) -> pa.Table:
    tokens = Tokens(texts.column("text"))
    where = np.array([answers.column("order").to_numpy(), answers.column("bucket").to_numpy()])
    counts, at = {}, {}
    for order in range(1, ORDER + 1):
        rows = np.flatnonzero(where[0] == order)
        rows = rows[np.argsort(where[1][rows])]
        counts[order] = np.concatenate(
            [unpack_counts(answers.column("totals")[r].as_py(), answers.column("n")[r].as_py()) for r in rows.tolist()]
        )
        at[order] = np.unique(deal.name(tokens.grams(order), order), return_inverse=True)[1].astype(np.int32)
    total = lambda x: np.bincount(tokens.owner, x, minlength=tokens.counts.size)
    known = counts[1][at[1]]
    base = total(np.log10(known + 1.0) - np.log10(totals.tokens + totals.distinct + 1.0))
    n_known = total(known > 0).astype(np.int64)
    del known
    automaton = build(counts, at, tokens, totals)
    shift = np.cumsum([0, counts[1].size, counts[2].size]).astype(np.int32)
    arcs = np.stack([at.pop(order) + shift[order - 1] for order in range(1, ORDER + 1)])
    return pa.table(
        [
            texts.column(key),
            texts.column("held_out"),
            pa.array(tokens.counts.astype(np.int64)),
            pa.array(n_known),
            pa.array(np.full(tokens.counts.size, totals.tokens, np.int64)),
            pa.array(base),
            pa.array(walk(automaton, arcs, tokens)),
        ],
        names=[key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text", 4 * SLICE_BYTES):
            token, n = np.unique(Tokens(piece.column("text")).token, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])


def _then_free(work, *args) -> pa.Table:
    """The result of ``work``; what its chunk took goes back to the system before the next one."""
    try:
        return work(*args)
    finally:
        give_back()


def learn_totals(texts: DataFrame) -> Totals:
    """Counts every learning token; only three sums come back."""
    per_token = texts.mapInArrow(_counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    tokens, distinct, once = per_token.agg(
        F.sum("n"), F.count("*"), F.count(F.when(F.col("n") == 1, 1))
    ).first()
    return Totals(tokens or 0, distinct, once)


def score(docs: DataFrame, held_out: Column, key: str = "doc_id") -> DataFrame:
    """Log10 probabilities of all texts, learned from the rows that are not ``held_out``."""
    texts = docs.select(key, held_out.alias("held_out"), "text")
    totals = learn_totals(texts.where("NOT held_out").select("text"))
    chunks = task_count(docs.sparkSession)
    deal = Deal(chunks)
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64(key, "text"), F.lit(chunks)).cast("int")).repartition(
        chunks, "chunk"
    )
    requests = dealt.groupBy("chunk").applyInArrow(
        lambda t: _then_free(_requested, t, deal), "order int, bucket int, chunk int, names binary, counts binary"
    )
    answers = requests.groupBy("order", "bucket").applyInArrow(
        lambda t: _then_free(_answered, t, deal), "order int, bucket int, chunk int, n int, totals binary"
    )
    key_type = docs.schema[key].dataType.simpleString()
    return (
        answers.groupBy("chunk")
        .cogroup(dealt.groupBy("chunk"))
        .applyInArrow(
            lambda a, t: _then_free(_scored, a, t, deal, totals, key),
            f"{key} {key_type}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
            " base_score double, score double",
        )
    )
