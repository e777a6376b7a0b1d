"""Conversation repair, centroid clustering and byte dedup against brute force, and on awkward rows."""

import hashlib
import itertools
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from costweave.llm import clusters, repair, suffixes
from costweave.llm.queries import QUERIES

# ---- conversation repair -----------------------------------------------------------------

TURNS = "conv long, turn long, role string, text string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ended = text.rstrip(" \t\n\x0b\x0c\r")
        if not ended:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if ended[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Every edit string of up to one row more than needed, without a programme."""
    names = {"u": "user", "a": "assistant"}
    best = None
    found = [(0, "", "", ())]  # cost, letters, last initial, output
    limit = 4 * len(rows) + 6
    for i in range(len(rows) + 1):
        widened = list(found)
        layer = found
        for _ in range(2):
            layer = [
                (c + 3, a + "I", r, out + (f"{names[r]}:",))
                for c, a, last, out in layer for r in NEXT[last] if r != "s"
            ]
            widened += layer
        if i == len(rows):
            ends = [w for w in widened if w[2] in ("", "a")]
            best = min(ends, key=lambda w: w[:2])
            break
        _, role, text = rows[i]
        more = 3 if faults[i] == "truncated" else 0
        found = []
        for c, a, last, out in widened:
            found.append((c + 4, a + "D", last, out))
            if faults[i] in ("blank", "duplicate"):
                continue
            if role[:1] and role[:1] in NEXT[last]:
                found.append((c + more, a + "K", role[:1], out + (f"{role}:{text}",)))
            found += [(c + 3 + more, a + "R", r, out + (f"{names[r]}:{text}",)) for r in NEXT[last] if r != "s"]
        # nothing but costs that cannot win any more is left out
        low = min(w[0] for w in found)
        found = [w for w in found if w[0] <= min(low + 12, limit)]
    return best


def summary(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    cost, audit, _, out = cheapest(rows, faults)
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def some_turns(seed, conversations, longest):
    rng = random.Random(seed)
    return [
        (conv, rng.choice([t, t, t + 3, None]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
         rng.choice(["a.", "b!", "c", "", "  ", None, "no stop\n", "why? \t", "ends oddly? "]))
        for conv in [*range(conversations), None] for t in range(rng.randint(0, longest))
    ]


def test_repair_is_the_cheapest_and_least(spark):
    rows = some_turns(5, 60, 7)
    found = repair.digests(repair.edits(spark.createDataFrame(rows, TURNS))).collect()
    got = {r[0]: tuple(r[1:]) for r in found}
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append((rest[0], *(" " if v is None else v for v in rest[1:])))
    assert got == {conv: summary(v) for conv, v in by.items()}


def run_through(rows):
    """The streamed programme over rows of one conversation, without Spark."""
    now = repair._Conversation()
    out = []
    for row in rows:
        out += now.turn(SimpleNamespace(**row))
    return out + list(now.end())


def turn(i, role, fault=None, text=None):
    return {"turn": str(i), "role": role, "text": text or f"t{i}.", "fault": fault}


@pytest.mark.parametrize("sort", ["mixed", "blank", "same role"])
def test_spilled_turns_give_the_same_edits(monkeypatch, sort):
    rng = random.Random(1)
    rows = {
        "mixed": [turn(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice([None, None, "blank", "truncated"]))
                  for i in range(3000)],
        "blank": [turn(i, "user", "blank") for i in range(3000)],
        "same role": [turn(i, "user") for i in range(3001)],
    }[sort]
    whole = run_through(rows)
    monkeypatch.setattr(repair, "HELD", 2000)
    assert run_through(rows) == whole
    shown = "".join((e[2] or "?")[:1] for e in whole if e[1] != "D")
    assert shown == "" or shown.lstrip("s").replace("ua", "") == ""


def test_giant_conversation_holds_little(monkeypatch):
    monkeypatch.setattr(repair, "HELD", 100_000)
    most, now = 0, repair._Conversation()
    for i in range(20_000):
        for _ in now.turn(SimpleNamespace(**turn(i, ["user", "assistant"][i % 2], text="word " * 20 + "."))):
            pass
        most = max(most, now.before.size + now.since.size)
    assert most < 100_000


def test_edits_carry_the_texts(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes"), (2, 0, "assistant", "")]
    edits = repair.edits(spark.createDataFrame(rows, TURNS))
    got = {(r.conv, r.place): tuple(r)[2:] for r in edits.collect()}
    # an assistant between the two users, and an answer that ends openly
    assert "".join(got[1, i][0] for i in range(1, 5)) == "KIKK"
    assert sum(r[-1] for (c, _), r in got.items() if c == 1) == 6
    assert got[2, 1] == ("D", None, None, 0, "assistant", "blank", 4)
    kept = repair.repaired(edits).where("conv = 1").orderBy("place").collect()
    assert [r.role[:1] for r in kept] == list("uaua")


def test_repair_of_nothing_and_clashing_names(spark, tmp_path):
    empty = spark.createDataFrame([], TURNS)
    assert repair.digests(repair.edits(empty)).collect() == []
    # every turn dropped or awkward, ids null or repeated, names of results in the table
    rows = [(c, t, "user", "Hi.", "x", 5) for c in (None, 1, 2) for t in range(30)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, fault int")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert {r.conv_id for r in got} == {None, 1, 2} and all(r.duplicate > 15 for r in got)


def test_conversation_without_rows_after_damage(spark, tmp_path):
    frame = spark.range(200).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                                    F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    gone = got.where("audit = ''").collect()
    assert got.count() == 200 and gone
    assert all(r.cost == 0 and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in gone)


# ---- centroid clustering -----------------------------------------------------------------


def plain_search(x, centroids):
    distance = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centroids] for v in x]
    return [d.index(min(d)) for d in distance], [min(d) for d in distance]


@pytest.mark.parametrize("size", [3, 200, 10**6, 10**11])
def test_search_equals_all_distances(size):
    rng = np.random.default_rng(size % 97)
    for k in (1, 2, 8, 13):
        centroids = clusters._exact(rng.integers(-size, size + 1, (k, 5)).astype(object))
        x = rng.integers(-size, size + 1, (300, 5))
        x[:k] = centroids.astype(np.int64)  # ties of equal centroids and distance 0
        got = clusters._matched(clusters.Search(centroids), x)
        want = plain_search(x, centroids)
        assert got[0].tolist() == want[0] and [int(d) for d in got[1]] == want[1]


def test_search_rejects():
    """Far centroids never get an exact distance."""
    centroids = np.arange(64)[:, None] * np.full((64, 4), 1000)
    search = clusters.Search(centroids)
    seen = []
    x = centroids[[10, 40]] + 1
    search.centroids = search.centroids.view(type("Watched", (np.ndarray,), {
        "__getitem__": lambda self, i: (seen.append(np.size(i)), np.ndarray.__getitem__(self, i))[1]}))
    assert search.nearest(x)[0].tolist() == [10, 40]
    assert sum(seen) <= 6


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(n)]


def test_clusters_equal_plain_rounds(spark):
    rows = vectors(300)
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[6][1])]
    junk = [(900, None), (901, [1.0] * 5), (902, [None] + [0.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] * 6)]
    frame = spark.createDataFrame(rows + junk, "vec_id long, embedding array<double>")
    found, centroids = clusters.clustered(frame, size=6, k=4, rounds=5)
    x = [[int(np.floor(1024 * v)) for v in vec] for _, vec in rows]
    first = sorted(range(len(rows)), key=lambda i: (
        hashlib.sha256(f"3:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), x[i]))[:4]
    want = [x[i] for i in first]
    for _ in range(5):
        cluster, _ = plain_search(x, want)
        for c in range(4):
            mine = [x[i] for i in range(len(x)) if cluster[i] == c]
            want[c] = [sum(col) // len(mine) for col in zip(*mine)] if mine else want[c]
    cluster, distance = plain_search(x, want)
    assert centroids.tolist() == want
    total = {c: sum(d for d, o in zip(distance, cluster) if o == c) for c in range(4)}
    expected = [(rows[i][0], cluster[i], distance[i], total[cluster[i]], sum(distance)) for i in range(len(rows))]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_cluster_edges(spark):
    kind = "vec_id long, embedding array<double>, cluster string, distance int, row int"
    empty = spark.createDataFrame([], kind)
    assert clusters.clustered(empty)[0].collect() == []
    few = spark.createDataFrame([(1, [1.0, 2.0], "x", 1, 1), (2, [1.0, 2.0], "y", 2, 2)], kind)
    found = clusters.clustered(few, size=2)[0]
    assert [(r.cluster, r.distance) for r in found.collect()] == [(0, 0), (0, 0)]  # equal centroids: the smaller number
    wide = spark.createDataFrame([(i, [1e300 * (-1) ** i, 1e12], "", 0, 0) for i in range(4)], kind)
    assert {r.distance for r in clusters.clustered(wide, size=2, k=1)[0].collect()} <= {2**63 - 1}


# ---- byte dedup ----------------------------------------------------------------------------


def without_repeats(texts, span):
    count = {}
    for t in texts:
        for s in range(len(t) - span + 1):
            count[t[s : s + span]] = count.get(t[s : s + span], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - span + 1):
            if count[t[s : s + span]] > 1:
                gone[s : s + span] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def shuffled_texts(seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 900))) for _ in range(12)]
    texts = []
    for _ in range(50):
        x, y = rng.choice(base), rng.choice(base)
        a, b = sorted((rng.randint(0, len(x)), rng.randint(0, len(x))))
        texts.append(x[a:b] + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) + y[: rng.randint(0, len(y))])
    return texts + [None, "", "a" * 700, "ab" * 500, texts[0], texts[0], texts[1], "x" * 60]


@pytest.mark.parametrize("bucket, gram", [(1024, 16), (1024, 8), (2, 16), (2, 50)])
def test_byte_dedup_equals_definition(spark, monkeypatch, bucket, gram):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    texts = shuffled_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffixes.dedup(frame, span=50, gram=gram).collect()
    want = without_repeats([(t or "").encode() for t in texts], 50)
    assert {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in found} == dict(enumerate(want))


def test_suffixes_share_a_pointer_if_their_bytes_do():
    rng = np.random.default_rng(0)
    for depth in (8, 20, 33):
        data = rng.integers(0, 2, 400).astype(np.uint8)
        ends = np.sort(rng.choice(np.arange(1, 400), 5, replace=False)).tolist() + [400]
        left = np.array([next(e for e in ends if e > i) - i for i in range(400)])
        pointer = suffixes.equal_suffixes(data, left, depth)
        groups = {}
        for i in range(400):
            if left[i] < depth:
                assert pointer[i] == -1
            else:
                groups.setdefault(data[i : i + depth].tobytes(), set()).add(int(pointer[i]))
        assert all(len(g) == 1 for g in groups.values())
        assert len({g.pop() for g in groups.values()}) == len(groups)


def test_pieces_of_long_texts(monkeypatch):
    """Runs of texts in pieces: every start is in one run, equal texts give equal runs."""
    monkeypatch.setattr(suffixes, "PIECE", 300)
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (60, 2000, 40, 0, 90, 700, 55)]
    texts.append(texts[1])
    offsets = np.concatenate(([0], np.cumsum([t.size for t in texts])))
    data = np.concatenate(texts)
    got = {i: [] for i in range(len(texts))}
    for lo, hi, first, stop in suffixes._pieces(offsets, 50):
        upto = min(stop + 49, int(offsets[hi]))
        ends = offsets[lo + 1 : hi + 1] - first
        sizes = np.minimum(ends, stop - first) - np.maximum(offsets[lo:hi] - first, 0)
        found = suffixes.runs_of(data[first:upto], np.repeat(ends, sizes), 50, 16)
        for a, k, at, key, content in zip(*(found or ((), (), (), (), ()))):
            row = lo + int(np.searchsorted(ends, a, "right"))
            got[row].append((int(a + first - offsets[row]), int(k), int(at), int(key), int(content)))
    for i, t in enumerate(texts):
        starts = [s for a, k, *_ in got[i] for s in range(a, a + k)]
        assert sorted(starts) == list(range(max(t.size - 49, 0)))
    assert got[1] == got[7]


def test_byte_dedup_edges(spark):
    kind = "doc_id string, text string, kept int, t1 long, key int, bytes int"
    assert suffixes.dedup(spark.createDataFrame([], kind)).collect() == []
    long = "".join(random.Random(3).choices("abcdefgh ", k=1_200_000))
    rows = [(None, None, 1, 1, 1, 1), (None, "short", 1, 1, 1, 1), ("x", long, 1, 1, 1, 1), ("y", "z" + long[500_000:], 1, 1, 1, 1)]
    got = {r.doc_id: r for r in suffixes.dedup(spark.createDataFrame(rows, kind)).where("doc_id IS NOT NULL").collect()}
    assert bytes(got["x"].kept) == long[:500_000].encode() and got["x"].n_spans == 1
    assert bytes(got["y"].kept) == b"z" and got["y"].n_removed == 700_000


def test_frequent_passage_among_different_texts(spark):
    """A passage in very many texts is one bucket with as many sorts of runs."""
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(430))
    texts = ["".join(rng.choice("ijklm ") for _ in range(rng.randint(200, 500))) + passage
             + "".join(rng.choice("nopqr ") for _ in range(rng.randint(200, 500))) for _ in range(1500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffixes.dedup(frame).collect()
    assert all(r.n_spans == 1 and 430 <= r.n_removed < 460 and passage.encode() not in bytes(r.kept) for r in got)
