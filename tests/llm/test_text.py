import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from costweave.llm import text
from costweave.llm.text import Words, column, runs, slices

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t., z"), st.text()), max_size=8)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_the_pattern(values):
    data, offsets = column(pa.array(values, pa.string()))
    words = Words(data, offsets)
    expected = [re.findall(r"[^\x20\x09-\x0D]+", v or "") for v in values]
    assert words.counts.tolist() == [len(e) for e in expected]
    raw = data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for e in expected for w in e]
    fold = lambda w: "".join(c.lower() if c < "\x80" else c for c in w)
    names = {}
    for w, h in zip(found, words.hashes.tolist()):
        assert names.setdefault(fold(w), h) == h
    assert len(set(names.values())) == len(names)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=6), st.integers(1, 5))
def test_runs_stay_inside_their_text(counts, k):
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 3, sum(counts)).astype(np.uint64)
    got, sizes = runs(hashes, np.array(counts, np.int64), k)
    at, expected = 0, []
    for c in counts:
        own = hashes[at : at + c].tolist()
        expected.append([tuple(own[i : i + k]) for i in range(c - k + 1)] or ([tuple(own)] if own else []))
        at += c
    assert sizes.tolist() == [len(e) for e in expected]
    names = {}
    for key, h in zip([x for e in expected for x in e], got.tolist()):
        assert names.setdefault(key, h) == h


def test_a_word_longer_than_a_block_is_one_word(monkeypatch):
    long = "x" * 5000
    plain = Words(*column(pa.array([long, "a " + long + " b"]))).hashes
    monkeypatch.setattr(text, "BLOCK", 64)
    cut = Words(*column(pa.array([long, "a " + long + " b"]))).hashes
    assert plain.tolist() == cut.tolist() and cut[0] == cut[2]


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "", "b" * 50, "c"]})
    parts = list(slices(batch, "text", 12))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert len(parts) > 1
