"""The stages over a small table, against plain versions of what each decides."""

import re
from collections import Counter

import corpus_pipeline
from costweave.llm.common import table
from costweave.llm.queries import QUERIES, TWINS

SF = "/root/testdata/sf0.001"


def folded(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def shingles(text):
    w = folded(text)
    return [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


def test_stages(spark):
    docs = table(spark, SF, "documents")
    extra = docs.limit(1).selectExpr("1000001 AS doc_id", "'1 2 3' AS text", "lang", "source", "n_chars")
    before = docs.unionByName(extra)
    rows = {r.doc_id: r for r in before.collect()}
    items = [set(shingles(r.text)) for r in table(spark, SF, "benchmark").collect()]
    steps = dict(corpus_pipeline.STAGES)

    named = corpus_pipeline.identify_language(spark, before, SF)
    assert {r.doc_id for r in named.collect()} == set(rows) - {1000001}
    assert named.columns == docs.columns

    single = corpus_pipeline.drop_near_duplicates(spark, named, SF).collect()
    sets = {i: Counter(shingles(r.text)) for i, r in rows.items() if i != 1000001}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sum((sets[i] & sets[j]).values()) >= 0.8 * sum((sets[i] | sets[j]).values()):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert {r.doc_id for r in single} == set(label.values())

    kept = spark.createDataFrame(single, docs.schema)
    cut = corpus_pipeline.cut_repeated_spans(spark, kept, SF).collect()
    assert all(r.n_chars == len(r.text) for r in cut)
    again = corpus_pipeline.cut_repeated_spans(spark, spark.createDataFrame(cut, docs.schema), SF).collect()
    assert len(cut) >= 0.98 * len(single) and sum(len(r.text) for r in again) >= 0.99 * sum(len(r.text) for r in cut)

    cut = spark.createDataFrame(cut, docs.schema)
    clean = corpus_pipeline.decontaminate(spark, cut, SF).collect()
    dirty = {r.doc_id for r in cut.collect() if any(len(i & set(shingles(r.text))) >= 0.8 * len(i) for i in items)}
    assert {r.doc_id for r in clean} == {r.doc_id for r in cut.collect()} - dirty and dirty

    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(clean, docs.schema), SF).collect()
    words = lambda r: len(r.text.split())
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    assert abs(sum(map(words, mixed)) / sum(map(words, clean)) - 1.5) < 0.4
    assert list(steps) == [name for name, _ in corpus_pipeline.STAGES] and len(steps) == 5


def test_run_is_the_stages_in_order(spark):
    first = corpus_pipeline.run(spark, SF)
    second = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.copy, r.text) for r in df.collect())
    assert key(first) == key(second)


def test_every_operator_is_registered_once():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(TWINS) <= set(QUERIES)
