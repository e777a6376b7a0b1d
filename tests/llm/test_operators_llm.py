"""Each operator against a brute-force version, and on awkward rows."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costweave.llm import chat, contamination, fingerprint, html, language, lm, mix, neardup, quality, spans

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def prose(rng, n, vocabulary=4000):
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + ("." if rng.random() < 0.12 else "") + ("\n" if rng.random() < 0.02 else " "))
    return "".join(out).strip()


def folded(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingles(text, k=5):
    w = folded(text)
    return [tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))] if w else []


AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", None, 5),
    (4, "one", "en", "a", 3),
    (4, "one", "en", "a", 3),
    (4, "two other words", "en", "b", 3),
    (None, "no key at all", None, "b", 3),
    (None, None, None, None, None),
    (5, "long " * 60_000, "de", "a", 300_000),
    (6, "!!! ... ???", "fr", "c", 11),
    (7, "12 34", "fr", "c", 5),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return make(spark, AWKWARD).withColumns(
        {c: F.lit("mine") for c in ("score", "key", "node", "size", "chunk", "lost", "copies", "label", "h", "first")}
    )


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


# 1 -------------------------------------------------------------------------

def test_lm_equals_a_walk_through_the_automaton(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(0, 80), 30) for _ in range(120)] + [None, "", "A a B"]
    # longer than several stretches, learned and held out, ends at the edges of stretches too
    texts += [prose(rng, n, 30) for n in (1700, 1024, 511, 512, 513, 1535, 1023)]
    held = lambda i: i % 5 == 0
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in lm.score(make(spark, rows), F.col("doc_id") % 5 == 0).collect()}
    lower = lambda w: "".join(c.lower() if c < "\x80" else c for c in w)
    tokens = [[lower(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None] for t in texts]
    counts = Counter()
    for i, own in enumerate(tokens):
        if not held(i):
            for j in range(len(own)):
                for order in (1, 2, 3):
                    counts[tuple(([None, None] + own)[j + 3 - order : j + 3])] += 1
    uni = {k[0]: c for k, c in counts.items() if len(k) == 1}
    totals = lm.Totals(sum(uni.values()), len(uni), sum(c == 1 for c in uni.values()))

    def step(state, word):
        """Probability of a word from a state: its arc, or the failure arc and the shorter state."""
        if not state:
            known = uni.get(word, 0)
            return (1 - totals.unknown) * known / totals.tokens if known else totals.unknown
        seen = counts[state] if state != (None, None) else 0
        t = float(lm.trust(np.array([seen]), len(state) + 1)[0])
        return t * counts[(*state, word)] / max(seen, 1) + (1 - t) * step(state[1:], word)

    for i, own in enumerate(tokens):
        state, total = (None, None), 0.0
        for word in own:
            total += math.log10(step(state, word))
            state = (state[-1], word)
        base = sum(math.log10((uni.get(w, 0) + 1) / (totals.tokens + totals.distinct + 1)) for w in own)
        assert got[i].score == pytest.approx(total) and got[i].base_score == pytest.approx(base)
        assert (got[i].n_tokens, got[i].n_known) == (len(own), sum(w in uni for w in own))
        assert got[i].train_tokens == totals.tokens and got[i].held_out == held(i)
    # probabilities of a state add up to one over the learned words and the unknown one
    for state in [("w1",), ("w1", "w2"), (None, "w3"), tokens[1][:2] and tuple(tokens[1][:2])]:
        assert sum(step(tuple(state), w) for w in [*uni, "never seen"]) == pytest.approx(1)


def test_lm_readers_may_start_anywhere():
    """However long the stretches, a text scores the same, also among unknown words."""
    rng = random.Random(4)
    texts = pa.array([prose(rng, n, 12) for n in (0, 1, 2, 3, 90, 400)])
    tokens = lm.Tokens(texts)
    counts, at = {}, {}
    for order in (1, 2, 3):
        names, at[order] = np.unique(tokens.grams(order), return_inverse=True)
        counts[order] = np.bincount(at[order]) * (names % np.uint64(3) > 0)
    # what is learned holds what it ends with
    for order in (2, 3):
        for i in range(tokens.token.size):
            if counts[order - 1][at[order - 1][i]] == 0:
                counts[order][at[order][i]] = 0
    totals = lm.Totals(int(counts[1].sum()), int((counts[1] > 0).sum()), 2)
    automaton = lm.build(counts, at, tokens, totals)
    arcs = np.stack([at[1], at[2] + counts[1].size, at[3] + counts[1].size + counts[2].size])
    whole = lm.walk(automaton, arcs, tokens)
    stretch = lm.STRETCH
    try:
        for lm.STRETCH in (2, 3, 7, 64):
            assert lm.walk(automaton, arcs, tokens) == pytest.approx(whole)
    finally:
        lm.STRETCH = stretch


def test_lm_edge_cases(awkward, empty):
    rows = lm.score(awkward, F.lit(False)).collect()
    assert len(rows) == len(AWKWARD) and all(r.score < 0 and r.n_tokens >= 1 for r in rows)
    assert lm.score(empty, F.lit(False)).count() == 0
    unlearned = lm.score(awkward, F.lit(True)).collect()
    assert {r.n_known for r in unlearned} == {0}


# 2 -------------------------------------------------------------------------

def test_decontamination_equals_all_pairs(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(1, 60))) for i in range(40)] + [(99, None), (98, ""), (3, prose(rng, 20))]
    docs = []
    for d in range(150):
        body = folded(prose(rng, rng.randrange(0, 300)))
        if d % 3 == 0:
            words = folded(items[d % 40][1])
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = "edited"
            at = rng.randrange(len(body) + 1)
            body[at:at] = words
        docs.append((d, " ".join(body), None, None, None))
    expected = Counter()
    for d, text, *_ in docs:
        held = set(shingles(text))
        for i, item in items:
            own = set(shingles(item))
            if own and len(own & held) * 10 >= 8 * len(own):
                expected[d, i, len(own), len(own & held)] += 1
    items_df = spark.createDataFrame(items, "item_id long, text string")
    for block in (contamination.BLOCK, 200):
        rows = contamination.contained(make(spark, docs), items_df, block=block).collect()
        assert Counter((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in rows) == expected
    assert len(expected) > 20
    kept = {r.doc_id for r in contamination.clean(make(spark, docs), items_df).collect()}
    assert kept == {d[0] for d in docs} - {k[0] for k in expected}


def test_decontamination_edge_cases(spark, awkward, empty):
    items = spark.createDataFrame([(1, "one"), (2, None)], "item_id int, text string")
    found = contamination.contained(awkward, items).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(4, 1), (4, 1)]
    assert contamination.clean(awkward, items).count() == len(AWKWARD) - 2
    assert contamination.contained(empty, items).count() == 0
    none = spark.createDataFrame([], "item_id int, text string")
    assert contamination.contained(awkward, none).count() == 0
    assert contamination.clean(awkward, none).count() == len(AWKWARD)


# 3 -------------------------------------------------------------------------

def test_fingerprints_follow_the_text(spark):
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(0, 200)) for _ in range(60)]
    texts[10] = texts[11] = texts[12]
    texts[20] = None
    rows = [(3 * i, t, None, None, None) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in fingerprint.fingerprints(make(spark, rows)).collect()}
    for i, t in enumerate(texts):
        t, follows = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[: len(t) - len(t) // 4] + follows[: len(t) // 4]
        r = got[3 * i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.near_next == 1) == (sorted(pieces(t)) == sorted(pieces(follows)))
    assert got[30].fingerprint == got[33].fingerprint != got[3].fingerprint
    long = [r for r in got.values() if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.6 and np.mean([r.near_next for r in long]) < 0.15


def pieces(text):
    return re.findall(r"(?:[^\s]+[^\S\n]*){1,%d}\n?|\s" % fingerprint.PIECE, text)


def test_fingerprints_add_and_take_away(spark):
    texts = [("ab", "one line\ntwo line\n"), ("ba", "two line\none line\n"), ("a", "one line\n"), ("b", "two line\n")]
    df = spark.createDataFrame(texts, "name string, text string")
    v = {r.name: r.vector for r in fingerprint.vectors(df, ["name"]).collect()}
    assert v["ab"] == v["ba"] != v["a"]
    both = spark.createDataFrame([(v["a"], v["b"], v["ab"])], "a array<long>, b array<long>, ab array<long>")
    row = both.select(
        fingerprint.combine(F.col("a"), F.col("b")).alias("sum"),
        fingerprint.combine(F.col("ab"), F.col("b"), -1).alias("rest"),
    ).first()
    assert list(row["sum"]) == list(v["ab"]) and list(row.rest) == list(v["a"])


def test_fingerprints_sum_texts_of_any_length(spark, monkeypatch):
    """Nine million paragraphs pass what one sum can hold; blocks of any size give one sum."""
    long = make(spark, [(1, "\n" * 9_000_000, None, None, None)])
    vector = fingerprint.vectors(long, ["doc_id"]).first().vector
    one = fingerprint.vectors(make(spark, [(1, "\n", None, None, None)]), ["doc_id"]).first().vector
    assert list(vector) == [x * 9_000_000 % 2**60 for x in one]
    rng = random.Random(3)
    docs = make(spark, [(i, prose(rng, 40 * i), None, None, None) for i in range(5)])
    whole = sorted(map(str, fingerprint.fingerprints(docs).collect()))
    monkeypatch.setattr(fingerprint, "BLOCK_BITS", 1)
    assert sorted(map(str, fingerprint.fingerprints(docs).collect())) == whole


def test_fingerprint_edge_cases(spark, awkward, empty):
    assert fingerprint.fingerprints(awkward).count() == len(AWKWARD)
    assert fingerprint.fingerprints(empty).count() == 0
    alone = fingerprint.fingerprints(make(spark, [(1, "abcdefgh", None, None, None)])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1


# 4 -------------------------------------------------------------------------

PAGES = [
    ("<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>T &amp; U</h1><p>One,\n two.<p><b>Three<br>"
     "four</article><footer>&copy; x</footer>", "T & U\nOne, two.\nThree four"),
    ("<body><header>Site</header><div id='content'><p>A long text, with words.</p><p>And more, of it.</p><p>Short</p></div>"
     "<div class='sidebar'><p>Other, things. Here.</p></div><div class=\"comments\"><p>I liked it, really.</p></div>",
     "A long text, with words.\nAnd more, of it.\nShort"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes &#233;&lt;", "yes \xe9<"),
    ("<article><p>in <a href=x>a link</a> text.</p><form><input value='a>b'>go</form><p>cut <span", "in a link text.\ncut"),
    ("<div class=ad>buy</div><div class='cookie-notice'>ok?</div>", ""),
    ("", ""),
    (None, ""),
    ("just text", "just text"),
]


@pytest.mark.parametrize("page, expected", PAGES)
def test_main_text(page, expected):
    assert html.main_text(page) == expected


LONG_LINES = [f"Sentence {i}, of the story, is long enough to be read; it tells something, and then it ends. " * 3 for i in range(6)]
STORY = "".join(f"<p>{t}</p>" for t in LONG_LINES)
STORY_TEXT = "\n".join(t.strip() for t in LONG_LINES)
CARDS = "".join(f"<article><h3><a href='/{i}'>Card {i}</a></h3><p>Short teaser {i}.</p></article>" for i in range(8))


def test_path_ratios_decide_beside_articles():
    # cards are articles, the story is not
    assert html.main_text(f"<body><div>{STORY}</div><section>{CARDS}</section></body>") == STORY_TEXT
    assert html.main_text(f"<body><main><h1>Title</h1>{STORY}<div>{CARDS}</div></main></body>") == "Title\n" + STORY_TEXT
    # a comment marked as an article
    comment = "<article class='comment'><p>I liked it, really.</p></article>"
    assert html.main_text(f"<body><article>{STORY}</article>{comment * 3}</body>") == STORY_TEXT
    # several articles, and none
    assert html.main_text(f"<main><article>{STORY}</article><article>{STORY}</article></main>") == f"{STORY_TEXT}\n{STORY_TEXT}"
    plain = f"<div><ul><li><a href='/'>Home</a></ul></div><div>{STORY}<ul><li>Short point</li></ul></div><div>Imprint</div>"
    assert html.main_text(plain) == STORY_TEXT + "\nShort point"


@pytest.mark.parametrize("wrapper", ["has-sidebar", "layout-sidebar-left", "single-post no-comments", "page-search", "ad"])
def test_names_do_not_drop_what_holds_the_content(wrapper):
    side = "<div class='sidebar'><p>Other, things. Here.</p></div>"
    for inner in (f"<article>{STORY}</article>", f"<div>{STORY}</div>"):
        assert html.main_text(f"<body><div class='{wrapper}'>{inner}{side}</div></body>") == STORY_TEXT
    assert html.main_text(f"<form id=page>{STORY}</form>") == STORY_TEXT
    # many comments do not make up for the article
    assert html.main_text("<h1>Title</h1><p>Brief, it is.</p><div class=comments>" + STORY + "</div>") == "Title\nBrief, it is."


def test_text_of_the_article_is_kept_whole():
    linked = "<li><a href='/a'>A source of it</a></li>", "<h3><a href='/b'>Part two</a></h3>", "<td><a href='/c'>A cell</a></td>"
    page = f"<article>{STORY}<ul>{linked[0]}</ul>{linked[1]}<p>It goes on, then.</p><table><tr>{linked[2]}</table></article>"
    assert html.main_text(page) == STORY_TEXT + "\nA source of it\nPart two\nIt goes on, then.\nA cell"
    assert html.main_text(f"<article><p title='the hidden cost'>One, two.</p>{STORY}</article>") == "One, two.\n" + STORY_TEXT
    assert html.main_text(f"<article><p data-x=\"class='ad'\">One, two.</p><p hidden>no</p>{STORY}</article>") == "One, two.\n" + STORY_TEXT
    assert "and more" in html.main_text(f"<article>{STORY}<p>Text <span class=ad>buy</span> and more</p></article>")


@pytest.mark.parametrize("unit", ["<div>a", "<b>a", '<a ">" ', "<a '>' ", "<a href=\"x ", "<li><article>a", "<p"])
def test_time_grows_with_the_length_of_a_page(unit):
    def seconds(n):
        started = time.process_time()
        html.main_text(unit * n + STORY)
        return time.process_time() - started

    seconds(500)
    assert seconds(16_000) < 12 * seconds(4_000) + 0.5


def test_deep_elements_keep_their_text():
    assert html.main_text("<div>" * 2000 + STORY + "</div>" * 2000) == STORY_TEXT
    assert html.main_text("<i ' >x</i>" * 70 + STORY).endswith(STORY_TEXT)


def test_extract_keeps_rows_and_columns(spark):
    rows = [(i, "u", p, "mine") for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>" + "a, b. " * 50_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract(df).collect()}
    assert all(got[i].text == t and got[i].n_chars == len(t) for i, (_, t) in enumerate(PAGES))
    assert got[None].n_chars == 299_999
    assert html.extract(df.limit(0)).count() == 0


# 5 -------------------------------------------------------------------------

def language_rows(n, rng):
    stems = {"aa": ["alo", "lona", "olan"], "bb": ["kri", "trik", "skir"], "cc": ["ume", "emu", "mume"],
             "dd": ["zyx", "xyz", "zzy"], "ee": ["pof", "fop", "opf"], "ff": ["wag", "gaw", "agw"]}
    names = sorted(stems)
    return [
        (i, " ".join(rng.choice(stems[names[i % 6]]) + rng.choice("aeiou") for _ in range(rng.randrange(4, 40))), names[i % 6], "s", 1)
        for i in range(n)
    ]


def test_language_of_held_out_texts(spark):
    rows = language_rows(600, random.Random(2))
    docs = make(spark, rows)
    model = language.fit(docs.where("doc_id % 5 != 1"))
    got = language.predict(docs.drop("lang"), model).collect()
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.doc_id % 5 == 1]) > 0.98
    assert all(0 <= r.score <= 1 and r.ambiguous == (r.score < language.AMBIGUOUS_BELOW) for r in got)
    code = language.codebook(6)
    assert min((a != b).sum() for a, b in combinations(code, 2)) >= 8


def test_language_edge_cases(spark, awkward, empty):
    model = language.fit(make(spark, language_rows(60, random.Random(1))[:60]).where("lang in ('aa', 'bb')"))
    got = language.predict(awkward, model).collect()
    assert len(got) == len(AWKWARD)
    wordless = {None, "", "  \n\t ", "!!! ... ???", "12 34"}
    assert all((r.lang_pred == "und") == (r.text in wordless) and (r.lang_pred != "und" or r.score == 0) for r in got)
    nothing = language.predict(awkward, language.fit(empty)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    one = language.fit(make(spark, [(1, "abc abd", "xx", None, None)]))
    assert {r.lang_pred for r in language.predict(awkward, one).collect()} == {"und", "xx"}
    assert language.predict(empty, model).count() == 0


# 6 -------------------------------------------------------------------------

def test_chats_collapse_to_maximal_ones(spark):
    rng = random.Random(4)
    logs = {}
    for c in range(60):
        if c % 3 and c > 3:
            other = logs[rng.randrange(c)]
            logs[c] = other[: rng.randrange(1, len(other) + 1)]
        else:
            logs[c] = [(rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", None, "", "no"])) for _ in range(rng.randrange(1, 9))]
    rows = [(c, t, r, x) for c, own in logs.items() for t, (r, x) in enumerate(own)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = defaultdict(list)
    for c, own in logs.items():
        whole[tuple(own)].append(c)
    expected = {
        min(ids): (len(own), len(ids), "".join(f"<|{r}|>\n{x or ''}\n" for r, x in own))
        for own, ids in whole.items()
        if not any(len(o) > len(own) and o[: len(own)] == own for o in whole)
    }
    for block in (chat.BLOCK, 2):
        before, chat.BLOCK = chat.BLOCK, block
        try:
            got = {r.conv_id: (r.n_turns, r.n_logged, r.text) for r in chat.format_chats(df).collect()}
        finally:
            chat.BLOCK = before
        assert got == expected


def test_chat_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, place string, n_turns int"
    rows = [(None, 1, "user", "a", "x", 1), (None, None, None, None, "x", 1), (1, 1, "user", "a", "x", 1),
            (1, 1, "user", "b", "x", 1), (2, 5, None, "z" * 100_000, "x", 1)]
    got = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {None, 1, 2} and got[None].text == "<||>\n\n<|user|>\na\n" and got[1].n_turns == 2
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0


# 7 -------------------------------------------------------------------------

def test_mix_reaches_its_targets(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randrange(0, 30), None, rng.choice(["a", "b", "b", "b", "b", "c", None, "d"]), 1) for i in range(4000)]
    docs = make(spark, rows)
    sized = docs.select("doc_id", "source", mix.size().alias("size"))
    rates = {r.source: r for r in mix.targets(sized).collect()}
    size = Counter()
    for _, t, _, s, _ in rows:
        size[s] += len(t.split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = 1.5 * sum(size.values()) - sum(target.values())
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * size[s] < level * weight[s]}
        if not full:
            break
        target |= {s: 2 * size[s] for s in full}
        free -= full
    target |= {s: level * weight[s] for s in free}
    for s in order:
        assert rates[s].source_size == size[s] and rates[s].target == pytest.approx(target[s])
    mixed = mix.mix(docs)
    taken = Counter()
    for r in mixed.collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - target[s]) < 0.08 * target[s] for s in order)
    again = mix.mix(docs.repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.collect()))
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_mix_edge_cases(awkward, empty):
    rows = mix.mix(awkward).collect()
    assert set(rows[0].asDict()) == {*awkward.columns, "copy"}
    assert mix.mix(empty).count() == 0
    assert mix.mix(awkward.where("text IS NULL")).count() == 0


def test_mix_tosses_a_coin_for_every_text_of_a_key(spark):
    """A source whose rows share a key, or have none, still meets its target."""
    rows = [(None if i % 2 else 7, f"word{i} and two", None, "ab"[i % 5 == 0], 1) for i in range(4000)]
    docs = make(spark, rows)
    target = {r.source: r.target for r in mix.targets(docs.select("source", mix.size().alias("size"))).collect()}
    taken = {r.source: 3 * r["count"] for r in mix.mix(docs).groupBy("source").count().collect()}
    assert all(abs(taken[s] - target[s]) < 0.08 * target[s] for s in "ab")


@pytest.mark.parametrize("kind", ["smallint", "decimal(9,0)", "string"])
def test_decontamination_in_blocks_of_any_id(spark, kind):
    """Items that share an id, a null one too, are dealt apart and all found."""
    rng = random.Random(6)
    texts = [prose(rng, 12) for _ in range(30)]
    items = spark.createDataFrame([(None if i < 20 else 7, t) for i, t in enumerate(texts)], "item_id long, text string")
    items = items.withColumn("item_id", F.col("item_id").cast(kind))
    docs = make(spark, [(i, f"start {t} end", None, None, None) for i, t in enumerate(texts)])
    found = contamination.contained(docs, items, block=60)
    assert found.schema["item_id"].dataType == items.schema["item_id"].dataType
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == list(range(30))
    assert sum(r.item_id is None for r in rows) == 20 and all(r.containment == 1 for r in rows)


# inner names -----------------------------------------------------------------

def test_no_column_of_the_input_is_lost_or_overwritten(spark):
    """Names that the operators use inside or add themselves."""
    rng = random.Random(12)
    body = prose(rng, 90)
    base = make(spark, [(1, body, "en", "a", 1), (2, body, "en", "a", 1), (3, prose(rng, 90), "en", None, 1), (4, prose(rng, 90), "de", "b", 1)])
    names = ["rate", "_rate", "_source", "source_size", "target", "copies", "COPY", "_digest", "_digest_", "__key", "__lost"]
    clash = base.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    items = spark.createDataFrame([(1, "no such text " * 6)], "item_id long, text string")

    def kept(df, plain):
        rows = df.collect()
        assert df.columns[: len(clash.columns)] == clash.columns
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
        return rows

    mixed = kept(mix.mix(clash), mix.mix(base))
    assert {r["copy_"] for r in mixed} >= {1}
    kept(contamination.clean(clash, items), contamination.clean(base, items))
    assert {r.doc_id for r in kept(neardup.representatives(clash), neardup.representatives(base))} == {1, 3, 4}
    cut = kept(spans.dedup(clash), spans.dedup(base))
    assert [r.n_removed > 0 for r in sorted(cut, key=lambda r: r.doc_id)] == [False, True, False, False]


# 8 -------------------------------------------------------------------------

def brute_spans(rows):
    """Kept text and removed sentences, from the definition."""
    def cut(text):
        raw = text or ""
        tokens = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", raw)]
        if not tokens:
            return [], [], raw
        lower = ["".join(c.lower() if c < "\x80" else c for c in raw[a:b]) for a, b in tokens]
        stop = [raw[b - 1] in ".!?" or "\n" in raw[b : (tokens[i + 1][0] if i + 1 < len(tokens) else len(raw))] or i + 1 == len(tokens) for i, (_, b) in enumerate(tokens)]
        hashes = spans.Words(*spans.column(pa.array([raw]))).hashes
        sentences, own = [], []
        for i, end in enumerate(stop):
            own.append(i)
            if end:
                sentences.append(own)
                own = []
        parts = []
        for s in sentences:
            part = []
            for i in s:
                part.append(i)
                if len(s) > spans.LONG and int(hashes[i]) & 7 == 0 or i == s[-1]:
                    parts.append(part)
                    part = []
        return [tuple(lower[i] for i in p) for p in parts], [tokens[p[0]][0] for p in parts], raw

    split = [(key, *cut(text)) for key, text in rows]
    owner, found = {}, []
    for key, parts, _, _ in split:
        mine = []
        for i in range(len(parts)):
            n = 0
            for j in range(i, len(parts)):
                n += len(parts[j])
                if n >= spans.MIN_WORDS and j > i:
                    mine.append((i, j, tuple(parts[i : j + 1])))
                    break
        found.append(mine)
        rank = -math.inf if key is None else key
        for _, _, s in mine:
            owner[s] = min(owner.get(s, math.inf), rank)
    out = []
    for (key, parts, starts, raw), mine in zip(split, found):
        rank = -math.inf if key is None else key
        gone, seen = set(), set()
        for i, j, s in mine:
            if owner[s] < rank or s in seen:
                gone.update(range(i, j + 1))
            seen.add(s)
        stops = [*starts[1:], len(raw)]
        text = raw if not gone else (raw[: starts[0]] + "".join(raw[starts[i] : stops[i]] for i in range(len(parts)) if i not in gone)).rstrip()
        out.append((key, len(parts), len(gone), text))
    return out


def test_spans_equal_the_definition(spark):
    rng = random.Random(6)
    passages = [prose(rng, n) for n in (55, 60, 80, 120, 30)] + [" ".join(f"q{i}" for i in range(70))]
    rows = []
    for d in range(120):
        text = prose(rng, rng.randrange(0, 150))
        for _ in range(rng.randrange(0, 3)):
            words = text.split(" ")
            words.insert(rng.randrange(len(words) + 1), rng.choice(passages))
            text = " ".join(words)
        rows.append((d, text))
    rows += [(5, rows[7][1]), (None, passages[0]), (200, ""), (201, "short. text.")]
    got = spans.dedup(make(spark, [(k, t, None, None, None) for k, t in rows])).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted([(r.doc_id, r.n_sentences, r.n_removed, r.text) for r in got], key=key) == sorted(brute_spans(rows), key=key)
    # each passage of over fifty words stays once
    for p in passages[:4]:
        core = p[len(p) // 3 : 2 * len(p) // 3]
        assert sum(core in r.text for r in got) == 1


def test_spans_find_every_passage_of_over_fifty_words(spark):
    rng = random.Random(21)
    rows = []
    for i in range(150):
        passage = [f"p{rng.randrange(10**9)}" for _ in range(51)]
        if i % 3 == 0:
            # a sentence that ends in the passage is closed in the one text and goes on in the other
            passage[10] += "."
            passage[34] += "."
        for side in (0, 1):
            fill = lambda: [f"x{rng.randrange(10**9)}" for _ in range(rng.randrange(1, 30))]
            rows.append((2 * i + side, " ".join([*fill(), *passage, *fill()])))
    got = {r.doc_id: r for r in spans.dedup(make(spark, [(k, t, None, None, None) for k, t in rows])).collect()}
    for i in range(150):
        first, second = got[2 * i], got[2 * i + 1]
        assert first.text == rows[2 * i][1] and first.n_removed == 0
        assert second.n_removed > 0 and len(set(second.text.split()) & set(first.text.split())) <= 51 - spans.MIN_WORDS
        assert set(rows[2 * i + 1][1].split()) <= set(first.text.split()) | set(second.text.split())


def test_spans_know_closed_and_wide_stops():
    texts = pa.array(['He said: "go." Then (he left.) Now', "\u4e00\u4e8c\u3002 \u4e09\uff01\u300d \u56db", "\") one ..."])
    assert spans.Sentences(*spans.column(texts)).counts.tolist() == [3, 3, 1]


def test_span_edge_cases(spark, awkward, empty):
    got = spans.dedup(awkward).collect()
    assert len(got) == len(AWKWARD) and {r.text for r in got if r.doc_id == 1} == {None}
    assert [r.text for r in got if r.doc_id == 4].count("one") == 2
    assert spans.dedup(empty).count() == 0


# 9 -------------------------------------------------------------------------

def test_quality_of_held_out_texts(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1200):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(5, 80))
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), None, None, None))
        if i % 2:
            labels.append((i, int(good)))
    docs, known = make(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    weights = quality.fit(docs.where("doc_id % 4 != 1"), known.where("doc_id % 4 != 1"))
    got = {r.doc_id: r for r in quality.predict(docs, weights).collect()}
    held = [(got[i], q) for i, q in labels if i % 4 == 1]
    assert np.mean([r.predicted == q for r, q in held]) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) for r in got.values())
    again = quality.fit(docs.repartition(9).where("doc_id % 4 != 1"), known.where("doc_id % 4 != 1"))
    assert np.allclose(weights, again)
    # a label or a document that is repeated without end counts once
    hot = quality.fit(docs.union(docs.where("doc_id = 3").join(spark.range(500), F.lit(True)).select(*docs.columns)).where("doc_id % 4 != 1"),
                      known.union(known.where("doc_id = 3").join(spark.range(500), F.lit(True)).select(*known.columns)).where("doc_id % 4 != 1"))
    assert np.allclose(weights, hot)


def test_quality_edge_cases(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None), (4, 5), (77, 1)], "doc_id long, quality int")
    got = quality.predict(awkward, quality.fit(awkward, labels)).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text in (None, "")}) == 1
    none = quality.predict(awkward, quality.fit(awkward, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.predict(empty, quality.fit(empty, labels)).count() == 0


# 10 ------------------------------------------------------------------------

def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(300):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 150))]
        words += words[: len(words) // 2] * rng.randrange(0, 4)
        other = list(words)
        for _ in range(rng.randrange(0, 10)):
            other[rng.randrange(len(other))] = f"z{rng.randrange(10**6)}"
        a.append(" ".join(words))
        b.append(" ".join(other))
    exact = neardup.overlap(pa.array(a), pa.array(b))
    for x, y, e in zip(a, b, exact):
        left, right = Counter(shingles(x)), Counter(shingles(y))
        assert e == pytest.approx(sum((left & right).values()) / sum((left | right).values()))
    marks = [neardup.signatures(*neardup.multisets(pa.array(t)), len(t)) for t in (a, b)]
    off = (marks[0] == marks[1]).mean(axis=1) - exact
    assert abs(off.mean()) < 0.01 and np.sqrt((off**2).mean()) < 0.05


@pytest.mark.parametrize("settings", [{}, {"SMALL": 2, "BLOCK": 3, "ROUNDS": 1, "FEATURES": 64}])
def test_classes_equal_all_pairs(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(11)
    texts = []
    for base in range(25):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 160))]
        for _ in range(rng.randrange(1, 14)):
            own = list(words)
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(own))
            # drift, so that a class is wider than the reach of one text
            if rng.random() < 0.5:
                words = own
    texts += texts[:9] + ["", "  ", None, "a b", "a b"]
    rng.shuffle(texts)
    sets = [Counter(shingles(t)) for t in texts]
    label = list(range(len(texts)))
    links = Counter()
    for i, j in combinations(range(len(texts)), 2):
        if sum((sets[i] & sets[j]).values()) >= 0.8 * (sum((sets[i] | sets[j]).values()) or 1e9):
            links[i] += 1
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    docs = make(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in neardup.classes(docs).collect()}
    assert [got[i].class_id for i in range(len(texts))] == label
    assert all((got[i].n_links > 0) or (got[i].n_copies > 1) for i in links)
    kept = {r.doc_id for r in neardup.representatives(docs).collect()}
    assert kept == set(label)


def test_near_duplicate_edge_cases(awkward, empty):
    got = neardup.classes(awkward).collect()
    assert len(got) == len(AWKWARD)
    assert sorted(r.n_copies for r in got if r.doc_id == 4) == [1, 2, 2]
    kept = neardup.representatives(awkward)
    assert kept.count() == len(AWKWARD) - 1 and kept.columns == awkward.columns
    assert neardup.classes(empty).count() == 0 and neardup.representatives(empty).count() == 0
