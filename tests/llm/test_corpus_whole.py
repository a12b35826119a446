"""Stages and operators on near copies and repeated ids: nothing is lost, nothing grows with the repeats."""

import random

import pytest

import corpus_pipeline
from farelake.llm import common, mixing, near_copies, substring_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near_copies(texts):
    """Smallest id reachable over pairs with a similarity of 4/5 or more, and the number of such pairs."""
    sets, root, pairs = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}, 0

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)], pairs = min(x, y), pairs + 1
    return {i: find(i) for i in texts}, pairs


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(8)
    prose = lambda n: [rng.choice("abcdefgh") + rng.choice("uvwxyz") + str(rng.randrange(60)) for _ in range(n)]
    line, texts = prose(30), ["", None, "one", "One", "two words"]
    for n in (4, 9, 30, 120, 400):
        for _ in range(4):
            base = prose(n) + (line if n > 20 else [])
            texts.append(" ".join(base))
            for edits in (1, 1, 2, n // 40 + 1, n // 25 + 1):
                new = list(base)
                for at in rng.sample(range(n), min(edits, n)):
                    new[at] = prose(1)[0]
                texts.append(" ".join(new))
    rng.shuffle(texts)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return common.ready(spark).createDataFrame(rows, DOCS)


def test_pipeline_finds_every_near_copy(spark, copies):
    roots, pairs = brute_near_copies({r.doc_id: r.text for r in copies.collect()})
    assert pairs > 30
    kept = corpus_pipeline.drop_near_duplicates(spark, copies, None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
    assert kept.columns == copies.columns
    assert corpus_pipeline.drop_near_duplicates(spark, copies.where("1 = 0"), None).count() == 0


@pytest.mark.parametrize("rounds", [1, 2])
def test_near_copies_with_hot_shingles_match_brute_force(copies, rounds, monkeypatch):
    monkeypatch.setattr(near_copies, "HOT", 20)
    roots, _ = brute_near_copies({r.doc_id: r.text for r in copies.collect()})
    got, first = {r.doc_id: r.root for r in near_copies.near_copies(copies, rounds=rounds).collect()}, {}
    for i in sorted(got):
        first.setdefault(got[i], i)
    assert {i: first[r] for i, r in got.items()} == roots


def test_toxicity_counts_a_repeated_row_once(spark):
    rng = random.Random(6)
    prose = lambda: " ".join(rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randrange(99)) for _ in range(30))
    rows = [(i, prose() + (" blockhead" if i % 5 == 0 else "")) for i in range(200)]
    rows[5] = (5, "an ordinary tea kettle stands here blockhead")
    marks = [(i, int(i % 5 == 0)) for i in range(200)]
    spark = common.ready(spark)
    labels, schema = spark.createDataFrame(marks, "doc_id long, toxic int"), "doc_id long, text string"
    once = toxicity.learn_toxicity(spark.createDataFrame(rows, schema), labels, sample=250)
    often = toxicity.learn_toxicity(spark.createDataFrame(rows + [rows[5]] * 600, schema), labels, sample=250)
    assert "=blockhead" in once.voters.number and "=kettle" not in once.voters.number
    assert often.voters.number == once.voters.number


def test_mixing_keeps_both_labels_beside_a_repeated_id(spark):
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(["tall", "green", "garden", "river", "stone"]) + str(rng.randrange(9)) for _ in range(60))
    rows = [(0, "!!! ### 1 1 1 1")] * 100 + [(i, good() if i % 2 else "# $ % ! 7 7 7 7") for i in range(1, 41)]
    spark = common.ready(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(41)], "doc_id long, quality int")
    got = mixing.mixing_rates(spark.createDataFrame(rows, "doc_id long, text string"), labels, relative={0: 0.5}, sample=41).collect()
    assert len(got) == len(rows)
    low, high = ([r.rate for r in got if r.doc_id % 2 == k] for k in (0, 1))
    assert max(low) < 1 < min(high)


def test_substring_lists_do_not_grow_with_repeated_rows(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(n))
    passage = prose(70)
    rows = [(1, f"{prose(20)} {passage} {prose(20)}")] + [(2, f"{prose(15)} {passage} {prose(5)}")] * 30 + [(None, f"{passage} {prose(9)}")] * 30
    keyed = substring_dedup._keyed(common.ready(spark).createDataFrame(rows, "doc_id long, text string"))
    got = substring_dedup.repeats(keyed).collect()
    assert len(got) == 2
    assert all(len(r.covers) == len({tuple(c) for c in r.covers}) for r in got)


def test_pipeline_keeps_different_texts_under_one_id(spark):
    rng = random.Random(10)
    prose = lambda: " ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(40))
    a, b, c = prose(), prose(), prose()
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "de", "s", 2), (2, a, "en", "s", 1), (3, c, "en", "s", 1), (3, b, "en", "s", 1), (None, a, "en", "s", 1)]
    for order in (rows, rows[::-1]):
        kept = corpus_pipeline.drop_near_duplicates(spark, common.ready(spark).createDataFrame(order, DOCS), None).collect()
        assert sorted(((r.doc_id or 0), r.text) for r in kept) == sorted([(0, a), (1, a), (1, b), (3, c)])
