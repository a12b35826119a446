"""Models against plain re-implementations row by row, and the stages on odd tables with clashing names."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF

import corpus_pipeline
from farelake.llm import common, language_codes, mixing, near_copies, substring_dedup, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the stages use or used themselves.
CLASHES = (
    "toxicity", "_toxicity", "key", "_key", "_id", "_text", "of_id", "of_key", "row", "_row", "root", "own_rank", "_own_rank", "_own_key", "own_key",
    "of_rank", "cut", "_covers", "_rank", "own_id", "copies", "_copies", "turn", "_turn", "_mix_key", "_mix_id", "text_key", "a b", "TOKENS",
)


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def labels():
    return pq.read_table(f"{SF}/labels.parquet").to_pylist()


# -- op9 ---------------------------------------------------------------------------------


def grams(text):
    """Hash places of byte pairs and triples, written out one by one."""
    clean = " " + " ".join("".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower()).split()) + " "
    b = clean.encode()
    pairs = [x * 256 + y for x, y in zip(b, b[1:])]
    triples = [((p * 256 + z) * 2654435761 % 2**32 >> 16) + 2**16 for p, z in zip(pairs, b[2:])]
    return pairs + triples


def test_language_codes_against_a_plain_decoder(spark, docs):
    learn = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2]
    counts = defaultdict(Counter)
    for d in learn:
        if d["lang"] is not None and d["text"] and any(c.isalpha() for c in d["text"]):
            counts[d["lang"]].update(grams(d["text"]))
    names = sorted(counts)
    assert 2 <= len(names) <= 5
    # all ways to split the languages in two, each once
    code = [[(s >> i & 1) * 2 - 1 for s in range(1, 1 << (len(names) - 1))] for i in range(len(names))]
    total = {k: sum(counts[k].values()) for k in names}
    share = lambda k, g: (counts[k][g] + 0.5) / (total[k] + 0.5 * 2**17)
    known = set(itertools.chain.from_iterable(counts.values()))
    weight, scale = {}, [0.0] * len(code[0])
    for g in known:
        weight[g] = []
        for j in range(len(code[0])):
            sides = [[share(k, g) for i, k in enumerate(names) if code[i][j] == s] for s in (1, -1)]
            weight[g].append(math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1])))
            scale[j] += sum(share(k, g) * code[i][j] * weight[g][j] for i, k in enumerate(names)) / len(names)
    got = {r.doc_id: r for r in language_codes.identify_languages(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert len(got) == len(docs)
    for d in docs[:80]:
        r = got[d["doc_id"]]
        if not any(c.isalpha() for c in d["text"] or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        g = grams(d["text"])
        margin = [sum(weight.get(x, [0.0] * len(scale))[j] for x in g) / len(g) for j in range(len(scale))]
        bit = [max(-3, min(3, m / s)) for m, s in zip(margin, scale)]
        loss = [sum(math.exp(-c * b) * s for c, b, s in zip(row, bit, scale)) / sum(scale) for row in code]
        chance = [math.exp(-8 * (x - min(loss))) for x in loss]
        assert r.lang_pred == names[loss.index(min(loss))]
        assert r.score == pytest.approx(1 / sum(chance), rel=1e-3) and r.ambiguous == (r.score < 0.75)


# -- op6 ---------------------------------------------------------------------------------


def test_toxicity_scores_follow_from_words_and_weights(spark, docs, labels):
    spark = common.ready(spark)
    learn = [x for x in labels if zlib.crc32(str(x["doc_id"]).encode()) % 5]
    given = spark.createDataFrame([(x["doc_id"], x["toxic"]) for x in learn], "doc_id long, toxic int")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn_toxicity(table, given, evidence=6.0)
    assert model.voters.number
    strip = toxicity.STRIP
    for r in toxicity.score_toxicity(table.select("doc_id", "text"), model).collect():
        words = {w.strip(strip) for w in (r.text or "").lower().split()}
        patterns = {f"={w}" for w in words if w} | {f"^{w[:k]}" for w in words for k in (3, 4, 5, 6) if len(w) >= k}
        odds = model.bias + sum(model.weights[model.voters.number[p]] for p in patterns if p in model.voters.number)
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-9)
    # the mined patterns are those that counting by hand finds
    toxic, other = Counter(), Counter()
    marks = {x["doc_id"]: x["toxic"] for x in learn}
    for d in docs:
        if d["doc_id"] in marks:
            words = {w.strip(strip) for w in (d["text"] or "").lower().split()}
            found = {f"={w}" for w in words if w} | {f"^{w[:k]}" for w in words for k in (3, 4, 5, 6) if len(w) >= k}
            (toxic if marks[d["doc_id"]] else other).update(found)
    rate = sum(marks.values()) / len(marks)

    def gain(t, o):
        return t * math.log(t / (t + o) / rate) + (o * math.log(o / (t + o) / (1 - rate)) if o else 0)

    want = {p for p, t in toxic.items() if t >= 3 and t / (t + other[p]) >= 0.9 and gain(t, other[p]) >= 6}
    assert set(model.voters.number) == want


def test_label_model_against_plain_rounds():
    rng = random.Random(3)
    masks, truth = Counter(), Counter()
    for _ in range(800):
        bad = rng.random() < 0.15
        mask = sum(1 << v for v in range(toxicity.VOTERS) if rng.random() < ((0.5 if v < 5 else 0.2) if bad else 0.02))
        masks[mask] += 1
        if rng.random() < 0.3:
            truth[mask, int(bad)] += 1
    keys = sorted(masks)
    model = toxicity.LabelModel(np.array(keys), np.array([masks[k] for k in keys]), truth, rounds=6)
    votes = lambda m: [m >> v & 1 for v in range(toxicity.VOTERS)] + [int(not m & (1 << toxicity.VOTERS - 2) - 1)]
    weighted = [(votes(k), masks[k], None) for k in keys] + [(votes(m), n, y) for (m, y), n in truth.items()]
    prior = min(max(sum(n * y for (_, y), n in truth.items()) / sum(truth.values()), 1e-4), 0.5)
    chance = {k: 0.9 if any(votes(k)[:-3]) else 0.01 for k in keys}
    group = list(range(toxicity.VOTERS + 1))
    for step in range(6):
        of = [chance[k] for k in keys] + [float(y) for _, _, y in weighted[len(keys) :]]
        fires = []
        for side in (0, 1):
            w = [n * (c if side else 1 - c) for (_, n, _), c in zip(weighted, of)]
            fires.append([min(max((sum(x * v[j] for x, (v, _, _) in zip(w, weighted)) + 0.01) / (sum(w) + 1), 1e-6), 1 - 1e-6) for j in range(len(group))])
        if step == 1:
            group = model.group.tolist()
        for k in keys:
            odds = math.log(prior / (1 - prior))
            for g in set(group):
                mine = [j for j in range(len(group)) if group[j] == g and votes(k)[j]]
                if mine:
                    odds += sum(math.log(fires[1][j] / fires[0][j]) for j in mine) / len(mine)
            chance[k] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    assert {k: pytest.approx(chance[k], rel=1e-6) for k in keys} == model.known


def test_toxicity_recall_and_false_positives(spark):
    rng = random.Random(11)
    prose = lambda: [rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randrange(99)) for _ in range(40)]
    insults = [f"insult{c}word" for c in "abcdefgh"]
    rows = [(i, " ".join(prose() + (rng.sample(insults, 3) if i % 8 == 0 else []))) for i in range(1200)]
    spark = common.ready(spark)
    marks = spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), marks).collect()
    for part in ([r for r in got if r.held_out], got):
        bad, good = ([r.predicted for r in part if (r.doc_id % 8 == 0) == b] for b in (True, False))
        assert sum(bad) >= 0.95 * len(bad) and sum(good) <= 0.02 * len(good)


# -- op8 ---------------------------------------------------------------------------------


def plain_style(text):
    lines = [x for x in text.split("\n") if x.encode().split()]
    words = [w.decode() for w in text.encode().split()]
    n, c = max(len(words), 1), max(len(text), 1)
    threes = Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if threes[g] > 1 for k in range(3)}
    return [
        math.log1p(len(words)), sum(map(len, words)) / n, sum(text.count(x) for x in "#*$%&|<>") / n, (len(lines) - len(set(lines))) / max(len(lines), 1),
        len(again) / n, sum(x in "0123456789" for x in text) / c, sum(x in ".,;:!?" for x in text) / n, len(set(text.split())) / n,
        math.log1p(len(text) / max(len(lines), 1)), (len(text.encode()) - len(text)) / c,
    ]


def test_mixing_posteriors_targets_and_copies_against_a_plain_way(spark, docs, labels):
    spark = common.ready(spark)
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    text = {d["doc_id"]: d["text"] or "" for d in docs}
    style = {i: plain_style(t) for i, t in text.items()}
    known = {x["doc_id"]: x["quality"] for x in labels if x["quality"] is not None and x["doc_id"] in text}
    x = np.array([style[i] for i in sorted(known)])
    mean, sd = x.mean(0), np.maximum(x.std(0), 1e-6)
    z, y = np.c_[(x - mean) / sd, np.ones(len(x))], np.eye(2)[[known[i] for i in sorted(known)]]
    w = np.zeros((11, 2))
    for _ in range(200):  # plain Newton steps on the same penalised likelihood
        p = np.exp(z @ w) / np.exp(z @ w).sum(1, keepdims=True)
        g = z.T @ (p - y) / len(z) + 1e-3 * w
        h = np.block([[(z * (p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ z / len(z) for j in range(2)] for i in range(2)]) + 1e-3 * np.eye(22)
        w = w - np.linalg.solve(h, g.T.ravel()).reshape(2, 11).T
    post = {}
    for i, s in style.items():
        e = np.exp(np.r_[np.clip((np.array(s) - mean) / sd, -8, 8), 1] @ w)
        post[i] = e / e.sum()
    got, domains = mixing.domain_posteriors(table, marks, "quality")
    assert domains == [0, 1]
    rows = got.collect()
    assert max(np.abs(np.array(r.posterior) - post[r.doc_id]).max() for r in rows) < 0.02
    tokens = {r.doc_id: r.tokens for r in rows}
    assert tokens == {i: len(t.encode().split()) for i, t in text.items()}
    mixed = mixing.mixing_rates(table, marks, weights={0: 0.2, 1: 0.8}, budget=5000.0).collect()
    own = {r.doc_id: np.array(r.posterior) for r in rows}
    total = sum(r.rate * own[r.doc_id] * r.tokens for r in mixed)
    assert np.allclose(total, [1000.0, 4000.0], rtol=1e-3)
    assert all(r.copies - r.rate < 1 and r.rate - r.copies < 1 and r.copies >= 0 for r in mixed)


# -- stages and near copies --------------------------------------------------------------


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    passage = prose(80)
    texts = [None, "", " \n\t ", "one", prose(3000), f"{prose(60)} {passage} {prose(70)}", f"{passage} {prose(20)}", passage, passage, "é ü ß 😀 \x00 x"]
    rows = [(i, t, "en", None, None) for i, t in enumerate(texts)] + [(7, passage, "en", None, None)] * 2 + [(None, passage, None, "s", 1), (None, None, "en", "s", 1)]
    schema = DOCS + ", " + ", ".join(f"`{c}` string" for c in CLASHES)
    return common.ready(spark).createDataFrame([(*r, *(f"{c}{r[0]}" for c in CLASHES)) for r in rows], schema)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_of_any_name(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, SF)
    rows = got.collect()
    assert stage(spark, odd.where("1 = 0"), SF).count() == 0
    if name == "byte_bpe":
        assert len(rows) == odd.count()
        return
    assert got.columns == odd.columns
    for r in rows:
        assert all(r[c] == f"{c}{r.doc_id}" for c in CLASHES)
    ids = [r.doc_id for r in rows]
    if name == "near_duplicates":
        assert sorted(map(str, ids)) == sorted(map(str, [0, 3, 4, 5, 6, 7, 9, None, None]))
    elif name != "mixing":
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in odd.collect())


def test_rows_without_id_keep_the_links_of_their_text(spark):
    rng = random.Random(13)
    words = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(120)]
    near = words[:60] + ["other"] + words[61:]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, "something else entirely stands here")]
    spark = common.ready(spark)
    for extra in ([], [(None, " ".join(words))], [(None, " ".join(words)), (None, " ".join(near)), (None, None)]):
        got = {(r.doc_id, r.text_key): r.root for r in near_copies.near_copies(spark.createDataFrame(rows + extra, "doc_id long, text string")).collect()}
        roots = defaultdict(set)
        for (i, _), root in got.items():
            roots[i].add(root)
        assert roots[1] == roots[2] and roots[1] != roots[3]
        if extra:
            assert roots[1] <= roots[None]


def test_histograms_never_rule_a_similar_pair_out():
    rng = np.random.default_rng(14)
    ruled_out = 0
    for n in (1, 7, 8, 40, 300, 5000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            keep = a[rng.random(len(a)) < rng.choice([0.95, 0.85, 0.3])]
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, max(1, len(a) // 12)).astype(np.uint64)]))
            may = near_copies.may_be_alike(near_copies.histogram(a), near_copies.histogram(b))
            assert may or not near_copies.alike(a, b)
            ruled_out += not may
    assert ruled_out > 30


def test_fresh_names_differ_in_every_spelling():
    assert common.fresh(["Key", "_KEY", "x"], "key", "x", "y", "y") == ["__key", "_x", "y", "_y"]
    assert substring_dedup.fresh is common.fresh
