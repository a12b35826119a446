"""The near-copy stage: SimHash proposes, the exact search completes, and no large group is listed pair by pair."""

import random

import numpy as np
from pyspark.sql import functions as F
from test_corpus_whole import brute_near_copies

from farelake.llm import common, graph, near_copies, simhash

BITS = [1 << b for b in range(64)]


def _components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_direct_links_are_pairs_within_the_radius_and_join_the_same(spark):
    rng, prints = random.Random(21), set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(12):
            prints.add(x)
            for b in rng.sample(BITS, rng.choice([1, 3, 5, 7])):
                x ^= b
    spark = common.ready(spark)
    rows = spark.createDataFrame([(_signed(x),) for x in prints], "fp long").repartition(3)
    for radius in (3, near_copies.RADIUS):
        got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.link_fingerprints(rows, radius, direct=True).collect()]
        assert all(0 < (a ^ b).bit_count() <= radius for a, b in got)
        brute = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius]
        assert _components(prints, got) == _components(prints, brute)


def test_the_stage_proposes_pairs_by_fingerprint(spark, monkeypatch):
    rng = random.Random(22)
    words = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(600)]
    texts = [" ".join(words[:at] + ["other"] + words[at + 1 :]) for at in range(0, 600, 60)] + ["something else stands here"]
    asked = []
    own = near_copies._proposed
    monkeypatch.setattr(near_copies, "_proposed", lambda sets, radius: asked.append(own(sets, radius).collect()) or own(sets, radius))
    docs = common.ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    roots = {r.doc_id: r.root for r in near_copies.near_copies(docs).collect()}
    assert len(set(roots.values())) == 2 and len({roots[i] for i in range(10)}) == 1
    fps = {int(np.uint64(near_copies.xxhash.xxh64_intdigest(near_copies.shingle_set(t).tobytes())).astype(np.int64)): simhash.fingerprint(t, 5) for t in texts}
    brute = [(a, b) for a in fps for b in fps if a < b and ((fps[a] ^ fps[b]) % (1 << 64)).bit_count() <= near_copies.RADIUS]
    assert _components(fps, [(r.a, r.b) for r in asked[0]]) == _components(fps, brute)


def test_a_group_that_meets_but_is_barely_alike_is_not_listed_pair_by_pair(spark, monkeypatch):
    """Edits lie so that few of the pairs reach the threshold, as in a large group of near copies."""
    rng = random.Random(23)
    base, texts = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(145)], []
    for i in range(300):
        new = list(base)
        for at in rng.sample(range(5, 140), 2):
            new[at] = f"x{i}"
        texts.append(" ".join(new))
    monkeypatch.setattr(near_copies, "CROWD", 8)
    own, seen = near_copies.stored, []

    def stored(df, label, compression=None):
        out = own(df, label, compression)
        if label in ("pairs", "close"):
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "stored", stored)
    docs = common.ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, first = {r.doc_id: r.root for r in near_copies.near_copies(docs).orderBy(F.col("doc_id")).collect()}, {}
    for i in sorted(got):
        first.setdefault(got[i], i)
    assert {i: first[r] for i, r in got.items()} == brute_near_copies(dict(enumerate(texts)))[0]
    assert sum(seen) < 300 * 299 / 2 / 2


def test_components_by_blocks_are_those_by_rounds(spark):
    rng = random.Random(24)
    pairs = [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] + [(i, i + 1) for i in range(2000, 2200)] + [(5, 5), (None, 3)]
    links = common.ready(spark).createDataFrame(pairs, "a long, b long").repartition(3)
    plain = {(r.node, r.root) for r in graph.components(links).collect()}
    for block in (200, 10_000):
        assert {(r.node, r.root) for r in graph.components(links, block=block).collect()} == plain
    assert graph.components(links.limit(0), block=90).count() == 0


def test_a_round_with_leaders_costs_few_tables(spark, monkeypatch):
    """Each table is a job and a file for each task; links known before are not gone through again in every round."""
    rng = random.Random(25)
    base, texts = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(145)], []
    for i in range(120):
        new = list(base)
        for at in rng.sample(range(5, 140), 2):
            new[at] = f"x{i}"
        texts.append(" ".join(new))
    monkeypatch.setattr(near_copies, "CROWD", 8)
    labels = []
    for module in (near_copies, graph):
        own = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, compression=None, own=own: labels.append(label) or own(df, label, compression))
    docs = common.ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, first = {r.doc_id: r.root for r in near_copies.near_copies(docs).collect()}, {}
    for i in sorted(got):
        first.setdefault(got[i], i)
    assert {i: first[r] for i, r in got.items()} == brute_near_copies(dict(enumerate(texts)))[0]
    assert labels.count("leaders") > 2
    assert len(labels) <= 12 * (labels.count("leaders") + 2)


def test_proposed_pairs_do_not_multiply_with_tasks(spark, monkeypatch):
    """Each task of the SimHash search joins a group of near copies once more; a set is checked on a few pairs all the same."""
    rng = random.Random(26)
    base, texts = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(300)], []
    for i in range(150):
        new = list(base)
        for at in rng.sample(range(5, 295), 4):
            new[at] = f"x{i}"
        texts.append(" ".join(new))
    own, asked = near_copies._verified, []
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or own(pairs, *rest))
    docs = common.ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for key, value in zip(held, ("24", "false")):
            spark.conf.set(key, value)
        got, first = {r.doc_id: r.root for r in near_copies.near_copies(docs).collect()}, {}
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    for i in sorted(got):
        first.setdefault(got[i], i)
    assert {i: first[r] for i, r in got.items()} == brute_near_copies(dict(enumerate(texts)))[0]
    assert 0 < asked[0] <= 2 * len(texts)
    assert asked[-1] < len(texts) * (len(texts) - 1) / 2 / 10  # nor does the last comparison list the group


def test_cells_find_the_pairs_that_brute_force_finds(spark, monkeypatch):
    rng = random.Random(27)
    base, texts = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(145)], []
    for i in range(60):
        new = list(base)
        for at in rng.sample(range(5, 140), rng.choice([1, 2, 3])):
            new[at] = f"x{i}"
        texts.append(" ".join(new))
    docs = common.ready(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("text_key", F.xxhash64("text"))
    sets = docs.withColumn("set_key", F.col("doc_id"))
    shingles = [near_copies.shingle_set(t) for t in texts]
    rows = [(token, i, len(shingles[i]), 0, i // 2, 60) for token in (7, 8) for i in range(60)]
    crowd = spark.createDataFrame(rows, "token long, set_key long, n int, at int, root long, rows long")
    brute = {(a, b) for a in range(60) for b in range(a) if a // 2 != b // 2 and near_copies.alike(shingles[a], shingles[b])}
    for cell in (1024, 16):
        monkeypatch.setattr(near_copies, "CELL", cell)
        got = {(r.b, r.a) for r in near_copies._crowded_pairs(crowd, sets, docs, 5).collect()}
        assert brute and brute <= got and len(got - brute) <= 0.1 * len(brute)
