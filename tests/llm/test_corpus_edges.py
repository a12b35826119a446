"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random

import numpy as np
import pytest
from test_corpus_queries import brute_fingerprint, brute_groups

from farelake.llm import byte_bpe, common, graph, language_codes, mixing, ppm, quality_rules, simhash, substring_dedup, topk_search, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, score string, rank string, copies string"


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with every oddity, and columns whose names the operators use themselves."""
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    passage = prose(80)
    texts = [None, "", "  \n\t ", "one", "two words", prose(30_000), f"{prose(60)} {passage} {prose(70)}", f"{passage} {prose(20)}",
             f"{prose(9)} {passage}", passage, passage, "é ü   ß 😀 \x00 x", "!!! 123 #$%", prose(200)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "src0", None, i, "s", "r", "c") for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, passage, None, None, 1, 1, "s", "r", "c"), (None, None, "en", "src1", 1, 1, "s", "r", "c")]
    return common.ready(spark).createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 1), (3, None, 0), (6, 1, None), (7, 0, 0), (7, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def none_of(df):
    return df.where("1 = 0")


def brute_kept(rows, window):
    """Words left of each (id, text): the rule as it reads."""
    last = max((i for i, _ in rows if i is not None), default=0) + 1
    words = [((last if i is None else i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = {at + k for at in range(len(w) - window + 1) if first[tuple(w[at : at + window])] < i for k in range(window)}
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def test_substring_rule(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = sorted((str(i), len((t or "").encode().split()), hashlib.sha256(b" ".join(k)).hexdigest()) for (i, t), k in zip(rows, brute_kept(rows, 50)))
    got = substring_dedup.substring_dedup(odd).collect()
    assert sorted((str(r.doc_id), r.n_words, r.kept_sha256) for r in got) == want
    assert substring_dedup.remove_repeats(odd).columns == odd.columns
    assert substring_dedup.substring_dedup(none_of(odd)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_substring_rule_on_dense_repeats(spark, seed):
    rng = random.Random(seed)
    parts = [[rng.choice("ab") + str(rng.randrange(3)) for _ in range(rng.randrange(3, 14))] for _ in range(12)]
    rows = [(i, " ".join(w for _ in range(rng.randrange(1, 9)) for w in rng.choice(parts))) for i in range(60)]
    rng.shuffle(rows)
    docs = common.ready(spark).createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in substring_dedup.substring_dedup(docs, window=10, seed=4).collect()}
    assert got == {i: b" ".join(k).decode() for (i, _), k in zip(rows, brute_kept(rows, 10))}


def test_simhash_edges(odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    rows = [r for r in odd.collect() if r.doc_id is not None]
    groups = brute_groups({r.doc_id: brute_fingerprint(r.text) for r in rows}, 3)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == groups
    assert simhash.near_duplicates(none_of(odd)).count() == 0


@pytest.mark.parametrize("parts, block", [(4, 4096), (4, 8), (8, 4096)])
def test_links_of_crowded_fingerprints(spark, parts, block):
    rng = random.Random(block + parts)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {x ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(7))) for x in base for _ in range(60)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = common.ready(spark).createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.node: r.root for r in graph.components(simhash.link_fingerprints(df, 3, parts, block)).collect()}
    want = brute_groups({x: x & (1 << 64) - 1 for x in signed}, 3)
    assert {x: roots.get(x, x) for x in signed} == want


def test_thresholds_add_up_and_balls_count():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 5, 1 << 6)
    balls = simhash.ball_counts(counts, 6, 3)
    for t in range(4):
        assert balls[t][9] == sum(counts[v] for v in range(64) if (v ^ 9).bit_count() <= t)
    values = rng.integers(0, 64, (4, 50))
    chosen = simhash.allocate(values, np.stack([balls] * 4), 3, 6)
    assert (chosen.sum(0) == 3 - 4 + 1).all() and (chosen >= -1).all()


def test_components_of_a_long_chain(spark):
    links = common.ready(spark).createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {500: 400}


def test_ppm_edges(odd):
    rows = ppm.ppm_scores(odd).collect()
    assert len(rows) == odd.count()
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert ppm.ppm_scores(none_of(odd)).count() == 0
    nothing = ppm.score_documents(odd.selectExpr("doc_id", "text", "false AS learns")).where("doc_id = 3").first()
    assert nothing.score == pytest.approx(-4 * np.log10(256)) and nothing.train_tokens == 0


def test_bpe_edges(odd):
    import public_tokenizers

    args = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = byte_bpe.encode_bpe(odd.withColumn("ids", odd["lang"]), *args)
    assert coded.columns == [*odd.columns, "ids"]
    back = byte_bpe.decode_bpe(coded, *args).collect()
    assert all((r.decoded or b"").decode() == (r.text or "") for r in back) and len(back) == odd.count()
    assert byte_bpe.bpe_round_trip(none_of(odd), *args).count() == 0


def test_quality_edges(odd):
    rows = quality_rules.adaptive_quality(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert {r.kept for r in rows if r.doc_id == 13} == {True}
    assert quality_rules.adaptive_quality(none_of(odd)).count() == 0
    assert quality_rules.measure_text("a b c a b c") == (6, 6, 0, 1, 0, 6)
    assert quality_rules.measure_text("x\ny\n \nx\n# &") == (5, 5, 2, 4, 1, 0)


def test_sketch_bins_are_exact_and_mergeable(spark):
    import pyspark.sql.functions as F

    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123_456, 10**9]
    df = common.ready(spark).createDataFrame([(v,) for v in values], "v long")
    for r in df.select("v", quality_rules.bin_top(quality_rules.sketch_bin(F.col("v"))).alias("top")).collect():
        assert r.v <= r.top <= r.v + r.v // 32


def test_language_edges(odd):
    rows = language_codes.identify_languages(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (0, 1, 2, 12))
    assert language_codes.identify_languages(none_of(odd)).count() == 0
    unlabelled = language_codes.identify_languages(odd.withColumn("lang", odd["lang"].substr(99, 1)).replace("", None, "lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 3, 5, 6, 40])
def test_codewords_differ(n):
    code = language_codes.codewords(n)
    assert len({tuple(r) for r in code}) == n and not (np.abs(code.astype(int).sum(0)) == n).any()


def test_toxicity_edges(odd, labels):
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(none_of(odd), labels).count() == 0
    assert {r.predicted for r in toxicity.toxicity(odd, none_of(labels)).collect()} == {0}


def test_toxicity_learns_words_and_beginnings(spark):
    rng = random.Random(5)
    prose = lambda: [rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randrange(99)) for _ in range(40)]
    rows, marks = [], []
    for i in range(900):
        bad = i % 6 == 0
        extra = [("blockhead" if i % 4 == 0 else f"grobian{rng.randrange(500)}")] if bad else []
        rows.append((i, " ".join(prose() + extra)))
        marks.append((i, int(bad)))
    spark = common.ready(spark)
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    got = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    wrong = [r for r in got if r.predicted != (r.doc_id % 6 == 0)]
    assert len(got) > 100 and len(wrong) <= 0.02 * len(got)


def test_mixing_edges(odd, labels):
    rows = mixing.mixing_rates(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.rate >= 0 for r in rows)
    assert mixing.mix(odd, labels).columns == odd.columns
    assert mixing.mixing_rates(none_of(odd), labels).count() == 0 and mixing.mix(none_of(odd), labels).count() == 0
    assert mixing.mixing_rates(odd, none_of(labels)).count() == odd.count()


def test_rates_match_a_plain_solver(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.4, 0.4, 0.4], 400)
    tokens = rng.integers(1, 2000, 400)
    df = common.ready(spark).createDataFrame([(i, i, int(t), [float(v) for v in x]) for i, (t, x) in enumerate(zip(tokens, p))], "doc_id long, text_key long, tokens long, posterior array<double>")
    total = (p * tokens[:, None]).sum(0)
    targets = total.sum() * np.array([0.7, 0.25, 0.05])
    rates = np.array([r[0] for r in df.select(mixing.rate_column(mixing.fit_rates(df, targets))).collect()])
    assert (rates >= 0).all() and (rates == 0).any()
    assert np.allclose((rates[:, None] * p * tokens[:, None]).sum(0), targets, rtol=1e-4)


def brute_top(rows, k, every):
    """Every row for itself, also where ids repeat or are missing."""
    fine = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(fine):
        if i is not None and i % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0) for b, (j, w) in enumerate(fine) if b != a)
            out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(scores[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("n, nodes", [(400, 2), (400, 3), (4, 2), (0, 2)])
def test_search_against_brute_force(spark, n, nodes):
    rng = np.random.default_rng(n + nodes)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=7)]) for i in range(n)]
    if n > 100:
        rows += [(1000 + i, rows[20][1]) for i in range(60)] + [(2000 + i, [0.0] * 7) for i in range(40)]
        rows += [rows[5], rows[50], rows[50], (3000, None), (3010, [1.0, None] + [0.0] * 5), (3020, [float("nan")] * 7), (None, [1.0] * 7), (40, [9.0] * 7)]
        rows += [(3030, [2.0, -1.0]), (3040, [])]
    df = common.ready(spark).createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, q string")
    got = topk_search.exact_top_k(df, k=5, every=10, nodes=nodes).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(rows, 5, 10)


def test_warc_edges(spark, tmp_path):
    long = "<p>é" + "x" * 400_000
    rows = [(1, "http://a/ b\r\n", "same", 0), (2, None, "same", 0), (3, "http://c", None, 0), (4, "http://d", "", 0), (5, "u", long, 0),
            (5, "u", long, 0), (None, "http://n", "same", 0), (None, "http://n", "alone", 0), (9, "http://x", "\r\n\r\nWARC/1.1\r\n", 0)]
    rows += [(100 + i, f"http://s/{i}", f"<html><body>page {i} with some common text</body></html>", 0) for i in range(40)]
    pages = common.ready(spark).createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = warc.archive_round_trip(pages, str(tmp_path)).collect()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id is not None}
    assert len(got) == len(rows)
    assert kinds[1] == ("revisit", 2) and kinds[2] == ("response", None) and kinds[3] == ("revisit", 4) and kinds[4] == ("response", None)
    assert kinds[5] == ("response", None)
    assert sorted((r.record_type, r.refers_to or 0) for r in got if r.page_id is None) == [("response", 0), ("revisit", 2)]
    assert {r.payload_bytes for r in got if r.page_id == 5} == {len(long.encode())}
    assert warc.archive_round_trip(pages.where("1 = 0"), str(tmp_path / "none")).count() == 0


def test_archives_hold_a_dictionary_and_separate_records(spark, tmp_path):
    import struct

    import zstandard

    rng = random.Random(4)
    tongue = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    html = {i: "<html><p class=x>" + " ".join(rng.choices(tongue, k=200)) + "</p></html>" for i in range(150)}
    pages = common.ready(spark).createDataFrame([(i, f"http://s/{i}", h) for i, h in html.items()], "page_id long, url string, html string")
    files = warc.write_archives(pages.coalesce(1), str(tmp_path))
    records = warc.read_archives(files, chunk=7).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in records} == html
    for row in files.collect():
        with open(row.path, "rb") as f:
            magic, size = struct.unpack("<II", f.read(8))
            assert magic == 0x184D2A5D and zstandard.ZstdCompressionDict(f.read(size)).dict_id() > 0
