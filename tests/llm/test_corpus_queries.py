"""The corpus queries over the smallest tables: against SQL where there is any, else against brute force."""

import base64
import hashlib
import os
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from conftest import SF

import __spark_entry__ as entry
from tools.check import cell

SQL = entry.oracle_sql()
OPS = sorted(n for n in entry.queries() if n.startswith("op"))


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def of(name):
        if name not in kept:
            kept[name] = entry.queries()[name](spark, SF).collect()
        return kept[name]

    return of


def test_all_thirteen_and_the_pipeline_are_registered():
    assert sorted(n.split("_")[0] for n in OPS) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in OPS if n in SQL])
def test_against_sql(result, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(SQL[name])
    columns = sorted(rel.columns)
    want = rel.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(r[c] for c in columns) for r in result(name)]
    assert sorted(tuple(map(cell, r)) for r in got) == sorted(tuple(map(cell, r)) for r in want)


def words(text):
    return (text or "").encode().lower().split()


def brute_ppm(learned, order):
    """Method D with exclusion, symbol by symbol, over dictionaries of exact fractions."""
    counts = {}
    for line in learned:
        s = b"\0" * order + line + b"\n"
        for i in range(order, len(s)):
            for j in range(order + 1):
                counts.setdefault(s[i - j : i], Counter())[s[i]] += 1

    def p(context, symbol):
        gone, chance = set(), Fraction(1)
        for j in range(len(context), -1, -1):
            seen = counts.get(context[len(context) - j :])
            if seen is None:
                continue
            left = {k: v for k, v in seen.items() if k not in gone}
            total = 2 * sum(left.values())
            if symbol in left:
                return chance * Fraction(2 * left[symbol] - 1, total)
            if left:
                chance *= Fraction(len(left), total)
            gone = set(seen)
        return chance / (256 - len(gone))

    def score(line):
        s = b"\0" * order + line + b"\n"
        return sum(float(np.log10(float(p(s[i - order : i], s[i])))) for i in range(order, len(s)))

    return score


def test_op1_base_and_model(docs, result):
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs}
    known = Counter(w for d in docs if not held[d["doc_id"]] for w in [*words(d["text"]), b""])
    n, v = sum(known.values()), len(known)
    score = brute_ppm([b" ".join(words(d["text"])) for d in docs if not held[d["doc_id"]]], 5)
    got = {r.doc_id: r for r in result("op1_ppm")}
    assert len(got) == len(docs) == len(result("op1_ppm"))
    for d in docs:
        tokens, r = [*words(d["text"]), b""], got[d["doc_id"]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d["doc_id"]], len(tokens), sum(w in known for w in tokens), n)
        assert r.base_score == pytest.approx(sum(np.log10((known[w] + 1) / (n + v + 1)) for w in tokens))
    for d in sorted(docs, key=lambda d: len(d["text"] or ""))[:60]:
        assert got[d["doc_id"]].score == pytest.approx(score(b" ".join(words(d["text"]))), rel=1e-5)


def test_op1_one_context_sums_to_one():
    from farelake.llm.ppm import build_levels, log_probabilities, text_nodes

    nodes, _ = text_nodes([b"abracadabra", b"banana band"], 4)
    kinds, counts = np.unique(nodes, return_counts=True)
    levels = build_levels(kinds, counts, 4)
    for context in (b"\0\0\0\0", b"zzan", b"aban", b"qqqq"):
        packed = int.from_bytes(context[::-1], "big")
        every = np.array([packed << 8 | s for s in range(256)], np.uint64)
        assert (10 ** log_probabilities(every, levels)).sum() == pytest.approx(1)


def brute_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, radius):
    """Smallest id reachable over links of ``radius`` bits, by repeated search over all pairs."""
    root = {i: i for i in prints}
    ids = sorted(prints)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_op2_against_all_pairs(docs, result):
    prints = {d["doc_id"]: brute_fingerprint(d["text"]) for d in docs}
    groups = brute_groups(prints, 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in result("op2_simhash")}
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in prints}


def test_op6_separates_toxic_documents(docs, result):
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = result("op6_toxicity")
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    clean = [r for r in rows if toxic.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_op7_against_the_rank_file_library(docs, result):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: tuple(r)[1:] for r in result("op7_byte_bpe")}
    for d in docs:
        ids = coder.encode_ordinary(d["text"] or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (d["text"] or "").encode())]
        assert got[d["doc_id"]] == (len(ids), *digest)


def test_op8_reaches_its_targets(docs, result):
    rows = result("op8_mixing")
    assert len(rows) == len(docs)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    total = sum(r.tokens for r in rows)
    assert sum(r.rate * r.tokens for r in rows) == pytest.approx(total, rel=1e-4)


def test_op9_held_out_accuracy(docs, result):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    rows = [r for r in result("op9_language_codes") if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows)


@pytest.mark.skipif(os.environ.get("SKIP_QUERIES") == "1", reason="left out on request")
def test_pipeline_stage_by_stage(spark, docs):
    from test_corpus_whole import brute_near_copies

    import corpus_pipeline as c
    from farelake.llm.common import stored

    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in c.STAGES:
        before, rows = rows, stored(stage(spark, rows, SF), "test")
        seen[name] = (before.collect(), rows.collect())
        if name != c.STAGES[-1][0]:
            assert rows.columns == columns
    before, after = seen["near_duplicates"]
    roots, _ = brute_near_copies({r.doc_id: r.text for r in before})
    assert sorted(r.doc_id for r in after) == sorted(set(roots.values()))
    before, after = seen["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = seen["byte_bpe"]
    assert sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in before) == sorted((r.doc_id, r.decoded_sha256) for r in after)
