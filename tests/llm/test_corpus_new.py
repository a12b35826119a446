"""Token files, whitening and hard negatives: odd rows, brute force, the parts of each method."""

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF
from tokenizers import Tokenizer

from farelake.llm import common, hard_negatives, token_files, whitening

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def definition():
    with open(WORDS, encoding="utf-8") as f:
        return f.read()


def brute_files(rows, tokenizer):
    """(doc_id, start, n_tokens, crc32) in ascending order of the ids, NULL first."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_hold_every_document(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    common.ready(spark)
    got = token_files.token_file_round_trip(docs, WORDS).collect()
    assert sorted(map(tuple, got)) == brute_files([tuple(r) for r in docs.collect()], tokenizer)


def test_token_files_of_odd_rows(spark, tokenizer, tmp_path):
    rng = random.Random(1)
    long = " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 12))) for _ in range(300_000))
    rows = [(5, None), (3, ""), (9, "  \n\t "), (2, "one"), (4, long), (8, "é Ü ß İ 😀 \x00 ﬁ é don't it''s x y"), (7, "<|endoftext|> a<|startoftext|>"), (-1, "x" * 50_000)]
    df = common.ready(spark).createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, start string, part int")
    got = token_files.token_file_round_trip(df, WORDS, with_ids=True).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute_files(rows, tokenizer)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got}
    assert ids == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    assert token_files.token_file_round_trip(df.where("1 = 0"), WORDS).count() == 0
    alone = token_files.token_file_round_trip(df.where("doc_id = 3"), WORDS).collect()
    assert [tuple(r)[:3] for r in alone] == [(3, 0, 1)]


def test_a_hot_id_is_dealt_to_several_files_in_order(spark, tokenizer, tmp_path):
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(60))
    same = prose()
    rows = [(i, prose()) for i in range(60)] + [(30, same)] * 80 + [(None, same)] * 40 + [(None, prose()) for _ in range(5)]
    df = common.ready(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = token_files.write_token_files(df, str(tmp_path), definition(), 2, file_bytes=2_000)
    back = token_files.read_token_files(files).collect()
    tokens = sum(r.n_tokens for r in back)
    placed = sorted(back, key=lambda r: r.start)
    assert [r.start for r in placed] == [sum(x.n_tokens for x in placed[:k]) for k in range(len(placed))]
    order = [(r.doc_id is not None, r.doc_id or 0) for r in placed]
    assert order == sorted(order) and len(placed) == len(rows)
    made = files.collect()
    assert sum(f.tokens for f in made) == tokens and max(f.tokens for f in made) < tokens / 4
    count = lambda found: sorted((str(r[0]), r[-1]) for r in found)
    assert count([(r.doc_id, r.ids_crc32) for r in back]) == count([(r[0], r[3]) for r in brute_files(rows, tokenizer)])


def test_damage_is_noticed(spark, tmp_path):
    df = common.ready(spark).createDataFrame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string")
    path = token_files.write_token_files(df, str(tmp_path), definition(), 2).first().path.removeprefix("file://")
    whole = open(path, "rb").read()
    for broken, message in ((whole[:-30], "damaged|within a block"), (whole[:-40] + bytes([whole[-40] ^ 1]) + whole[-39:], "damaged"), (b"x" + whole, "not a token file")):
        with pytest.raises(ValueError, match=message):
            for _, _, pieces in token_files.read_blocks(pa.BufferReader(broken)):
                list(pieces)


def test_words_are_cut_as_the_library_cuts_texts(tokenizer):
    rng = random.Random(3)
    letters = [chr(c) for c in (*range(1, 0x250), 0x300, 0x301, 0x327, 0x345, 0x3A3, 0x1C4, 0x1E9E, 0x2028, 0x3000, 0x212B, 0xFB01, 0x4E2D, 0x1F600, 0x200B)]
    texts = ["".join(rng.choice(letters if rng.random() < 0.3 else "abcdeES 'stlrvm\n\t.,0123é") for _ in range(rng.randrange(60))) for _ in range(5000)]
    encoder = token_files.TextEncoder(definition())
    assert encoder.by_word
    for part in (texts, texts[::-1]):  # the second time from what it remembers
        ids, ends = encoder.encode(pa.array(part))
        got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        assert got == [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]


def test_a_file_of_another_kind_is_read_text_by_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        encoder = token_files.TextEncoder(f.read())
    assert not encoder.by_word
    ids, ends = encoder.encode(pa.array(["Hello  world", None, "x"]))
    t = Tokenizer.from_file(path)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [t.encode(x, add_special_tokens=False).ids for x in ("Hello  world", "", "x")]


def huffman_bits(counts):
    heap = [(int(c), i, 0) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    bits, n = 0, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        bits, n = bits + a[0] + b[0], n + 1
        heapq.heappush(heap, (a[0] + b[0], n, 0))
    return bits


@pytest.mark.parametrize("seed", range(4))
def test_code_lengths_are_optimal_and_limited(seed):
    rng = np.random.default_rng(seed)
    counts = rng.zipf(1.3, 500).clip(0, 10**9) * rng.integers(0, 2, 500)
    for most in (9, 12, 40):
        lengths = token_files.code_lengths(counts, most).astype(int)
        assert lengths.max() <= most and ((lengths > 0) == (counts > 0)).all()
        assert sum(1 << (most - n) for n in lengths if n) == 1 << most
        bits = int((lengths * counts).sum())
        assert bits >= huffman_bits(counts) and (most < 40 or bits == huffman_bits(counts))
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(5, int), 2)
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])  # needs nine bits without a limit
    assert token_files.code_lengths(fib, 5).max() == 5 and token_files.code_lengths(fib, 9).max() == 9


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_codes_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.2, n).clip(1, 999).astype(np.uint32)
    ends = np.unique(np.concatenate([[0, n], rng.integers(0, n + 1, 6)]))
    ends = np.sort(np.concatenate([ends, ends[:1], ends[-1:]]))  # empty documents at both ends
    lengths = token_files.code_lengths(np.bincount(ids, minlength=1000), 20)
    bits, at, marks, marked = token_files.code_documents(ids, ends, lengths, token_files.canonical_codes(lengths))
    absolute = marks.astype(np.int64) + np.repeat(8 * at[:-1], np.diff(marked))
    pieces = token_files._decoded(token_files.Decoder(lengths), np.diff(ends), absolute, bits)
    found = {d: p for d, p in pieces}
    for d, (a, b) in enumerate(zip(ends, ends[1:])):
        assert np.array_equal(found.get(d, np.zeros(0)), ids[a:b])


# -- whitening -------------------------------------------------------------------------


def brute_whitening(rows, k, scale=256):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    size = max((len(v) for _, v in fine), default=0)
    x = np.array([[int(np.floor(scale * float(c))) for c in v] + [0] * (size - len(v)) for _, v in fine], object)
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, sums = len(fit), fit.sum(0)
    y = (fit.astype(float) - sums.astype(float) / n)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (x.astype(float) - sums.astype(float) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    return [i for i, _ in fine], n, [int(((n * r - sums) ** 2).sum()) for r in x], white, values / values.sum()


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=9) * np.arange(1, 10)]) for i in range(300)]
    rows += [rows[3]] * 200 + [(7, rows[9][1]), (None, rows[8][1]), (400, None), (401, [1.0, None] + [0.0] * 7), (402, [float("nan")] * 9), (403, [float("inf")] + [0.0] * 8), (404, [2.0, -1.0])]
    df = common.ready(spark).createDataFrame([(i, v, 1.0, "c") for i, v in rows], "vec_id long, embedding array<float>, n double, component string")
    got = whitening.whiten(df).collect()
    ids, n, deviation, white, explained = brute_whitening(rows, 4)
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-12
    key = lambda i, d: (i is None, i or 0, d)
    order = sorted(range(len(ids)), key=lambda j: (key(ids[j], deviation[j]), tuple(white[j])))
    for c in range(4):
        mine = [r for r in got if r.component == c + 1]
        assert sorted((key(r.vec_id, r.deviation) for r in mine)) == sorted(key(i, d) for i, d in zip(ids, deviation))
        assert all(r.explained == pytest.approx(explained[c], rel=1e-12) for r in mine)
        by_id = {r.vec_id: r.whitened for r in mine if r.vec_id not in (None, 7)}
        want = {ids[j]: white[j, c] for j in order if ids[j] not in (None, 7)}
        sign = np.sign(sum(by_id[i] * want[i] for i in want))
        assert np.allclose([sign * by_id[i] for i in want], list(want.values()), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("rows, components", [([], 0), ([(1, [1.0, 2.0])] * 3, 0), ([(1, []), (2, [])], 0), ([(1, [0.0, 1.0]), (2, [1.0, 1.0])], 1), ([(1, None)], 0)])
def test_whitening_of_few_dimensions(spark, rows, components):
    df = common.ready(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whiten(df).collect()
    assert len(got) == components * len(rows)
    assert {abs(round(r.whitened, 12)) for r in got} <= {1.0} and all(r.identity_error < 1e-12 for r in got)


def test_whitening_stays_exact_for_large_numbers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in 2.0**38 + 2.0**33 * rng.normal(size=3)]) for i in range(60)] + [(99, [1e38, 0.0, 0.0])]
    df = common.ready(spark).createDataFrame(rows, "vec_id long, embedding array<float>")
    got = whitening.whiten(df, components=2).collect()
    assert len(got) == 120 and all(r.identity_error < 1e-9 and r.deviation is None for r in got)


@pytest.mark.parametrize("name, values", [
    ("spread", np.linspace(1, 100, 40)), ("multiple", np.array([9.0] * 5 + [4.0] * 10 + [1.0] * 3)), ("zero", np.zeros(6)),
    ("close", np.concatenate([50 * (1 + 1e-9 * np.arange(4)), np.linspace(1, 40, 30)])), ("closer", np.concatenate([50 * (1 + 1e-13 * np.arange(3)), np.linspace(1, 40, 30)])),
    ("decay", 10.0 ** -np.arange(0, 14, 0.5)),
])
def test_eigenvectors_are_refined_to_double_precision(name, values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined_eigen(a, np.zeros_like(a))
    wide = a.astype(np.longdouble)
    assert float(np.abs(wide @ x - x * found).max()) <= 1e-16 * max(values.max(), 1)
    assert float(np.abs(x.T @ x - np.eye(len(a))).max()) < 1e-16
    assert np.all(np.diff(found) <= 0) and np.allclose(found.astype(float), np.sort(values)[::-1], atol=1e-12 * max(values.max(), 1))


# -- hard negatives --------------------------------------------------------------------


def brute_negatives(rows, positives, negatives, every, scale=256, low=30, high=90):
    fine = [(i, [int(np.floor(scale * float(c))) for c in v], y) for i, v, y in rows if y is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for a, (i, v, y) in enumerate(fine):
        if i is None or i % every:
            continue
        scored = [(j, sum(p * q for p, q in zip(v, w)), z) for b, (j, w, z) in enumerate(fine) if b != a]
        for pid, p, _ in sorted((r for r in scored if r[2] == y), key=order)[:positives]:
            kept = sorted((r for r in scored if r[2] != y and low * p <= 100 * r[1] <= high * p), key=order)[:negatives]
            out += [(i, pid, n + 1, r[0], p, r[1]) for n, r in enumerate(kept)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16, 4096])
@pytest.mark.parametrize("kind", ["plain", "odd"])
def test_negatives_against_brute_force(spark, monkeypatch, kind, block):
    monkeypatch.setattr(hard_negatives, "ROWS_PER_BUCKET", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_BLOCK", block)
    rng = np.random.default_rng(block)
    rows = [(i, [round(float(c), 2) for c in rng.normal(size=5) * rng.choice([0.3, 1, 4])], int(rng.integers(0, 3))) for i in range(250)]
    if kind == "odd":
        rows += [(300 + i, rows[20][1], rows[20][2] if i % 2 else 9) for i in range(60)] + [(400 + i, [0.0] * 5, i % 2) for i in range(30)]
        rows += [rows[10]] * 15 + [(10, [9.0] * 5, 0), (None, rows[0][1], 1), (None, rows[0][1], 2), (500, None, 1), (510, [1.0, None, 0.0, 0.0, 0.0], 1)]
        rows += [(520, [float("inf")] * 5, 1), (530, rows[1][1], None), (540, [2.0, -1.0], 0), (550, [], 1), (560, [1e30] * 5, 1)]
    df = common.ready(spark).createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, rank string")
    got = hard_negatives.hard_negatives(df, positives=3, negatives=4, every=10).collect()
    clean = [(i, None if v is None or 1e30 in v else [None if c is None else float(np.float32(c)) for c in v], y) for i, v, y in rows]
    assert sorted(map(tuple, got), key=str) == brute_negatives(clean, 3, 4, 10)


def test_negatives_of_nothing(spark):
    df = common.ready(spark).createDataFrame([(100, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df).count() == hard_negatives.hard_negatives(df.where("1 = 0")).count() == 0


def test_coordinate_lists_lose_no_row_and_prune():
    rng = np.random.default_rng(6)
    rows = (rng.normal(size=(2000, 6)) * 100).astype(np.int64)
    bucket = hard_negatives.Bucket(rows)
    kept = 0
    for q in (rng.normal(size=(40, 6)) * 100).astype(np.int64):
        for share in (-0.5, 0.0, 0.3, 0.6, 0.9, 1.1):
            least = int(share * np.sqrt((q * q).sum()) * bucket.longest)
            found = set(bucket.candidates(q, least).tolist())
            assert set(np.flatnonzero(rows @ q >= least).tolist()) <= found
            kept += len(found) if share >= 0.6 else 0
        assert np.array_equal(bucket.products(q, np.array([3, 5, 8])), rows[[3, 5, 8]] @ q)
    assert kept < 0.2 * 40 * 3 * len(rows)


def test_coordinate_range_is_the_extent_of_a_cap():
    angle = np.linspace(0, np.pi, 2001)
    for q in (-1.0, -0.6, 0.0, 0.3, 1.0):
        for cosine in (-0.5, 0.1, 0.8, 1.0):
            near = np.abs(angle - np.arccos(q)) <= np.arccos(cosine) + 1e-3
            low, high = hard_negatives.coordinate_range(np.array([q]), np.array([cosine]))
            assert low[0] == pytest.approx(np.cos(angle[near]).min(), abs=3e-3) and high[0] == pytest.approx(np.cos(angle[near]).max(), abs=3e-3)
