"""Removal of word passages that an earlier document holds, by seed and extend.

Method: of the word k-grams in each window of ``window`` words, the one with the smallest hash is the window's anchor
(winnowing), so equal windows have equal anchors at the same place. Documents meet on anchors. A seed is extended both
ways to the span of all windows that it anchors; a span that a document with a smaller id holds is a repeat as a whole.
Only where spans under one anchor differ, around the ends of a shared passage, the windows of the first document of
each span are compared one by one, which finds how far the match extends. What overlaps is one maximal repeat.

Every step is a partial aggregate or a join on hashes: an anchor in a third of all documents is one row per task in the
aggregates and is split in the joins, and no pair of documents is ever listed. Anchors are 64-bit hashes (candidates
only); spans and windows compare by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_batches, quoted, stored

SEED_WORDS = 16
LAST = (1 << 63) - 1  # rank of a document without id: after all others
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two rolling hashes
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0..n of the bases and of their inverses modulo 2^64; kept for the task's next texts."""
    if not _powers or len(_powers[0][0]) <= n:
        size = max(1 << 15, 2 * n)
        _powers.clear()
        for base in _BASES:
            pair = []
            for b in (base, pow(base, -1, 1 << 64)):
                factors = np.full(size, b, np.uint64)
                factors[0] = 1
                pair.append(np.multiply.accumulate(factors))
            _powers.append(tuple(pair))
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class WordHashes:
    """128-bit hashes of any run of words of one text, from prefix sums."""

    def __init__(self, words: list[bytes]):
        digest = xxhash.xxh64_intdigest
        h = np.array([digest(w) for w in words], np.uint64)
        self.tables = _power_tables(len(words))
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(h * up[: len(h)])]) for up, _ in self.tables]

    def run(self, start: np.ndarray, length: np.ndarray | int, which: int) -> np.ndarray:
        total, (_, down) = self.sums[which], self.tables[which]
        return _mix((total[start + length] - total[start]) * down[start])


def spans(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, ...]:
    """anchor, two span hashes, start and length in words of each group of windows with a common anchor."""
    hashes = WordHashes(words)
    grams = hashes.run(np.arange(len(words) - seed + 1), seed, 0)
    anchor = np.lib.stride_tricks.sliding_window_view(grams, window - seed + 1).argmin(1)
    anchor += np.arange(len(anchor))
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    length = np.diff(np.r_[first, len(anchor)]) - 1 + window
    return grams[anchor[first]], hashes.run(first, length, 0), hashes.run(first, length, 1), first, length


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: only ASCII blanks separate


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its rank, the text and a hash that tells apart different texts under one id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return kept.withColumns({"rank": F.coalesce("doc_id", F.lit(LAST)), "text_key": F.xxhash64("text")})


def _emit(keyed: DataFrame, schema: str, columns: list[str], per_text) -> DataFrame:
    """Rows of arrays: ``per_text(row)`` returns equally long arrays in front of rank and text_key, or None."""
    names = [x.split()[0] for x in schema.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[np.ndarray, ...]] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            arrays = [np.concatenate([m[i] for m in made]) for i in range(len(names))]
            arrays = [a.view(np.int64) if a.dtype == np.uint64 else a for a in arrays]
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if (arrays := per_text(row)) is not None:
                    n = len(arrays[0])
                    made.append((*arrays, np.full(n, row["rank"]), np.full(n, row["text_key"])))
                    held += n
                if held > 50_000:
                    yield batch_of()
                    made, held = [], 0
        if made:
            yield batch_of()

    return keyed.select(*columns).mapInArrow(run, schema)


def repeats(keyed: DataFrame, window: int = 50, seed: int = SEED_WORDS) -> DataFrame:
    """rank, text_key and ``covers``: (start, length) in words of repeats of earlier documents; one row per text."""
    if not 0 < seed <= window:
        raise ValueError("the seed must fit into the window")

    def anchors(row):
        words = _words(row["text"])
        return spans(words, window, seed) if len(words) >= window else None

    schema = "anchor long, span_a long, span_b long, start int, length int, rank long, text_key long"
    found = stored(_emit(keyed, schema, ["text", "rank", "text_key"], anchors), "anchors")
    # aggregates are written before they are joined: Spark splits a hot key only between plain shuffles
    shared = found.groupBy("anchor").agg(
        F.min("rank").alias("r0"), F.max("rank").alias("r1"), (F.min("span_a") != F.max("span_a")).alias("differ")
    ).where("r0 < r1")
    shared = stored(shared.select("anchor", "differ"), "shared_anchors")
    seeds = stored(found.join(shared, "anchor").drop("anchor"), "seeds")
    whole = stored(seeds.groupBy("span_a", "span_b", "length").agg(F.min("rank").alias("first")), "spans")
    judged = stored(
        seeds.join(whole, ["span_a", "span_b", "length"]).select(
            "rank", "text_key", "start", "length", (F.col("first") < F.col("rank")).alias("repeat"), "differ"
        ),
        "judged",
    )
    # the first document of a window is also the first of that window's span, so the others need no comparison
    # repeated rows have equal spans: each counts once, so a list is bounded by its own text
    once = ["rank", "text_key", "start", "length"]
    open_ = judged.where("NOT repeat AND differ").select(*once).distinct().groupBy("rank", "text_key").agg(
        F.collect_list(F.struct("start", "length")).alias("open")
    )

    def windows(row):
        hashes = WordHashes(_words(row["text"]))
        at = np.unique(np.concatenate([np.arange(o["start"], o["start"] + o["length"] - window + 1) for o in row["open"]]))
        return hashes.run(at, window, 0), hashes.run(at, window, 1), at

    single = stored(
        _emit(keyed.join(open_, ["rank", "text_key"]), "win_a long, win_b long, start int, rank long, text_key long",
              ["text", "open", "rank", "text_key"], windows),
        "windows",
    )
    earliest = single.groupBy("win_a", "win_b").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).where("first < last")
    earliest = stored(earliest.drop("last"), "first_windows")
    late = single.join(earliest, ["win_a", "win_b"]).where("first < rank")
    covers = judged.where("repeat").select(*once).unionByName(
        late.select("rank", "text_key", "start", F.lit(window).alias("length"))
    ).distinct()
    return covers.groupBy("rank", "text_key").agg(F.collect_list(F.struct("start", "length")).alias("covers"))


def keep_words(words: list[bytes], covers: list[dict] | None) -> list[bytes]:
    """Words outside the covers."""
    if covers is None or not len(covers):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [c["start"] for c in covers], 1)
    np.add.at(edge, [c["start"] + c["length"] for c in covers], -1)
    kept = np.add.accumulate(edge[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def substring_dedup(docs: DataFrame, window: int = 50, seed: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (words left, joined by one space) of every document.

    A word goes if a run of ``window`` words around it also stands in a document with a smaller id; runs are judged on
    the input. NULL and short texts lose nothing; repeated rows (equal ids) never count as earlier; documents without
    an id come after all others; extra columns are left out; an empty table gives no rows.
    """
    keyed = _keyed(docs)
    joined = keyed.join(repeats(keyed, window, seed), ["rank", "text_key"], "left").select("doc_id", "text", "covers")

    def work(rows):
        made: dict[str, list] = {"doc_id": rows["doc_id"], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        for text, covers in zip(rows["text"], rows["covers"]):
            words = _words(text)
            kept = keep_words(words, covers)
            line = b" ".join(kept)
            made["n_words"].append(len(words))
            made["n_removed"].append(len(words) - len(kept))
            made["kept_sha256"].append(hashlib.sha256(line).hexdigest())
            made["kept_text"].append(line.decode())
        return made

    return map_batches(joined, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string", work)


def remove_repeats(docs: DataFrame, window: int = 50, seed: int = SEED_WORDS) -> DataFrame:
    """The input's rows and columns; texts that lose words become the words left, joined by one space.

    Texts that lose nothing stay as they are, NULLs included. Rules as in ``substring_dedup``.
    """
    names = docs.columns
    own_rank, own_key, of_rank, of_key, cut = fresh(names, "own_rank", "own_key", "of_rank", "of_key", "cut")
    covers = repeats(_keyed(docs), window, seed)
    covers = stored(covers.select(F.col("rank").alias(of_rank), F.col("text_key").alias(of_key), F.col("covers").alias(cut)), "covers")
    rank, key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.withColumns({own_rank: rank, own_key: key})
    rows = rows.join(covers, (F.col(own_rank) == F.col(of_rank)) & (F.col(own_key) == F.col(of_key)), "left")

    @F.pandas_udf("string")
    def left_over(text: pd.Series, of: pd.Series) -> pd.Series:
        return pd.Series([t if c is None else b" ".join(keep_words(_words(t), c)).decode() for t, c in zip(text, of)], dtype=object)

    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(left_over(F.col("text").cast("string"), F.col(cut)))
    return rows.withColumn("text", text).select(*map(quoted, names))
