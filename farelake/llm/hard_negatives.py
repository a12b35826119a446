"""Hard negatives of anchors by exact search with coordinate pruning.

Method: rows are cut into buckets of similar length. An anchor needs rows whose inner product reaches a threshold, so in a
bucket with longest vector l the cosine has to reach threshold / (|anchor| l); a bucket that cannot give it is left out. The
cosine bounds every coordinate of a row to a range around that of the anchor. A bucket keeps its coordinates in sorted lists;
the ranges of the anchor's focus coordinates, its largest ones, are cut out of the lists and intersected, and what is left is
verified by exact whole-number products. Thresholds come from a first search in a hashed sample of the rows, whose k-th
best score the k-th best of all rows cannot miss.

Equal rows (vector and label) are searched once for all their ids. Anchors and rows meet in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .topk_search import _best, keyed_classes, rows_of_classes, without_itself
from .whitening import whole_vectors

ROWS_PER_BUCKET = 4096
ANCHORS_PER_BLOCK = 512
FOCUS = 4  # coordinates whose ranges are intersected
MOST_BOUNDS = 10_000  # lengths at which buckets begin; beyond that hashing divides them further
NO_BOUND = -(1 << 62)


def coordinate_range(q: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that a coordinate of a unit vector can have if its cosine to a unit vector with coordinate ``q`` is reached."""
    at, turn = np.arccos(np.clip(q, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return np.cos(np.minimum(at + turn, np.pi)) - 1e-9, np.cos(np.maximum(at - turn, 0)) + 1e-9


class Bucket:
    """Rows of similar length with sorted lists of their coordinates, made when they are first asked for."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        length = np.sqrt((rows.astype(float) ** 2).sum(1))
        self.longest = float(length.max(initial=0))
        self.units = rows / np.where(length, length, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.most = float(np.abs(rows).max(initial=0))
        self.floats = rows.astype(float)

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.units[:, f], kind="stable")
            self.lists[f] = order, self.units[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, least: int) -> np.ndarray:
        """Places of all rows whose product with ``q`` can reach ``least``, and perhaps some more."""
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        if least <= 0:
            return np.arange(len(self.rows))
        if length * self.longest * (1 + 1e-9) < least:
            return np.zeros(0, np.int64)
        unit, cosine = q / length, least / (length * self.longest) * (1 - 1e-9)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = coordinate_range(unit[focus], np.full(len(focus), cosine))
        spans = []
        for f, lo, hi in zip(focus, low, high):
            order, values = self.sorted_list(int(f))
            a, b = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
            spans.append((b - a, order[a:b], f, lo, hi))
        spans.sort(key=lambda s: s[0])
        found = spans[0][1]
        for _, _, f, lo, hi in spans[1:]:
            value = self.units[found, f]
            found = found[(value >= lo) & (value <= hi)]
        return found

    def products(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact products; by floating point where every sum stays below 2^53."""
        if self.most * float(np.abs(q).max(initial=0)) * max(len(q), 1) >= 2.0**53:
            return self.rows[at] @ q
        few = 4 * len(at) < len(self.rows)
        return (self.floats[at] @ q.astype(float) if few else (self.floats @ q.astype(float))[at]).astype(np.int64)


def _first(score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best by falling score, then by ``order``."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= cut)
        return keep[np.lexsort((order[keep], -score[keep]))][:k]
    return np.lexsort((order, -score))[:k]


def _search(pairs: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(q, turn, cid, score): of each bucket the ``k`` best rows inside each wanted span of scores of each anchor."""
    names = ["q", "turn", "cid", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in range(batch.num_rows):
                rows, asked = batch.column("c")[cell].values, batch.column("q")[cell].values
                width = len(rows[0]["v"].values) if len(rows) else 0
                bucket = Bucket(rows.field("v").flatten().to_numpy().reshape(len(rows), width))
                cid, label, first = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("cid", "label", "first"))
                vectors = asked.field("v").flatten().to_numpy().reshape(len(asked), width)
                spans = asked.field("spans").to_pylist()
                made: dict[str, list] = {n: [] for n in names}
                for i, (own, wanted) in enumerate(zip(asked.field("label").to_pylist(), spans)):
                    at = bucket.candidates(vectors[i], min(s["low"] for s in wanted))
                    at = at[(label[at] == own) == same_label]
                    score = bucket.products(vectors[i], at)
                    for s in wanted:
                        inside = np.flatnonzero((score >= s["low"]) & (score <= s["high"]))
                        best = inside[_first(score[inside], first[at[inside]], k)]
                        made["q"].append(np.full(len(best), asked[i]["cid"].as_py()))
                        made["turn"].append(np.full(len(best), s["turn"]))
                        made["cid"].append(cid[at[best]])
                        made["score"].append(score[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made[n] or [np.zeros(0)]).astype(np.int64)) for n in names], names=names)

    return pairs.mapInArrow(run, "q long, turn long, cid long, score long")


def _cells(queries: DataFrame, buckets: DataFrame, n_queries: int) -> DataFrame:
    """Rows (q, c): a block of anchors and a bucket that may hold something for one of them."""
    blocks = -(-max(n_queries, 1) // ANCHORS_PER_BLOCK)
    least = F.array_min(F.transform("spans", lambda s: s["low"])) / F.sqrt(F.col("square").cast("double"))
    q = queries.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int"))
    q = q.groupBy("block").agg(F.collect_list(F.struct("cid", "label", "v", "spans")).alias("q"), F.min(F.when(F.col("square") > 0, least).otherwise(0.0)).alias("least"))
    c = buckets.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return c.join(q, "block").where(F.col("longest") * (1 + 1e-9) >= F.col("least")).select("q", "c")


def _bucketed(classes: DataFrame, n: int) -> DataFrame:
    """One row per bucket of similar length: its rows and the length of the longest."""
    buckets = -(-max(n, 1) // ROWS_PER_BUCKET)
    ranges = min(buckets, MOST_BOUNDS)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(classes.agg(F.percentile_approx("square", shares, 100 * ranges)).first()[0] or []) if shares else []
    # lengths that several buckets begin with are dealt to all of them
    groups = {c: (int(np.searchsorted(cuts, c)), int(np.searchsorted(cuts, c, "right"))) for c in sorted(set(cuts))}
    starts = list(groups)
    step = F.lit(0)
    if starts:
        bounds = F.array(*(F.lit(int(s)).cast("long") for s in starts))
        found = F.size(F.filter(bounds, lambda b: b <= F.col("square")))
        firsts = F.array(F.lit(0), *(F.lit(groups[s][0] + 1) for s in starts))
        widths = F.array(F.lit(1), *(F.lit(groups[s][1] - groups[s][0]) for s in starts))
        step = F.element_at(firsts, found + 1) + F.pmod(F.xxhash64("cid"), F.element_at(widths, found + 1).cast("long"))
    finer = -(-buckets // ranges)
    named = classes.select("*", step.alias("bucket"), F.pmod(F.xxhash64("cid", F.lit(1)), F.lit(finer)).alias("part"))
    row = F.struct("cid", "label", "first", "v")
    return named.groupBy("bucket", "part").agg(F.collect_list(row).alias("c"), F.sqrt(F.max("square").cast("double")).alias("longest")).select("c", "longest")


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, every: int = 100, scale: int = 256, low: int = 30, high: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``every``; ``positives`` are the first other rows of an anchor's label. For
    each of them come the first ``negatives`` rows of another label whose score s meets low * p <= 100 * s <= high * p for
    the positive's score p. Higher scores come first, ties by smaller vec_id, rows without id last.

    Rows with a NULL label or a vector that is NULL or holds a NULL or non-finite component take no part, nor do vectors
    longer than 2^31 after scaling, whose products exceed a long. Rows that repeat an id are rows of their own, also as
    anchors; rows without id are never anchors. Shorter vectors are filled with zeros. Where there are fewer rows than asked for,
    all come. An empty table gives no rows; extra columns are left out.
    """
    most = max(positives + 1, negatives)
    square = F.expr("aggregate(x, double(0), (s, c) -> s + double(c) * double(c))")
    rows = whole_vectors(vectors.where("label IS NOT NULL"), scale, "label").where(square < 2.0**62)
    rows = stored(rows.select("vec_id", F.col("x").alias("v"), F.col("label").cast("long").alias("label")), "labelled_vectors")
    dot = F.expr("aggregate(v, 0L, (s, c) -> s + c * c)").alias("square")
    classes = stored(keyed_classes(rows, ["v", "label"], most).select("*", dot), "labelled_classes")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v", "label").agg(F.count("*").alias("copies"))
    asked = stored(asked, "anchor_rows").join(classes.select("v", "label", "cid"), ["v", "label"])
    asked = stored(asked.select(F.col("vec_id").alias("anchor_id"), F.col("cid").alias("q"), "copies"), "anchors")
    wanted = classes.join(asked.select(F.col("q").alias("cid")).distinct(), "cid", "left_semi").select("cid", "label", "v", "square")
    wanted = stored(wanted, "anchor_classes")
    n, n_queries = classes.count(), wanted.count()
    buckets = stored(_bucketed(classes, n), "buckets")
    sample = max(ROWS_PER_BUCKET, int(4 * n**0.5))
    part = F.pmod(F.xxhash64("cid", F.lit(2)), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / max(n, 1)) * (1 << 30)))
    sampled = stored(_bucketed(classes.where(part), sample), "sampled_buckets")
    order = [F.col("score").desc(), "first", "cid"]
    firsts = classes.select("cid", "first")

    def best(spans: DataFrame, same_label: bool, k: int) -> DataFrame:
        """(q, turn, cid, score) of the k best rows in each span (cid, turn, low, high)."""
        ask = lambda s: wanted.join(s.groupBy("cid").agg(F.collect_list(F.struct("turn", "low", "high")).alias("spans")), "cid")
        seen = _search(_cells(ask(spans), sampled, n_queries), same_label, k)
        cut = stored(_best(seen, k, ["q", "turn"], [F.col("score").desc()]).where(F.col("_n") == k).select(F.col("q").alias("cid"), "turn", F.col("score").alias("cut")), "cutoffs")
        closer = spans.join(cut, ["cid", "turn"], "left").select("cid", "turn", F.greatest("low", F.coalesce("cut", "low")).alias("low"), "high")
        found = _search(_cells(ask(closer), buckets, n_queries), same_label, k)
        return _best(found.join(firsts, "cid"), k, ["q", "turn"], order).select("q", "turn", "cid", "score")

    all_scores = wanted.select("cid", F.lit(0).cast("long").alias("turn"), F.lit(NO_BOUND).alias("low"), F.lit(-NO_BOUND).alias("high"))
    best_alike = best(all_scores, True, positives + 1).drop("turn")
    near = stored(rows_of_classes(best_alike, classes, ["q"], positives + 1), "positives")
    told = without_itself(asked.join(near, "q"), "anchor_id", ["anchor_id", "q", "copies"], positives)
    told = stored(told.select("anchor_id", "q", "copies", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "anchor_positives")
    p = F.col("positive_score")
    score = p.cast("decimal(20,0)")
    inside = told.select(F.col("q").alias("cid"), p.alias("turn"), F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    inside = stored(inside.where("low <= high").distinct(), "spans")
    far = stored(rows_of_classes(best(inside, False, negatives), classes, ["q", "turn"], negatives), "negatives")
    out = told.join(far.select("q", F.col("turn").alias("positive_score"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank"), ["q", "positive_score"])
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
