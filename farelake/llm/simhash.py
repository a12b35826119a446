"""SimHash near-duplicates by the generalised pigeonhole principle.

Method: fingerprints of 64 bits link at ``radius`` or fewer differing bits. Bits that go together are grouped into
partitions. If every partition i of a pair differs in more than t_i bits and the t_i + 1 add up to radius + 1, the pair
differs in more than radius bits; so each fingerprint may choose its own thresholds (-1: partition not probed) with
that sum. Dynamic programming picks them from estimated candidate counts, which avoids crowded partition values. A
fingerprint is indexed under its own value of each partition and probes the values within its threshold; the
candidates are verified.

Equal fingerprints are joined to one before the search. Crowded values are split into a grid of blocks. A task turns
the links it verifies into a forest, so its output has at most one row for each row it has read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored
from .graph import components, forest

BITS = 64
SEED = 42  # fixed value: seed of the shingle hash
BLOCK = 4096  # candidates of one partition value that meet in one cell


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Signed 64-bit fingerprint over word shingles, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered, only ASCII blanks separate
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    starts = np.concatenate([[0], ends[: len(words) - k] + 1])
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, 1 << 16):
        pairs = zip(starts[at : at + (1 << 16)].tolist(), ends[k - 1 + at : k - 1 + at + (1 << 16)].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(BITS, dtype=np.uint64))[2 * ones > n].sum(dtype=np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """doc_id and fp of every document."""
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = lambda rows: {"doc_id": rows["doc_id"], "fp": [fingerprint(t, words_per_shingle) for t in rows["text"]]}
    return map_batches(kept, "doc_id long, fp long", work)


def _sums(distinct: DataFrame, work, size: int) -> np.ndarray:
    """Add up a vector of ``size`` counts over all fingerprints: one sparse vector per task, summed by position."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            work(total, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)

    found = distinct.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def group_bits(distinct: DataFrame, parts: int) -> list[list[int]]:
    """Deal the bits to ``parts`` partitions of equal size so that correlated bits share one."""

    def work(total, fp):
        for at in range(0, len(fp), 1 << 16):
            bits = ((fp[at : at + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            total[: BITS * BITS] += np.rint(bits.T @ bits).astype(np.int64).ravel()
            total[BITS * BITS] += len(bits)

    total = _sums(distinct, work, BITS * BITS + 1)
    n = max(int(total[-1]), 1)
    both = total[:-1].reshape(BITS, BITS) / n
    mean = np.diag(both)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    alike = np.abs((both - np.outer(mean, mean)) / np.outer(sd, sd)) - 2 * np.eye(BITS)
    free, out = set(range(BITS)), []
    for _ in range(parts):
        a, b = max(combinations(sorted(free), 2), key=lambda p: alike[p])
        group = [a, b]
        while len(group) < BITS // parts:
            group.append(max(sorted(free - {*group}), key=lambda x: alike[x, group].mean()))
        free -= {*group}
        out.append(sorted(group))
    return out


def part_values(fp: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Value of each partition (rows) for each fingerprint (columns)."""
    out = np.zeros((len(groups), len(fp)), np.int64)
    for i, group in enumerate(groups):
        for at, bit in enumerate(group):
            out[i] |= ((fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << at
    return out


def ball_counts(counts: np.ndarray, width: int, radius: int) -> np.ndarray:
    """Fingerprints within t bits of each value, for t = 0..radius, from the counts per value."""
    flips = [np.arange(1 << width) ^ (1 << b) for b in range(width)]
    near = lambda x: sum(x[f] for f in flips)
    rings = [counts.astype(float)]
    for t in range(1, radius + 1):  # neighbours of ring t-1, less those that lie in ring t-2
        inner = (width - t + 2) * rings[t - 2] if t > 1 else 0
        rings.append((near(rings[t - 1]) - inner) / t)
    return np.cumsum(rings, axis=0)


def allocate(values: np.ndarray, balls: np.ndarray, radius: int, width: int, probe_cost: float = 4.0) -> np.ndarray:
    """Threshold per partition and fingerprint (-1: not probed), of least estimated cost, by dynamic programming.

    Cost of a threshold: candidates within it plus ``probe_cost`` for each value probed. Thresholds + 1 add up to
    radius + 1.
    """
    parts, n = values.shape
    units = radius + 1
    ring = np.cumsum([_choose(width, t) for t in range(units)])
    cost = np.zeros((parts, units + 1, n))
    for i in range(parts):
        for u in range(1, units + 1):
            cost[i, u] = balls[i, u - 1, values[i]] + probe_cost * ring[u - 1]
    best = np.full((units + 1, n), np.inf)
    best[0] = 0
    took = np.zeros((parts, units + 1, n), np.int8)
    for i in range(parts):
        new = np.full((units + 1, n), np.inf)
        for have in range(units + 1):
            for u in range(have + 1):
                c = best[have - u] + cost[i, u]
                better = c < new[have]
                new[have] = np.where(better, c, new[have])
                took[i, have] = np.where(better, u, took[i, have])
        best = new
    left, out = np.full(n, units), np.zeros((parts, n), np.int64)
    for i in range(parts - 1, -1, -1):
        out[i] = took[i, left, np.arange(n)] - 1
        left = left - out[i] - 1
    return out


def _choose(n: int, k: int) -> int:
    import math

    return math.comb(n, k)


def _spanning(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (a, b) as many as join the components ``label`` in the same way, and the labels after that."""
    kept, every = [], np.arange(len(label))
    while len(a):
        pair = np.arange(len(a))
        _, first = np.unique(np.r_[label[a], label[b]], return_index=True)
        pick = np.unique(np.r_[pair, pair][first])  # one pair for each component
        kept.append(np.stack([a[pick], b[pick]]))
        label = forest(np.r_[every, a[pick]], np.r_[label, b[pick]], len(label))
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    kept = np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)
    return kept[0], kept[1], label


def _verify(key: np.ndarray, fp: np.ndarray, role: np.ndarray, radius: int, direct: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (fp, fp) over the rows of one task; ``role`` bit 1: indexed, bit 2: probing.

    With ``direct`` every edge is itself a pair within the radius, else an edge leads to the smallest of its component.
    """
    order = np.lexsort((fp, key))
    key, fp, role = key[order], fp[order], role[order]
    nodes, node = np.unique(fp, return_inverse=True)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    size = np.diff(np.r_[first, len(key)])
    label = np.arange(len(nodes))
    end_of = np.repeat(first + size, size)
    rest = end_of - np.arange(len(key)) - 1  # partners after each row in its cell
    at, pairs = 0, [np.zeros((2, 0), np.int64)]
    while at < len(key):  # chunks of rows with a bounded number of pairs
        upto = max(at + 1, int(np.searchsorted(np.cumsum(rest[at:]), 4_000_000)) + at)
        many = rest[at:upto]
        a = np.repeat(np.arange(at, upto), many)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
        meets = ((role[a] & 1 != 0) & (role[b] & 2 != 0)) | ((role[a] & 2 != 0) & (role[b] & 1 != 0))
        meets &= label[node[a]] != label[node[b]]
        a, b = a[meets], b[meets]
        close = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        a, b = node[a[close]], node[b[close]]
        if direct:
            a, b, label = _spanning(a, b, label)
            pairs.append(np.stack([a, b]))
        elif len(a):
            label = forest(np.r_[np.arange(len(nodes)), a], np.r_[label, b], len(nodes))
        at = upto
    if direct:
        a, b = np.concatenate(pairs, axis=1)
        return nodes[a], nodes[b]
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def link_fingerprints(
    distinct: DataFrame, radius: int = 3, parts: int = 4, block: int = BLOCK, direct: bool = False
) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: a forest with the components of all pairs within ``radius``.

    With ``direct`` every link is itself a pair within ``radius``, for callers that look at the pairs again.

    Fewer ``parts`` suit larger corpora (wider values, more probes). What the driver collects is bounded: bit
    correlations, and one count per partition value (4 x 65,536 with four parts).
    """
    if BITS % parts or BITS // parts > 20:
        raise ValueError("parts must divide 64 into values of at most 20 bits")
    width = BITS // parts
    groups = group_bits(distinct, parts)

    def tally(total, fp):
        for i, v in enumerate(part_values(fp, groups)):
            np.add.at(total, (i << width) + v, 1)

    counts = _sums(distinct, tally, parts << width).reshape(parts, 1 << width)
    balls = np.stack([ball_counts(c, width, radius) for c in counts])
    box = distinct.sparkSession.sparkContext.broadcast(balls.astype(np.float32))
    masks = [np.array([sum(1 << b for b in flip) for flip in combinations(range(width), t)] or [0]) for t in range(radius + 1)]
    out = pa.schema([("key", pa.int64()), ("cell", pa.int64()), ("fp", pa.int64()), ("role", pa.int8())])

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            values = part_values(fp, groups)
            chosen = allocate(values, box.value, radius, width)
            made: list[tuple[np.ndarray, ...]] = []

            def add(i, value, rows, role):
                # a crowded value is dealt to a grid: an indexed row to one column of cells, a probing one to one row
                side = np.maximum(1, np.ceil(box.value[i, 1, value] / block)).astype(np.int64)
                own = (fp[rows] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % side
                key = np.int64(i << width) + value
                one = side == 1
                made.append((key[one], np.zeros(one.sum(), np.int64), fp[rows][one], np.full(one.sum(), role, np.int8)))
                for kind in (1, 2) if not one.all() else ():
                    if role & kind:
                        reps = side[~one]
                        turn = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                        mine, wide = np.repeat(own[~one], reps), np.repeat(reps, reps)
                        cell = mine * wide + turn if kind == 1 else turn * wide + mine
                        made.append((np.repeat(key[~one], reps), cell, np.repeat(fp[rows][~one], reps), np.full(len(cell), kind, np.int8)))

            for i in range(parts):
                every = np.arange(len(fp))
                add(i, values[i][chosen[i] < 0], every[chosen[i] < 0], 1)
                add(i, values[i][chosen[i] >= 0], every[chosen[i] >= 0], 3)
                for t in range(1, radius + 1):
                    rows = every[chosen[i] >= t]
                    if len(rows):
                        near = (values[i][rows][:, None] ^ masks[t][None, :]).ravel()
                        add(i, near, np.repeat(rows, len(masks[t])), 2)
            arrays = [np.concatenate([m[c] for m in made]) for c in range(4)]
            arrays[2] = arrays[2].view(np.int64)
            for at in range(0, len(arrays[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 100_000]) for a in arrays], schema=out)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=out) if (batches := list(batches)) else out.empty_table()
        key = rows["key"].to_numpy() * np.int64(1 << 20) + rows["cell"].to_numpy()
        a, b = _verify(key, rows["fp"].to_numpy().view(np.uint64), rows["role"].to_numpy(), radius, direct)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    made = distinct.select("fp").mapInArrow(signatures, "key long, cell long, fp long, role byte")
    return made.repartition("key", "cell").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, parts: int = 4, words_per_shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links) of every document.

    NULL and empty texts have fingerprint zero and link like any other. Repeated rows and ties have the same component.
    NULL ids take no part in minima; a component without any id has none. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words_per_shingle), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint_classes")
    roots = components(link_fingerprints(classes, radius, parts))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # written, so that the join below can split a large component
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    of_class = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
