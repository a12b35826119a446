"""Connected components of a link table, by rounds of large-star and small-star."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

BLOCK = 200_000  # links that one task turns into a forest


def forest(links_a: np.ndarray, links_b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable number of each of ``n`` items under the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[links_a], label[links_b])
        new = label.copy()
        np.minimum.at(new, links_a, low)
        np.minimum.at(new, links_b, low)
        np.minimum.at(new, label[links_a], low)
        np.minimum.at(new, label[links_b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _toward_smallest(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link each neighbour of ``u`` (the larger ones only, or all) to the smallest of ``u`` and its neighbours.

    Minima are partial aggregates, written before the join so that it can split a node with very many links.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    least = stored(least, "least")
    joined = pairs.join(least, pairs["u"] == least["w"])
    if larger_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select(F.col("w").alias("u"), F.col("m").alias("v"))
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (u, v) of one task as a forest: each node with the smallest that these links reach."""
    ends = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    u, v = np.concatenate([np.zeros((2, 0), np.int64), *ends], axis=1)
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    label = forest(at[: len(u)], at[len(u) :], len(nodes))
    linked = label != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[label[linked]])], names=["u", "v"])


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, block: int = 0) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node with a link to another one.

    Each round is written to the shared scratch folder, so the plan stays short and a lost executor costs one round.
    The number of rounds grows with the logarithm of the number of nodes. Self links and NULL ends are ignored.

    With ``block``, tasks first turn so many links each into forests; links that fit into one block need no round at all.
    ``links`` are read twice then, so they should be stored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    if block:
        blocks = -(-edges.count() // block)
        dealt = edges.repartition(blocks) if blocks > 1 else edges.coalesce(1)
        edges = stored(dealt.mapInArrow(_stars, "u long, v long"), "forests")
        if blocks <= 1:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    else:
        edges = stored(edges.distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_smallest(both, larger_only=True).where("u != v").distinct()
        small = _toward_smallest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger_only=False)
        edges = stored(small.where("u != v").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
