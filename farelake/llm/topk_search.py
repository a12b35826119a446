"""Exact top-k by inner product with a three-phase uniform threshold.

Method: the dimensions are dealt to ``nodes``; a node knows one slice of every vector and so a partial score of every
(query, row). Phase 1: each node sends its ``k`` best partial scores of a query; what they name is resolved exactly, and
the k-th best score is a safe cutoff t. Phase 2: t is sent to the nodes; a row with a score of t or more has a partial
score of t / nodes or more at some node, so the nodes send all entries from there on. Rows named by every node are
scored by the sum, which lifts the cutoff; of the others a row can still count only if its sum, with t / nodes for each
silent node, reaches the new cutoff. Phase 3: those are resolved exactly.

Equal vectors are scored once for all their rows. Queries and rows meet in blocks of bounded size; cutoffs travel with
their block of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .whitening import whole_vectors

ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024


def _best(rows: DataFrame, k: int, by: list[str], order: list) -> DataFrame:
    """The first ``k`` rows of each group; Spark limits each task's groups before the shuffle."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= k)


def keyed_classes(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """Equal rows as one: columns ``by``, ``ids`` of the first k rows (NULL last), ``first`` of them, and a key ``cid``."""
    known = _best(rows, k, by, [F.col("vec_id").asc_nulls_last()]).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id"))).alias("ids")
    )
    first = F.coalesce(F.col("ids")[0]["vec_id"], F.lit((1 << 63) - 1))
    # the key is a hash, moved on where another class has it
    hashed = known.select(*by, F.col("ids.vec_id").alias("ids"), first.alias("first"), F.xxhash64(*by).alias("hash"))
    turn = F.row_number().over(Window.partitionBy("hash").orderBy(*by))
    return hashed.withColumn("cid", F.col("hash") + turn - 1).drop("hash")


def rows_of_classes(found: DataFrame, classes: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows of each group ``by`` (which holds q) of scored classes: by, score, own (of class q), id, rank."""
    listed = found.join(classes.select("cid", "ids"), "cid").select(*by, "score", (F.col("cid") == F.col("q")).alias("own"), F.explode("ids").alias("id"))
    return _best(listed, k, by, [F.col("score").desc(), F.col("id").asc_nulls_last(), "own"]).withColumnRenamed("_n", "rank")


def without_itself(pairs: DataFrame, own_id: str, keys: list[str], k: int) -> DataFrame:
    """The first k ranked rows of each of ``keys``, less one row that equals the asking row in class and id: keys, id, score, rank."""
    mine = F.when(F.col("own") & F.col("id").eqNullSafe(F.col(own_id)), F.col("rank"))
    told = pairs.groupBy(*keys).agg(F.collect_list(F.struct("rank", "id", "score")).alias("all"), F.min(mine).alias("itself"))
    others = F.filter("all", lambda p: F.col("itself").isNull() | (p["rank"] != F.col("itself")))
    told = told.select(*keys, F.posexplode(F.slice(F.sort_array(others), 1, k)).alias("at", "p"))
    return told.select(*keys, F.col("p.id").alias("id"), F.col("p.score").alias("score"), (F.col("at") + 1).alias("rank"))


def _matrix(cell: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    items = cell.values
    flat = items.field("v").flatten().to_numpy()
    return items.field("cid").to_numpy(), flat.reshape(len(items), -1), items


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact whole-number product; by floating point where every sum stays below 2^53."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    return (q.astype(float) @ c.astype(float).T).astype(np.int64) if bound < 2**53 else q @ c.T


def _block_pairs(classes: DataFrame, queries: DataFrame, nodes: int, width: int, n_rows: int, n_queries: int) -> DataFrame:
    """Rows (node, q, c): the node's slices of one block of queries and one block of rows."""
    row_blocks, query_blocks = -(-n_rows // ROWS_PER_BLOCK), -(-n_queries // QUERIES_PER_BLOCK)
    deal = lambda n: F.pmod(F.xxhash64("cid"), F.lit(n)).cast("int")
    part = F.slice("v", F.col("node") * width + 1, width)
    square: Column = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    own = F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rest = F.sqrt(F.greatest(square - own, F.lit(0.0))).alias("rest")  # length outside the node's slice
    each = F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node")
    q = queries.select("*", each, deal(query_blocks).alias("query_block")).select(
        "query_block", "node", F.struct("cid", part.alias("v"), "cut", rest).alias("item")
    ).groupBy("query_block", "node").agg(F.collect_list("item").alias("q"))
    c = classes.select("cid", "v", each, deal(row_blocks).alias("row_block")).select(
        "row_block", "node", F.struct("cid", part.alias("v"), rest).alias("item")
    ).groupBy("row_block", "node").agg(F.collect_list("item").alias("c"))
    meet = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"))
    return meet.join(q, ["query_block", "node"]).select("node", "q", "c")


def _entries(pairs: DataFrame, choose) -> DataFrame:
    """(q, cid, node, part) of the entries that ``choose(partial, cuts, most of the rest)`` marks in each block pair."""
    names = ["q", "cid", "node", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_id, q, items = _matrix(batch.column("q")[i])
                c_id, c, of_rows = _matrix(batch.column("c")[i])
                outside = of_rows.field("rest").to_numpy()
                for at in range(0, len(q), 128):
                    part = _product(q[at : at + 128], c)
                    most = items.field("rest").to_numpy()[at : at + 128, None] * outside
                    rows, cols = choose(part, items.field("cut")[at : at + 128], most * (1 + 1e-9) + 1)
                    node = np.full(len(rows), batch.column("node")[i].as_py(), np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q_id[at + rows], c_id[cols], node, part[rows, cols])], names=names)

    return pairs.mapInArrow(run, "q long, cid long, node int, part long")


def _exact(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(q, cid, score): full scores of given pairs."""
    c = classes.select("cid", F.col("v").alias("cv"))
    q = classes.select(F.col("cid").alias("q"), F.col("v").alias("qv"))
    product = F.expr("aggregate(zip_with(qv, cv, (a, b) -> a * b), 0L, (s, x) -> s + x)")
    return pairs.join(q, "q").join(c, "cid").select("q", "cid", product.alias("score"))


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, nodes: int = 2) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best other rows of each query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``. Vectors that are NULL or hold a NULL or non-finite component
    take no part, nor do those longer than 2^31 after scaling, whose products exceed a long. Rows that repeat an id are rows of
    their own, also as queries; rows without id come last among equal scores and are never queries. Vectors shorter than the
    longest are filled with zeros. A query with fewer than ``k`` candidates gets all of them; an empty table gives no rows;
    extra columns are left out.
    """
    most = k + 1  # a query meets itself in its class
    short = F.expr("aggregate(x, double(0), (s, c) -> s + double(c) * double(c))") < 2.0**62
    rows = stored(whole_vectors(vectors, scale).where(short).select("vec_id", F.col("x").alias("v")), "vectors")
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-max(size, 1) // nodes)
    filled = rows.withColumn("v", F.slice(F.concat("v", F.array_repeat(F.lit(0).cast("long"), width * nodes)), 1, width * nodes))
    classes = stored(keyed_classes(filled, ["v"], most), "vector_classes")
    asked = stored(filled.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.count("*").alias("copies")), "asked")
    asked = stored(asked.join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), F.col("cid").alias("q"), "copies"), "queries")
    wanted = classes.select("cid", "v").join(asked.select(F.col("q").alias("cid")).distinct(), "cid", "left_semi")
    wanted = stored(wanted, "query_classes")
    n_rows, n_queries = classes.count(), wanted.count()

    def best_parts(part, *_):
        take = min(most, part.shape[1])
        cols = np.argpartition(-part, take - 1, axis=1)[:, :take]
        return np.repeat(np.arange(len(part)), take), cols.ravel()

    def beyond_cut(part, cuts, elsewhere):
        t = np.array([np.iinfo(np.int64).max if c is None else c for c in cuts.to_pylist()])[:, None]
        return np.nonzero((part >= -(-t // nodes)) & (part + elsewhere >= t))

    blocks = (nodes, width, max(n_rows, 1), max(n_queries, 1))
    lists = _entries(_block_pairs(classes, wanted.withColumn("cut", F.lit(None).cast("long")), *blocks), best_parts)
    named = _best(lists, most, ["q", "node"], [F.col("part").desc(), "cid"]).select("q", "cid").distinct()
    phase1 = stored(_exact(named, classes), "phase1")
    cutoff = lambda scores: _best(scores, most, ["q"], [F.col("score").desc(), "cid"]).where(F.col("_n") == most).select("q", F.col("score").alias("t"))
    cuts = stored(cutoff(phase1), "cutoffs")
    with_cut = wanted.join(cuts, wanted["cid"] == cuts["q"], "left").select("cid", "v", F.col("t").alias("cut"))
    entries = _entries(_block_pairs(classes, with_cut, *blocks), beyond_cut)
    sums = stored(entries.groupBy("q", "cid").agg(F.sum("part").alias("known"), F.count("*").alias("n")), "phase2")
    summed = sums.where(F.col("n") == nodes).select("q", "cid", F.col("known").alias("score"))
    scored = stored(phase1.unionByName(summed).distinct(), "scored")
    # a silent node adds less than its share of t, or the row stays below t
    share = F.ceil(F.col("t") / F.lit(nodes)).cast("long") - 1
    first_cut = cuts.select("q", share.alias("share"))
    open_ = sums.where(F.col("n") < nodes).join(first_cut, "q").join(cutoff(scored), "q").where(
        F.col("known") + (nodes - F.col("n")) * F.col("share") >= F.col("t")
    )
    phase3 = _exact(open_.select("q", "cid"), classes)
    order = [F.col("score").desc(), "first", "cid"]
    whole = scored.unionByName(phase3).distinct().join(classes.select("cid", "first"), "cid")
    best = _best(whole, most, ["q"], order).select("q", "cid", "score")
    found = stored(rows_of_classes(best, classes, ["q"], most), "best_rows")
    out = without_itself(asked.join(found, "q"), "query_id", ["query_id", "q", "copies"], k)
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
