"""Language-model scores by prediction by partial matching over bytes.

Method: a trie of byte contexts (the last ``order`` bytes and every shorter suffix) holds symbol counts of all learning
texts. A symbol is coded in the longest known context; a symbol that was never seen there costs an escape, whose
probability is d / 2t for t symbols of d kinds seen (method D), and is looked for in the next shorter context with the
symbols of the longer one excluded; below the empty context all remaining bytes are equally likely. The trie is pretrained: a
text's score is the sum of its log10 probabilities, the end included.

A text is its lower-cased (A-Z) words joined by one space, closed by a line feed, which no word contains. So the scores
are probabilities of the same token sequences as those of the word baseline that comes with them: add-one unigram
counts over words and ends.

At scale: texts are dealt to blocks of bounded size. A block asks once for each distinct context with symbol and for
each distinct word that it contains; counts are added up by key, probabilities are computed from contexts grouped by
their last three bytes, and answers return to the block by joins. The trie is never in one place; only contexts of up to
two bytes, at most 256^3 counts, are shared with every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, stored, total_bytes

ORDER = 5
SHARED = 2  # longest contexts that every task gets
BLOCK_BYTES = 16 << 20
END = ""  # the end token among words: no word is empty
_CHUNK = 2 << 20
_PENDING = 1_000_000  # counts that wait to be added up


class Level:
    """Contexts of one length: sorted nodes (context, symbol) with counts; per context totals, kinds and excluded sums.

    A node packs the context's bytes, latest first, and then the symbol. ``covered`` of a context is what its own
    symbols count in the context one byte shorter: the mass that exclusion takes away there.
    """

    def __init__(self, nodes: np.ndarray, counts: np.ndarray, shorter: Level | None):
        seen = counts > 0
        self.nodes, self.counts = nodes[seen], counts[seen].astype(np.float64)
        self.contexts, at = np.unique(self.nodes >> np.uint64(8), return_inverse=True)
        n = len(self.contexts)
        self.total, self.kinds = np.bincount(at, self.counts, n), np.bincount(at, minlength=n).astype(np.float64)
        self.covered = np.zeros(n)
        if shorter is not None and n:
            self.covered = np.bincount(at, shorter.count_of(shorten(self.nodes, 1)), n)

    def count_of(self, nodes: np.ndarray) -> np.ndarray:
        return _look_up(self.nodes, nodes, self.counts)[1]


def _look_up(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whether each wanted key is there, and its values (0 where it is not)."""
    if not len(keys):
        return np.zeros(len(wanted), bool), *[np.zeros(len(wanted)) for _ in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return hit, *[np.where(hit, v[at], 0.0) for v in values]


def shorten(nodes: np.ndarray, by: int) -> np.ndarray:
    """Nodes with the ``by`` oldest context bytes left out."""
    return ((nodes >> np.uint64(8 * by + 8)) << np.uint64(8)) | (nodes & np.uint64(255))


def merge_counts(nodes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the counts of equal nodes, by node."""
    if not len(nodes):
        return nodes, counts
    at = np.argsort(nodes)
    nodes = nodes[at]
    first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
    return nodes[first], np.add.reduceat(counts[at], first)


def build_levels(nodes: np.ndarray, counts: np.ndarray, order: int, shared: list[Level] | None = None) -> list[Level]:
    """Levels 0..order from nodes of that order; ``shared`` gives the shortest ones."""
    levels = list(shared or [])
    for j in range(len(levels), order + 1):
        levels.append(Level(*merge_counts(shorten(nodes, order - j), counts), levels[-1] if levels else None))
    return levels


def log_probabilities(nodes: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each node's symbol after its context."""
    order = len(levels) - 1
    out = np.zeros(len(nodes))
    open_ = np.ones(len(nodes), bool)
    gone_mass, gone_kinds = np.zeros(len(nodes)), np.zeros(len(nodes))
    for j in range(order, -1, -1):
        node = shorten(nodes, order - j)
        known, total, kinds, covered = _look_up(levels[j].contexts, node >> np.uint64(8), levels[j].total, levels[j].kinds, levels[j].covered)
        count = levels[j].count_of(node)
        whole = 2 * (total - gone_mass)
        hit = open_ & known & (count > 0)
        out[hit] += np.log10((2 * count[hit] - 1) / whole[hit])
        open_ &= ~hit
        miss = open_ & known
        costs = miss & (kinds > gone_kinds)  # with nothing left to see here the escape is certain
        out[costs] += np.log10((kinds[costs] - gone_kinds[costs]) / whole[costs])
        gone_mass, gone_kinds = np.where(miss, covered, gone_mass), np.where(miss, kinds, gone_kinds)
    out[open_] -= np.log10(256 - gone_kinds[open_])
    return out


class NodeTable:
    """Values by node in an open hash table: a lookup is a few vectorised reads."""

    def __init__(self, nodes: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(nodes)).bit_length())
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)  # no node has all bits set
        self.values = np.zeros(1 << self.bits, np.float32)
        place, owner = self._place(nodes), np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(nodes), dtype=np.int32)
        while len(left):
            free = owner[place[left]] < 0
            owner[place[left[free]]] = left[free]
            left = left[owner[place[left]] != left]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
        self.keys[place], self.values[place] = nodes, values

    def _place(self, nodes: np.ndarray) -> np.ndarray:
        return ((nodes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, nodes: np.ndarray) -> np.ndarray:
        """Values of nodes that are all in the table."""
        place = self._place(nodes)
        out = self.values[place]
        left = np.flatnonzero(self.keys[place] != nodes)
        while len(left):
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[place[left]] == nodes[left]
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~hit]
        return out


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def text_nodes(lines: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of all symbols of the lines (ends included), and the number of nodes of each line.

    A line starts in a context of NUL bytes.
    """
    pad = b"\0" * order
    a = np.frombuffer(pad + b"".join(x + b"\n" + pad for x in lines), np.uint8)
    node = np.zeros(len(a) - order, np.uint64)
    for back in range(1, order + 1):  # latest byte first
        node = (node << np.uint64(8)) | a[order - back : len(a) - back]
    node = (node << np.uint64(8)) | a[order:]
    sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    inside = np.ones(len(node), bool)
    starts = np.cumsum(sizes + order) - order
    for k in range(order):
        inside[starts + k] = False
    return node[inside], sizes


def _chunks(lines: list[bytes]) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, line in enumerate(lines):
        size += len(line)
        if size > _CHUNK:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(lines):
        yield at, len(lines)


def pack_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, doc_ids, learns, body): per batch and block the compressed lines of its texts."""
    kept = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("learns").cast("boolean").alias("learns"),
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(blocks)).cast("int"))
    names = ["block", "doc_ids", "learns", "body"]
    types = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            made: dict[int, tuple[list, list, list]] = {}
            for doc_id, text, learns, block in zip(*(c.to_pylist() for c in batch.columns)):
                ids, flags, lines = made.setdefault(block, ([], [], []))
                ids.append(doc_id), flags.append(learns), lines.append(normalise(text))
            rows = [(b, ids, flags, pack(b"\n".join(lines))) for b, (ids, flags, lines) in made.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return kept.mapInArrow(run, "block int, doc_ids array<long>, learns array<boolean>, body binary")


def _unpack(bodies: pa.Table) -> Iterator[tuple[list, list, list[bytes]]]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for row in bodies.select(["doc_ids", "learns", "body"]).to_pylist():
        yield row["doc_ids"], row["learns"], unpack(row["body"]).split(b"\n")


def count_blocks(packed: DataFrame, order: int) -> DataFrame:
    """One row per block: its distinct nodes and words, each with its count in learning texts."""

    def count(table: pa.Table) -> pa.Table:
        nodes, counts, waiting = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        learned, other = Counter(), set()
        for _, learns, lines in _unpack(table):
            for line, flag in zip(lines, learns):
                (learned if flag else other).update(line.split())
                (learned if flag else other).update((b"",))
            for a, b in _chunks(lines):
                node, sizes = text_nodes(lines[a:b], order)
                weight = np.repeat(np.array(learns[a:b], np.uint64), sizes)
                kinds, n = np.unique(node << np.uint64(1) | weight, return_counts=True)
                nodes.append(kinds >> np.uint64(1))
                counts.append(n * (kinds & np.uint64(1)).astype(np.int64))
                waiting += len(kinds)
                if waiting > _PENDING:
                    merged = merge_counts(np.concatenate(nodes), np.concatenate(counts))
                    nodes, counts, waiting = [merged[0]], [merged[1]], 0
        nodes, counts = merge_counts(np.concatenate(nodes), np.concatenate(counts))
        pa.default_memory_pool().release_unused()
        words = sorted(learned.keys() | other)
        return pa.table({
            "block": pa.array(table["block"][:1].to_pylist(), pa.int32()),
            "nodes": pa.array([nodes.astype(np.int64)], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64())),
            "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
            "word_counts": pa.array([[learned[w] for w in words]], pa.list_(pa.int64())),
        })

    schema = "block int, nodes array<long>, counts array<long>, words array<string>, word_counts array<long>"
    return packed.groupBy("block").applyInArrow(count, schema)


def node_probabilities(counted: DataFrame, order: int) -> DataFrame:
    """(node, log_p) for every node, learned or only asked for; ``counted`` holds node and n."""
    shortest = counted.where("n > 0").groupBy(
        (F.shiftleft(F.shiftright("node", 8 * (order - SHARED) + 8), 8).bitwiseOR(F.col("node").bitwiseAND(F.lit(255)))).alias("node")
    ).agg(F.sum("n").alias("n")).toArrow()
    shared = build_levels(*merge_counts(shortest["node"].to_numpy().astype(np.uint64), shortest["n"].to_numpy()), SHARED)
    box = counted.sparkSession.sparkContext.broadcast(shared)  # at most 256^3 nodes

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # contexts with the same last three bytes are in one task, so all longer levels are complete
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if parts:
            nodes, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            at = np.argsort(nodes)
            nodes = nodes[at].astype(np.uint64)
            levels = build_levels(nodes, counts[at], order, box.value)
            for i in range(0, len(nodes), 100_000):
                some = nodes[i : i + 100_000]
                p = log_probabilities(some, levels).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(p)], names=["node", "log_p"])

    dealt = counted.repartition(F.shiftright("node", 8 * (order - SHARED)))
    return dealt.select("node", "n").mapInArrow(weigh, "node long, log_p float")


def score_documents(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text, learns) by a model of the rows with ``learns``.

    Columns: doc_id, learns, n_tokens, n_known, train_tokens, base_score, score. NULL texts count as empty: one token,
    the end. Repeated rows are scored alike and each counts in learning. Without learning rows every byte costs
    log10 256. An empty table gives no rows; extra columns are left out.
    """
    if order <= SHARED or order > 6:
        raise ValueError("order must be 3 to 6")
    packed = pack_blocks(docs, max(1, -(-total_bytes(docs, "text") // block_bytes)))
    asked = stored(count_blocks(packed, order), "asked")
    nodes = asked.select("block", F.inline(F.arrays_zip(F.col("nodes").alias("node"), F.col("counts").alias("n"))).alias("node", "n"))
    words = asked.select("block", F.inline(F.arrays_zip(F.col("words"), F.col("word_counts"))).alias("word", "n"))
    counted = stored(nodes.groupBy("node").agg(F.sum("n").alias("n")), "nodes")
    vocabulary = stored(words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "words")
    tokens, kinds = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    answers = nodes.select("block", "node").join(node_probabilities(counted, order), "node").select(
        "block", "node", F.lit(None).cast("string").alias("word"), F.col("log_p").cast("double").alias("value")
    ).unionByName(
        words.select("block", "word").join(vocabulary, "word").select(
            "block", F.lit(None).cast("long").alias("node"), "word", F.col("c").cast("double").alias("value")
        )
    )

    unseen = float(np.log10(tokens + kinds + 1))

    def score(bodies: pa.Table, answer: pa.Table) -> pa.Table:
        own = answer.select(["word", "value"]).filter(answer["word"].is_valid())
        shares = {}  # log10(c + 1) of each known word
        for part in own.to_batches(max_chunksize=50_000):
            shares.update(zip(part.column(0).to_pylist(), np.log10(part.column(1).to_numpy() + 1).tolist()))
        own = answer.select(["node", "value"]).filter(answer["node"].is_valid())
        del answer
        table = NodeTable(own["node"].to_numpy().astype(np.uint64), own["value"].to_numpy())
        del own
        pa.default_memory_pool().release_unused()
        made: dict[str, list] = {n: [] for n in ("doc_id", "learns", "n_tokens", "n_known", "train_tokens", "base_score", "score")}
        for ids, learns, lines in _unpack(bodies):
            made["doc_id"] += ids
            made["learns"] += learns
            for line in lines:
                words = [*line.decode().split(" "), END] if line else [END]
                parts = [shares.get(w, 0.0) for w in words]
                made["n_tokens"].append(len(words))
                made["n_known"].append(len(words) - parts.count(0.0))  # a known word has log10 2 or more
                made["train_tokens"].append(tokens)
                made["base_score"].append(sum(parts) - len(words) * unseen)
            for a, b in _chunks(lines):
                node, sizes = text_nodes(lines[a:b], order)
                made["score"] += np.add.reduceat(table[node].astype(np.float64), np.cumsum(sizes) - sizes).tolist()
        kinds_of = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(made.items(), kinds_of)})

    schema = "doc_id long, learns boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def ppm_scores(docs: DataFrame, folds: int = 7, held_out: int = 2, order: int = ORDER) -> DataFrame:
    """Scores of every document; the model learns from the rows whose id hash is not ``held_out`` modulo ``folds``."""
    flagged = docs.select("doc_id", "text", (remainder(F.col("doc_id"), folds) != held_out).alias("learns"))
    return score_documents(flagged, order).select(
        "doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
