"""Near copies by SimHash and exact similarity of word-shingle sets.

Method: the search of ``simhash`` (fingerprints of five-word shingles, partitions of correlated bits, thresholds by dynamic
programming) proposes pairs of texts within ``RADIUS`` bits, and those with a Jaccard similarity of 4/5 or more are linked. The
closest pairs of each set are checked first, and of the others only those that lie in different components after that. As some
similar texts have fingerprints further apart or more proposals than are checked, an exact search follows for what then still
lies in different components.

Exact search: two sets with a Jaccard similarity of 4/5 or more share one of their first n/5 + 1 shingles under any common
order (pigeonhole), so each set is indexed under these only. The order puts shingles that a bounded sample of documents
holds often last, then goes by hash; it decides the work, not the result. Of sets that meet, those go on whose histograms
of shingle hashes overlap far enough, which no similar pair fails; the rest are verified on their whole texts. Members of a
shingle's bucket are first held against a few leaders, in rounds with different ones, until few pairs of different components
are left or a round links nothing; these pairs are all compared, so no similar pair is left out. Those of buckets with many
members are compared by 16 bits of each shingle inside a task, in cells of bounded size; only pairs that these show as close
become rows, so a large group of texts that are barely alike is not listed pair by pair.

Equal sets are joined to one before the search. What reaches the driver is bounded: at most ``HOT`` frequent shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from .common import map_batches, stored
from .graph import BLOCK, components
from .simhash import fingerprint, link_fingerprints
from .substring_dedup import WordHashes

WORDS = 5
# At the first shingle that both share, what is left of either set must reach 4/9 of both sizes. In the rounds with leaders
# this leaves pairs out that meet at a later one; the last round sees all of them.
_REACHES = "5 * least({0}, {2}) >= 4 * greatest({0}, {2}) AND 9 * least({0} - {1}, {2} - {3}) >= 4 * ({0} + {2})"
RADIUS = 6  # bits in which the fingerprints of proposed pairs differ at most
NEAREST = 2  # proposed pairs on which a set is checked in a round, whatever the size of its group and the number of tasks
NEAR_ROUNDS = 2  # rounds of these; what they leave is for the exact search
LEADERS = 3  # leaders that a set is held against in a round; what they miss is left to the next rounds
CROWD = 32  # members of a bucket that goes on to further rounds, with leaders of its own
MORE_LEADERS = 32  # in these a set outside the bucket's largest component is held against so many,
SLOTS = 16  # and a bucket has so many of them
MORE_ROUNDS = 10  # at most so many of these; the pairs they leave are compared after them
CELL = 1024  # members of a crowded bucket that are compared with as many others in one place
HOT = 300_000  # frequent shingles that every task knows
PAIRS = 250  # pairs for which a task is worth its while; few pairs make few tasks, many as many as the shuffle gives
SAMPLE = 100_000  # documents that are searched for frequent shingles


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle, one without words has none."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    k = min(words, len(w))
    return np.unique(WordHashes(w).run(np.arange(len(w) - k + 1), k, 0))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets is 4/5 or more."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 5 * shared >= 4 * (len(a) + len(b) - shared)


def _frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample hold, sorted, and in how many."""
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    sample = texts.where(F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, n = np.unique(np.concatenate([shingle_set(t, words) for t in batch.column(0).to_pylist()] or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    found = sample.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n >= 4")
    top = found.orderBy(F.desc("n"), "token").limit(HOT).toArrow()
    token, n = top["token"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def histogram(shingles: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each bucket of their low hash bits, about eight a bucket."""
    buckets = 1 << max(3, (len(shingles) // 8).bit_length())
    return np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets).astype("<u4")


def may_be_alike(a: np.ndarray, b: np.ndarray) -> bool:
    """False if the histograms of two sets show that their Jaccard similarity is below 4/5."""
    if len(a) > len(b):
        a, b = b, a
    n = int(a.sum()) + int(b.sum())
    return not len(a) or 9 * int(np.minimum(a, b.reshape(-1, len(a)).sum(0)).sum()) >= 4 * n


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike. Texts move only for pairs whose histograms overlap far enough."""
    pairs = stored(pairs.distinct(), "pairs")
    known = sets.select("set_key", "counts", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_text"))
    # the two ends of a pair meet under the pair, so no set of many pairs is a hot key
    met = known.join(checked_broadcast(_ends(pairs)), "set_key").groupBy("a", "b")
    both = met.agg(*[F.min(F.when(F.col("set_key") == F.col(e), F.col(c))).alias(f"{c}_{e}") for e in "ab" for c in known.columns[1:]])
    schema = "a long, b long, " + ", ".join(f"own_id_{e} long, own_text_{e} long" for e in "ab")

    def near(r):
        at = [i for i, (x, y) in enumerate(zip(r["counts_a"], r["counts_b"])) if may_be_alike(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"))]
        return {n: [r[n][i] for i in at] for n in r if not n.startswith("counts")}

    close = stored(map_batches(_few_tasks(both, pairs), schema, near), "close")
    owners = (close.select(F.col(e).alias("set_key"), F.col(f"own_id_{e}").alias("own_id"), F.col(f"own_text_{e}").alias("own_text")) for e in "ab")
    own = checked_broadcast(_few_tasks(DataFrame.unionByName(*owners).distinct(), close))
    # an owner may stand in several equal rows; each task passes one of them on, what is left repeats no link
    found = texts.join(own, texts["doc_id"].eqNullSafe(own["own_id"]) & (texts["text_key"] == own["own_text"])).select("set_key", "text")
    bodies = stored(found.mapInArrow(_one_per_key, "set_key long, text string"), "bodies", compression="zstd")
    met = bodies.join(checked_broadcast(_ends(close)), "set_key").groupBy("a", "b")
    both = met.agg(*[F.min(F.when(F.col("set_key") == F.col(e), F.col("text"))).alias(f"t{e}") for e in "ab"])

    def work(r):
        kept = lru_cache(maxsize=64)(lambda t: shingle_set(t, words))
        at = [i for i, (x, y) in enumerate(zip(r["ta"], r["tb"])) if alike(kept(x), kept(y))]
        return {n: [r[n][i] for i in at] for n in ("a", "b")}

    return stored(map_batches(_few_tasks(both, close), "a long, b long", work), "alike")


def _few_tasks(df: DataFrame, pairs: DataFrame) -> DataFrame:
    return df.coalesce(max(1, -(-pairs.count() // PAIRS)))


def _ends(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) under both of its sets."""
    return pairs.select(F.explode(F.array("a", "b")).alias("set_key"), "a", "b")


def _one_per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose first column the task has not passed on yet."""
    seen: set[int] = set()
    for batch in batches:
        fresh = []
        for i, key in enumerate(batch.column(0).to_pylist()):
            if key not in seen:
                seen.add(key)
                fresh.append(i)
        yield batch.take(pa.array(fresh, pa.int64()))


def _proposed(sets: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints differ in ``bits`` bits, ``radius`` or fewer, that join all such sets."""
    classes = stored(sets.groupBy("fp").agg(F.min("set_key").alias("first")), "fingerprint_classes")
    equal = sets.join(classes, "fp").where("set_key != first").select(F.col("first").alias("a"), F.col("set_key").alias("b"), F.lit(0).alias("bits"))
    near = stored(link_fingerprints(classes, radius, direct=True).distinct(), "fingerprint_links")
    near = near.withColumn("bits", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
    ends = (classes.select(F.col("fp").alias(end), F.col("first").alias(f"set_{end}")) for end in ("a", "b"))
    for end in ends:
        near = near.join(end, end.columns[0])
    near = near.select(F.least("set_a", "set_b").alias("a"), F.greatest("set_a", "set_b").alias("b"), "bits")
    return equal.unionByName(near)


def _nearest(links: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of ``links``: for each set the closest one of each of ``NEAREST`` classes of its partners."""
    sides = (links.select(F.col(x).alias("set_key"), F.col(y).alias("other"), "bits") for x, y in ("ab", "ba"))
    salt = F.xxhash64("other", F.lit(turn))
    best = DataFrame.unionByName(*sides).groupBy("set_key", F.pmod(salt, F.lit(NEAREST)).alias("slot"))
    best = best.agg(F.min(F.struct("bits", salt.alias("salt"), "other")).alias("l"))
    return best.select(F.least("set_key", "l.other").alias("a"), F.greatest("set_key", "l.other").alias("b")).distinct()


def _apart(links: DataFrame, asked: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``links`` not yet asked whose ends lie in different components."""
    left = links.join(asked, ["a", "b"], "left_anti")
    for end in "ab":
        left = left.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    return left.where("coalesce(root_a, a) != coalesce(root_b, b)").select("a", "b", "bits")


def _near_roots(sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Components over proposed pairs that are alike. The pairs checked are at most so many for each set, not for each task."""
    links, roots = stored(_proposed(sets, RADIUS), "proposed"), None
    for turn in range(NEAR_ROUNDS):
        asked = stored(_nearest(links, turn), "asked")
        found = _verified(asked, sets, texts, words)
        roots = _joined(roots, found) if turn else components(found, block=BLOCK)
        if turn + 1 < NEAR_ROUNDS:
            links = stored(_apart(links, asked, roots), "apart")
            if links.isEmpty():
                break
    return roots


def _crowded(left: DataFrame) -> DataFrame:
    """Buckets of ``CROWD`` members or more: their largest component and the pairs that lie in different ones."""
    each = left.groupBy("token", "root").agg(F.count("*").alias("n"))
    square = F.col("n").cast("double") * F.col("n")
    of = each.groupBy("token").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("rows"), F.sum(square).alias("same"))
    apart = (F.col("rows").cast("double") * F.col("rows") - F.col("same")) / 2
    return of.where(f"rows >= {CROWD}").select("token", F.col("main.root").alias("main"), "rows", apart.alias("apart"))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the root of their component, of the buckets that hold more than one component.

    Members too far down to reach even the smallest set of their bucket meet nobody there and are left out.
    """
    members = members.select("token", "at", "set_key", "n")
    rooted = members.join(roots, members["set_key"] == roots["node"], "left")
    rooted = stored(rooted.select("token", "at", "set_key", "n", F.coalesce("root", "set_key").alias("root")), "rooted")
    mixed = rooted.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("n").alias("least"))
    mixed = stored(mixed.where("r0 < r1").select("token", "least"), "mixed")
    return stored(rooted.join(checked_broadcast(mixed), "token").where("9 * (n - at) >= 4 * (n + least)").drop("least"), "open")


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` after the links ``found``. Earlier links stand in it as one for each node, so they are not gone through again."""
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found), block=BLOCK)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Sorted low 16 bits of the shingles of a set, repeats included: two sets share at most what their sketches share."""
    return np.sort((shingles & np.uint64(0xFFFF)).astype("<u2"))


def _compared(key: np.ndarray, n: np.ndarray, at: np.ndarray, root: np.ndarray, part: np.ndarray, sketches: list[np.ndarray], across: bool) -> np.ndarray:
    """Pairs (two rows of set keys) of one cell that may be alike and lie in different components, ``across`` parts only."""
    flat, many, ends = [], [], []
    for x in sketches:
        value, count = np.unique(x, return_counts=True)
        flat.append(value)
        many.append(count)
        ends.append(len(value))
    flat, many, first = np.concatenate(flat), np.concatenate(many), np.r_[0, np.cumsum(ends)]
    held, found = np.zeros(1 << 16, np.int64), [np.zeros((2, 0), np.int64)]
    for i in range(len(key) - 1):
        mine = slice(first[i], first[i + 1])
        held[flat[mine]] = many[mine]
        shared = np.add.reduceat(np.minimum(held[flat[first[i + 1] :]], many[first[i + 1] :]), first[i + 1 : -1] - first[i + 1])
        held[flat[mine]] = 0
        j = np.arange(i + 1, len(key))
        near = (root[j] != root[i]) & (key[j] != key[i]) & (9 * shared >= 4 * (n[j] + n[i]))
        near &= 5 * np.minimum(n[j], n[i]) >= 4 * np.maximum(n[j], n[i])
        near &= 9 * np.minimum(n[j] - at[j], n[i] - at[i]) >= 4 * (n[j] + n[i])
        if across:
            near &= part[j] != part[i]
        found.append(np.stack([np.minimum(key[i], key[j[near]]), np.maximum(key[i], key[j[near]])]))
    return np.concatenate(found, axis=1)


def _crowded_pairs(crowd: DataFrame, sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Pairs (a, b) of one bucket that may be alike. ``crowd`` has the members with the ``rows`` of their bucket.

    A bucket is dealt to parts of ``CELL`` members or so, and each two parts meet in a cell of their own.
    """
    own = crowd.select("set_key").distinct().join(sets.select("set_key", F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_text")), "set_key")
    own = checked_broadcast(stored(own, "crowd_owners"))
    found = texts.join(own, texts["doc_id"].eqNullSafe(own["own_id"]) & (texts["text_key"] == own["own_text"])).select("set_key", "text")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _one_per_key(batches):
            made = pa.array([sketch(shingle_set(t, words)).tobytes() for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["set_key", "sketch"])

    # an owner may stand in several equal rows
    short_sets = stored(found.mapInArrow(short, "set_key long, sketch binary").groupBy("set_key").agg(F.max("sketch").alias("sketch")), "sketches")
    side = F.ceil(F.col("rows") / CELL)
    dealt = crowd.withColumn("side", side).withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("side")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1)))
    dealt = dealt.select("token", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "set_key", "n", "at", "root")
    cells = dealt.join(short_sets, "set_key").select("token", "x", "y", "part", "set_key", "n", "at", "root", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, cell = [], None

        def pairs() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(kept).select(["set_key", "n", "at", "root", "part", "sketch"])
            numbers = [rows.column(i).to_numpy().astype(np.int64) for i in range(5)]
            a, b = _compared(*numbers, [np.frombuffer(x, "<u2") for x in rows.column(5).to_pylist()], cell[1] != cell[2])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            of = np.stack([batch.column(i).to_numpy() for i in range(3)])
            starts = np.flatnonzero(np.r_[True, (of[:, 1:] != of[:, :-1]).any(0)]) if batch.num_rows else np.zeros(0, int)
            for start, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
                if kept and cell != tuple(of[:, start]):
                    yield from pairs()
                    kept = []
                cell = tuple(of[:, start])
                kept.append(batch.slice(start, end - start))
        if kept:
            yield from pairs()

    return cells.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, words: int = WORDS, rounds: int = 2) -> DataFrame:
    """doc_id, text_key (hash of the text) and root of every row: rows of equal root are linked by similar sets.

    Texts without words are alike. Repeated rows have the same root. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    often = docs.sparkSession.sparkContext.broadcast(_frequent(texts, words))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count = often.value
        seen: set[int] = set()  # sets whose prefix this task has sent
        for batch in batches:
            keys, sizes, counts, prints, rare, prefixes = [], [], [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(t, words)
                key = int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64))
                keys.append(key)
                sizes.append(len(s))
                new = key not in seen
                seen.add(key)
                counts.append(histogram(s).tobytes() if new else None)
                prints.append(fingerprint(t, words) if new else None)
                if not new or not len(s):
                    rare.append(0)
                    prefixes.append(None)
                    continue
                weight = np.zeros(len(s), np.int64)
                if len(token):
                    at = np.minimum(np.searchsorted(token, s), len(token) - 1)
                    weight = np.where(token[at] == s, count[at], 0)
                first = np.lexsort((s, weight))[: len(s) // 5 + 1]
                rare.append(int((weight[first] == 0).sum()))
                prefixes.append(s[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.array(counts, pa.binary()), pa.array(prints, pa.int64()), pa.array(rare, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "set_key", "n", "counts", "fp", "rare", "prefix"],
            )

    schema = "doc_id long, text_key long, set_key long, n int, counts binary, fp long, rare int, prefix array<long>"
    prints = stored(texts.mapInArrow(index, schema), "shingle_sets")
    owner = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("of")
    sets = prints.groupBy("set_key").agg(owner, F.max("counts").alias("counts"), F.max("fp").alias("fp"))
    sets = stored(sets.select("set_key", "of.doc_id", "of.text_key", "counts", "fp"), "sets")
    roots = _near_roots(sets, texts, words)

    # shingles that are frequent in the sample are taken as shared, so only the others meet in one task to be counted
    each = prints.where("prefix IS NOT NULL").select("set_key", "n", "rare", F.posexplode("prefix").alias("at", "token"))
    shared = each.where("at < rare").withColumn("many", F.count("*").over(Window.partitionBy("token"))).where("many > 1")
    both = shared.select("token", "at", "set_key", "n").unionByName(each.where("at >= rare").select("token", "at", "set_key", "n"))
    members = stored(both.distinct(), "members")

    left, turn, many = _open(members, roots), 0, LEADERS
    while True:
        pool, asks, slot, salt = left, left, F.lit(0), F.xxhash64("set_key", F.lit(turn))
        if turn >= rounds:
            crowd = stored(_crowded(left), "crowded")
            rows, apart = crowd.agg(F.sum("rows"), F.sum("apart")).first()
            if not rows or apart <= CROWD / 2 * rows or turn >= rounds + MORE_ROUNDS:
                break
            pool = left.join(crowd.select("token", "main"), "token")
            asks = pool.where("root != main")
            slot, many = F.pmod(F.xxhash64(F.lit(turn), "set_key"), F.lit(SLOTS)), MORE_LEADERS
        key = F.struct(salt, F.col("set_key"), F.col("n"), F.col("at"), F.col("root"))
        lead = pool.groupBy("token", slot.alias("slot")).agg(F.min(key).alias("l"))
        names = {"set_key": "lead", "n": "lead_n", "at": "lead_at", "root": "lead_root"}
        lead = stored(lead.select("token", *[F.col(f"l.{c}").alias(n) for c, n in names.items()]), "leaders")
        met = asks.join(checked_broadcast(lead), "token").where(f"root != lead_root AND {_REACHES.format('n', 'at', 'lead_n', 'lead_at')}")
        # a set is held against the leaders it shares most with, so a large group costs a few pairs for each member
        met = met.repartition("set_key").groupBy("set_key", "lead").agg(F.count("*").alias("shared"))
        order = Window.partitionBy("set_key").orderBy(F.desc("shared"), F.xxhash64("lead", F.lit(turn)), "lead")
        met = met.withColumn("turn", F.row_number().over(order)).where(f"turn <= {many}")
        found = _verified(met.select(F.least("set_key", "lead").alias("a"), F.greatest("set_key", "lead").alias("b")), sets, texts, words)
        turn += 1
        if turn > rounds and found.isEmpty():
            break
        roots = _joined(roots, found)
        left = _open(left, roots)
    sizes = left.groupBy("token").agg(F.count("*").alias("rows"))
    sized = stored(left.join(sizes, "token"), "sized")
    few = sized.where(f"rows < {CROWD}")
    x, y = few.alias("x"), few.alias("y")
    met = x.join(y, "token").where(f"x.root != y.root AND x.set_key < y.set_key AND {_REACHES.format('x.n', 'x.at', 'y.n', 'y.at')}")
    met = met.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b"))
    crowd = sized.where(f"rows >= {CROWD}")
    if not crowd.isEmpty():
        met = met.unionByName(_crowded_pairs(crowd, sets, texts, words))
    roots = _joined(roots, _verified(met, sets, texts, words))
    return prints.join(roots, prints["set_key"] == roots["node"], "left").select(
        "doc_id", "text_key", F.coalesce("root", "set_key").alias("root")
    )
