"""Language identification by error-correcting output codes.

Method: each known language gets a codeword. One binary classifier per code bit is learned from byte n-gram counts
(log-odds of the languages with the bit set against the others). A text's bit margins are decoded to the codeword with
the smallest loss, each bit weighted by how well it separates; a small lead over the runner-up is flagged.

Counts come from every learning row: tasks add them up per language before the shuffle, and what reaches the driver
is one row of bit weights per n-gram bucket, 131,072 at most, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, remainder, stored

BUCKETS = 1 << 17  # byte pairs as they are, byte triples hashed to as many
UNKNOWN = "und"
#: Bytes of anything but letters become blanks; bytes beyond ASCII are kept.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def buckets(text: str) -> np.ndarray:
    """Buckets of the byte pairs and triples of a lower-cased text; runs of non-letters count as one blank."""
    clean = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    a = np.frombuffer(clean, np.uint8).astype(np.uint32)
    pairs = (a[:-1] << 8) | a[1:]
    triples = ((pairs[:-1] << 8) | a[2:]) * np.uint32(2654435761)
    return np.concatenate([pairs, (triples >> 16) + np.uint32(1 << 16)])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Code matrix (n languages x bits) of -1 and 1: all splits for up to 5 languages, else the best of random codes."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 5:
        splits = [[(s >> i) & 1 for i in range(n)] for s in range(1, 1 << (n - 1))]
        return np.array(splits, np.int8).T * 2 - 1
    rng, bits, best, apart = np.random.RandomState(seed), 10 * math.ceil(math.log2(n)), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        far = (bits - code.astype(int) @ code.T.astype(int) + 2 * bits * np.eye(n, dtype=int)).min() // 2
        if far > apart and not (abs(code.astype(int).sum(0)) == n).any():
            best, apart = code, far
    return best


class LanguageModel:
    """Languages, codewords, bit weights per bucket, scale and weight per bit; at most 131,072 rows of weights."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray):
        self.languages, self.code, self.weights = languages, code.astype(np.float32), weights.astype(np.float32)
        self.scale = np.ones(code.shape[1], np.float32)

    def margins(self, text: str) -> np.ndarray:
        return self.weights[buckets(text)].mean(0)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """Language, confidence in 0..1, whether the decision is ambiguous."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        bits = np.clip(self.margins(text) / self.scale, -3, 3)
        losses = (np.exp(-self.code * bits) * self.scale).sum(1) / self.scale.sum()
        order = np.argsort(losses, kind="stable")
        chance = np.exp(-8 * (losses - losses[order[0]]))
        confidence = float(chance[order[0]] / chance.sum())
        return self.languages[order[0]], confidence, confidence < 0.75


def learn_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Model from all rows with a language and a letter in the text; languages in alphabetical order."""

    def count(rows):
        found: dict[str, list] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)
        made: dict[str, list] = {"lang": [], "bucket": [], "n": []}

        def flush(name: str) -> None:
            kinds, n = np.unique(np.concatenate(found.pop(name)), return_counts=True)
            made["lang"] += [name] * len(kinds)
            made["bucket"] += kinds.tolist()
            made["n"] += n.tolist()
            size.pop(name)

        for name, t in zip(rows["lang"], rows["text"]):
            if has_letter(t):
                found[name].append(buckets(t))
                size[name] += len(found[name][-1])
                if size[name] > 2_000_000:
                    flush(name)
        for name in list(found):
            flush(name)
        return made

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = map_batches(rows.where("lang IS NOT NULL AND text IS NOT NULL"), "lang string, bucket int, n long", count)
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_bucket = counts.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("of"))
    per_bucket = stored(per_bucket, "language_counts")
    totals = {r.lang: r.n for r in per_bucket.select(F.explode("of").alias("lang", "n")).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    code = codewords(len(languages))

    def weigh(rows):
        share = np.array([[(dict(of).get(k, 0) + 0.5) / (totals[k] + 0.5 * BUCKETS) for k in languages] for of in rows["of"]])
        ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
        odds = np.log(share @ (ones / ones.sum(0))) - np.log(share @ (zeros / zeros.sum(0)))
        return {"bucket": rows["bucket"], "w": odds.astype(np.float32).tolist(), "share": share.tolist()}

    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    scale = np.zeros(code.shape[1])
    if code.shape[1]:
        for r in map_batches(per_bucket, "bucket int, w array<float>, share array<double>", weigh).toLocalIterator():
            weights[r.bucket] = r.w
            # mean margin of each language over its own n-grams, towards its own side
            scale += (np.array(r.share)[:, None] * code * np.array(r.w)).mean(0)
    model = LanguageModel(languages, code, weights)
    model.scale = np.maximum(scale, 1e-3).astype(np.float32)
    return model


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every document; ``und`` with score 0 where no letter is found."""
    box = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of buckets

    def work(rows):
        decided = [box.value.decode(t) for t in rows["text"]]
        names = ("lang_pred", "score", "ambiguous")
        return {"doc_id": rows["doc_id"]} | {n: [d[i] for d in decided] for i, n in enumerate(names)}

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(kept, "doc_id long, lang_pred string, score double, ambiguous boolean", work)


def identify_languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Predict every document's language from a model of the rows whose id hash is not ``held_out`` modulo ``folds``.

    Needs doc_id, text, lang; only text enters a prediction. NULL texts and texts without letters get ``und``; NULL
    languages are not learned from; repeated rows are predicted alike; without any labelled row all get ``und``; an
    empty table gives no rows.
    """
    learning = docs.where(remainder(F.col("doc_id"), folds) != held_out).select("text", "lang")
    out = predict_languages(docs, learn_languages(learning))
    return out.withColumn("held_out", remainder(F.col("doc_id"), folds) == held_out)
