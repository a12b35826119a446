"""Mixing by soft membership: document rates that bring expected domain totals to target weights.

Method: a softmax classifier over style features, trained on a bounded sample of the labelled table, gives each
document a posterior over domains. A rate r of 0 or more per document is fitted so that the expected tokens of each
domain, the sum of r * tokens * posterior, match the targets: least squares by projected gradient from r = 1, with steps
scaled by tokens and the residual whitened, so a document's rate depends on its posterior and not on its length. Each
round is one aggregate over the stored posteriors; only one vector of the size of the domains comes back.

A rate is realised as its whole part plus one more copy with the probability of the rest, drawn from a hash of the row.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fresh, map_batches, quoted, stored
from .quality_rules import measure_text


def style(text: str | None) -> list[float]:
    """Style features of a whole text; an empty text has zeros."""
    text = text or ""
    n_words, chars, symbols, lines, dup_lines, repeated = measure_text(text)
    n, c = max(n_words, 1), max(len(text), 1)
    digits = sum(map(text.count, "0123456789"))
    marks = sum(map(text.count, ".,;:!?"))
    distinct = len(set(text.split()))
    return [
        np.log1p(n_words), chars / n, symbols / n, dup_lines / max(lines, 1), repeated / n, digits / c, marks / n,
        distinct / n, np.log1p(len(text) / max(lines, 1)), (len(text.encode()) - len(text)) / c,
    ]


class DomainModel:
    """Softmax regression over standardised style features."""

    def __init__(self, features: np.ndarray, domain: np.ndarray, domains: int, rounds: int = 400, decay: float = 1e-3):
        self.mean = features.mean(0) if len(features) else np.zeros(10)
        self.sd = np.maximum(features.std(0), 1e-6) if len(features) else np.ones(10)
        x = np.c_[(features - self.mean) / self.sd, np.ones(len(features))] if len(features) else np.zeros((0, 11))
        target = np.eye(domains)[domain] if len(x) else np.zeros((0, domains))
        self.w = np.zeros((11, domains))
        if len(x):
            step = 1.0 / max(0.5 * np.linalg.eigvalsh(x.T @ x / len(x)).max() + decay, 1e-9)
            v = self.w
            for k in range(rounds):  # accelerated gradient
                g = x.T @ (_softmax(x @ v) - target) / len(x) + decay * v
                new = v - step * g
                v, self.w = new + k / (k + 3) * (new - self.w), new

    def posterior(self, features: np.ndarray) -> np.ndarray:
        return _softmax(np.c_[np.clip((features - self.mean) / self.sd, -8, 8), np.ones(len(features))] @ self.w)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def domain_posteriors(docs: DataFrame, labels: DataFrame, domain: str, sample: int = 20_000) -> tuple[DataFrame, list]:
    """(doc_id, text_key, tokens, posterior) of every document, and the domains in the order of the posterior.

    Trained on at most ``sample`` labelled ids, chosen by a hash of the id; of an id with several texts, on their mean
    style. A document labelled twice takes the larger label. The domains are those of the label table. Without labels there is one domain, which all documents belong to.
    """
    picked = labels.where(f"doc_id IS NOT NULL AND `{domain}` IS NOT NULL").groupBy("doc_id").agg(F.max(domain).alias("d"))
    known = {r.doc_id: r.d for r in bounded_sample(picked, sample, "doc_id").collect()}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    columns = {"doc_id": "long", "text_key": "long", "tokens": "long", "style": "array<double>"}

    def describe(r):
        return {"doc_id": r["doc_id"], "text_key": r["text_key"], "tokens": [len(t.encode().split()) for t in r["text"]], "style": [style(t) for t in r["text"]]}

    described = stored(map_batches(rows, ", ".join(f"{k} {v}" for k, v in columns.items()), describe), "styles")

    # one row per labelled id, whose different texts count alike however often a row repeats: no more rows than the sample
    ids = docs.sparkSession.createDataFrame([(int(i),) for i in known], "doc_id long")
    train = described.select("doc_id", "style").join(F.broadcast(ids), "doc_id", "left_semi").distinct()
    train = train.groupBy("doc_id").agg(F.array(*[F.avg(F.col("style")[i]) for i in range(10)]).alias("style"))
    train = train.orderBy("doc_id").collect()
    domains = [r.d for r in picked.select("d").distinct().orderBy("d").collect()] or [None]
    at = {d: i for i, d in enumerate(domains)}
    model = DomainModel(np.array([r.style for r in train]), np.array([at[known[r.doc_id]] for r in train], int), len(domains))

    def judge(r):
        p = model.posterior(np.array(r["style"])).tolist() if r["style"] else []
        return {n: r[n] for n in ("doc_id", "text_key", "tokens")} | {"posterior": p}

    out = map_batches(described, "doc_id long, text_key long, tokens long, posterior array<double>", judge)
    return stored(out, "posteriors"), domains


def rate_column(steps: list[np.ndarray]) -> Column:
    """Rate of a document from its posterior: start at 1, follow each step, stay at 0 or more."""
    rate = F.lit(1.0)
    if steps:
        moves = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
        move = lambda s: F.aggregate(F.zip_with("posterior", s, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        rate = F.aggregate(moves, rate, lambda r, s: F.greatest(F.lit(0.0), r - move(s)))
    return rate


def fit_rates(posteriors: DataFrame, targets: np.ndarray, most_rounds: int = 30, close: float = 1e-6) -> list[np.ndarray]:
    """Steps of the projected gradient until the expected totals are within ``close`` of the targets."""
    k = len(targets)
    of = [F.col("posterior")[i] * F.col("tokens") for i in range(k)]
    steps: list[np.ndarray] = []
    for left in reversed(range(most_rounds)):
        at = posteriors.withColumn("_rate", rate_column(steps))
        gram = [F.when(F.col("_rate") > 0, of[i] * F.col("posterior")[j]) for i in range(k) for j in range(k)]
        sums = at.agg(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in [*[F.col("_rate") * x for x in of], *gram]]).first()
        miss = np.array(sums[:k], float) - targets
        if np.abs(miss).sum() <= close * max(np.abs(targets).sum(), 1):
            break
        if not left:
            warnings.warn(f"expected totals miss the targets {targets.tolist()} by {miss.tolist()}", stacklevel=2)
        # whitened by the documents that still have a rate, which are the ones that can move either way
        steps.append(np.linalg.pinv(np.array(sums[k:], float).reshape(k, k), rcond=1e-9) @ miss)
    return steps


def mixing_rates(
    docs: DataFrame, labels: DataFrame, domain: str = "quality", weights: dict | None = None, relative: dict | None = None,
    budget: float | None = None, sample: int = 20_000, seed: int = 1,
) -> DataFrame:
    """doc_id, text_key, tokens, rate, copies of every document.

    ``weights`` are target shares of tokens per domain; without them the targets are the present shares times
    ``relative`` (default 1 each), made to add up to 1. ``budget`` is the total of expected tokens (default: as many as
    now). Documents without words count no tokens but get a rate like any other. NULL texts count as empty; repeated
    rows have equal rates and copies; an empty table gives no rows. Targets that no rates reach, such as tokens for a
    domain that nothing belongs to, are met as nearly as least squares can.
    """
    posteriors, domains = domain_posteriors(docs, labels, domain, sample)
    present = np.array(posteriors.agg(*[
        F.coalesce(F.sum(F.col("posterior")[i] * F.col("tokens")), F.lit(0.0)) for i in range(len(domains))
    ]).first(), float)
    share = np.array([weights.get(d, 0.0) for d in domains]) if weights else present * [(relative or {}).get(d, 1.0) for d in domains]
    targets = share / max(share.sum(), 1e-300) * (present.sum() if budget is None else budget)
    chance = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rated = posteriors.withColumn("rate", rate_column(fit_rates(posteriors, targets)))
    return rated.withColumn("copies", F.floor(F.col("rate") + chance).cast("long")).select("doc_id", "text_key", "tokens", "rate", "copies")


def mix(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The input's rows, each as often as its rate says (see ``mixing_rates``); columns stay as they are, whatever their names."""
    names = docs.columns
    own_id, own_key, of_id, of_key, copies, turn = fresh(names, "own_id", "own_key", "of_id", "of_key", "copies", "turn")
    keyed = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_key: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    rates = mixing_rates(docs, labels, **settings).groupBy("doc_id", "text_key").agg(F.max("copies").alias(copies))
    # written before it is joined: Spark splits a hot key only between plain shuffles
    rates = stored(rates.select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key), copies).where(F.col(copies) > 0), "rates")
    rows = keyed.join(rates, F.col(own_id).eqNullSafe(F.col(of_id)) & (F.col(own_key) == F.col(of_key)))
    return rows.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*map(quoted, names))
