"""Toxicity by weak supervision.

Method: patterns (words, and word beginnings of 3 to 6 letters, which follow inflected insults) that go with the toxic
label are mined from labelled rows and dealt to voters; two voters look at style (shouting, strings of exclamation
marks). Every document's votes form a bit mask. A generative label model, fitted by expectation maximisation to the
mask counts of all documents and anchored by the labelled rows, estimates how often each voter fires in either class and
which voters fire together beyond the class; voters that do share one vote. Its posteriors label a sample, on which a linear classifier over the
patterns is trained; the classifier scores all documents.

What reaches the driver: the votes of at most ``sample`` labelled ids (default 20,000), equal ones as a count, at most
4,096 patterns, and one count per mask of 14 bits.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_batches, remainder, stored

STRIP = string.punctuation + string.digits + "«»¿¡…–—“”‘’"  # fixed value: what is cut from the ends of a word
BEGINNINGS = (3, 4, 5, 6)
WORD_VOTERS = 4  # voters that share the word patterns; each beginning length has two of its own
VOTERS = WORD_VOTERS + 2 * len(BEGINNINGS) + 2
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")
_MARKS = re.compile(r"!{2,}")


def patterns_of(word: str) -> list[str]:
    """The word itself (``=word``) and its beginnings (``^wor``)."""
    return ["=" + word, *("^" + word[:k] for k in BEGINNINGS if len(word) >= k)] if word else []


def mine_patterns(
    docs: DataFrame, labels: dict[int, int], precision: float = 0.9, least: int = 3, evidence: float | None = None, most: int = 4096
) -> list[tuple[str, int, int]]:
    """Patterns with their toxic and other document counts over the labelled rows, strongest first.

    A pattern must go with the toxic label in ``least`` documents, in ``precision`` of all its documents, and beyond chance: by
    a log-likelihood gain of ``evidence``, by default the logarithm of the number of candidates, so that few are expected by
    chance however many labels there are. At most ``most`` are kept.
    """

    def count(rows):
        toxic, other = Counter(), Counter()
        for doc_id, text in zip(rows["doc_id"], rows["text"]):
            if doc_id in labels:
                words = {w.strip(STRIP) for w in set((text or "").lower().split())}
                (toxic if labels[doc_id] else other).update({p for w in words for p in patterns_of(w)})
        names = [*toxic.keys() | other.keys()]
        return {"pattern": names, "toxic": [toxic[p] for p in names], "other": [other[p] for p in names]}

    found = map_batches(docs.select("doc_id", "text"), "pattern string, toxic long, other long", count)
    found = stored(found.groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "patterns")
    evidence = math.log(max(found.count(), 1)) if evidence is None else evidence
    positive = sum(1 for v in labels.values() if v)
    rate = min(max(positive / max(len(labels), 1), 1e-6), 1 - 1e-6)
    n = F.col("toxic") + F.col("other")
    share = F.col("toxic") / n
    gain = F.col("toxic") * F.log(share / rate) + F.when(F.col("other") > 0, F.col("other") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    best = found.where((F.col("toxic") >= least) & (share >= precision) & (gain >= evidence))
    rows = best.orderBy(gain.desc(), "pattern").limit(most).collect()
    return [(r.pattern, r.toxic, r.other) for r in rows]


class Voters:
    """Patterns, their numbers, and the voter that each belongs to."""

    def __init__(self, patterns: list[str]):
        self.number = {p: i for i, p in enumerate(patterns)}
        self.voter, dealt = [], Counter()
        for p in patterns:
            kind, first, many = ("=", 0, WORD_VOTERS) if p[0] == "=" else (len(p), WORD_VOTERS + 2 * BEGINNINGS.index(len(p) - 1), 2)
            self.voter.append(first + dealt[kind] % many)
            dealt[kind] += 1
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[int, ...]] = {}

    def found(self, text: str) -> list[int]:
        """Numbers of the patterns in a whole text, in order."""
        numbers: set[int] = set()
        for w in set(text.lower().split()) - self.clean:
            if w not in self.hits:
                own = tuple(self.number[p] for p in patterns_of(w.strip(STRIP)) if p in self.number)
                if not own:
                    if len(self.clean) > 500_000:  # words a task remembers
                        self.clean.clear()
                    self.clean.add(w)
                    continue
                if len(self.hits) > 100_000:
                    self.hits.clear()
                self.hits[w] = own
            numbers.update(self.hits[w])
        return sorted(numbers)

    def mask(self, text: str, numbers: list[int]) -> int:
        bits = {self.voter[i] for i in numbers}
        if len(_SHOUT.findall(text)) >= 3:
            bits.add(VOTERS - 2)
        if _MARKS.search(text):
            bits.add(VOTERS - 1)
        return sum(1 << b for b in bits)


class LabelModel:
    """Generative model of votes: class prior, firing rates per class, groups of voters that fire together.

    A voter that does not fire abstains, which says nothing; a document that no pattern voter fires on has a vote of its
    own kind ("none"). The prior is the labelled share; labelled rows keep their label in every round.
    """

    def __init__(self, masks: np.ndarray, counts: np.ndarray, labelled: dict[tuple[int, int], int], rounds: int = 25):
        votes, n = self._votes(masks), counts.astype(float)
        sure = np.array([k for k in labelled], int).reshape(-1, 2)
        sure_votes, sure_toxic, sure_n = self._votes(sure[:, 0]), sure[:, 1].astype(float), np.array([*labelled.values()], float)
        positive = float((sure_n * sure_toxic).sum())
        self.prior = min(max(positive / max(sure_n.sum(), 1), 1e-4), 0.5)
        every, weight = np.r_[votes, sure_votes], np.r_[n, sure_n]
        toxic = np.where(votes[:, :-3].any(1), 0.9, 0.01)  # start: a pattern voter is mostly right
        self.group = np.arange(votes.shape[1])
        for step in range(rounds):
            given = np.r_[toxic, sure_toxic]
            self.fires = np.stack([(every * (weight * c)[:, None]).sum(0) + 0.01 for c in (1 - given, given)])
            self.fires /= np.array([(weight * c).sum() + 1 for c in (1 - given, given)])[:, None]
            self.fires = np.clip(self.fires, 1e-6, 1 - 1e-6)
            if step == 1:
                self.group = self._together(every, weight, given)
            toxic = self._posterior(votes)
        self.known = dict(zip(masks.tolist(), toxic.tolist()))

    @staticmethod
    def _votes(masks: np.ndarray) -> np.ndarray:
        votes = (masks[:, None] >> np.arange(VOTERS)) & 1
        return np.c_[votes, ~votes[:, : VOTERS - 2].any(1)].astype(float)

    def _together(self, votes: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Group number of each voter: voters that fire together among toxic documents, beyond the class, share one."""
        w = n * toxic
        mean = (votes * w[:, None]).sum(0) / max(w.sum(), 1e-9)
        off = votes - mean
        cov = (off * w[:, None]).T @ off / max(w.sum(), 1e-9)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        self.correlation = cov / sd[:, None] / sd
        group = np.arange(len(mean))
        for i, j in zip(*np.nonzero(np.triu(self.correlation > 0.5, 1))):
            group[group == group[j]] = group[i]
        return group

    @property
    def accuracy(self) -> np.ndarray:
        """Of each voter, the share of its votes that fall on toxic documents."""
        hit = self.fires[1] * self.prior
        return hit / (hit + self.fires[0] * (1 - self.prior))

    def _posterior(self, votes: np.ndarray) -> np.ndarray:
        evidence, odds = votes * np.log(self.fires[1] / self.fires[0]), math.log(self.prior / (1 - self.prior))
        for g in np.unique(self.group):  # one vote per group: the mean of its voters that fire
            of = self.group == g
            odds = odds + evidence[:, of].sum(1) / np.maximum(votes[:, of].sum(1), 1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def posterior(self, mask: int) -> float:
        return self.known[mask]


def train_linear(rows: list[list[int]], target: np.ndarray, count: np.ndarray, width: int, rounds: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on 0/1 features and soft targets by full gradients (Adam); rows count ``count`` times. Weights and bias."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    of = np.fromiter((i for r in rows for i in r), np.int64, len(at))
    w, b, step = np.zeros(width), -3.0, 0.1
    m1, m2 = np.zeros(width + 1), np.zeros(width + 1)
    for k in range(1, rounds + 1 if rows else 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(at, w[of], len(rows)), -30, 30)))
        miss = count * (p - target) / count.sum()
        g = np.append(np.bincount(of, miss[at], width) + decay * w, miss.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = step * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.999**k)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


class ToxicityModel:
    def __init__(self, voters: Voters, weights: np.ndarray, bias: float, label_model: LabelModel | None):
        self.voters, self.weights, self.bias, self.label_model = voters, weights.tolist(), bias, label_model

    def score(self, text: str | None) -> float:
        odds = self.bias + sum(self.weights[i] for i in self.voters.found(text or ""))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def learn_toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000, **mining) -> ToxicityModel:
    """``mining`` are settings of ``mine_patterns``. Fit on at most ``sample`` labelled ids, chosen by a hash of the id, and on the votes of all documents.

    Of repeated labelled rows one counts; what an id with several texts sends to the driver is one count per kind of vote.
    ``labels`` (doc_id, toxic) must hold learning rows only. A document labelled twice is toxic if either label is.
    """
    labelled = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = bounded_sample(labelled, sample, "doc_id").collect()
    known = {r.doc_id: int(r.toxic) for r in picked}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = docs.sparkSession.createDataFrame([(int(i),) for i in known], "doc_id long")
    # each labelled text once, however often its row repeats
    learned = stored(texts.join(F.broadcast(ids), "doc_id", "left_semi").distinct(), "labelled_texts")
    voters = Voters([p for p, _, _ in mine_patterns(learned, known, **mining)])

    def vote(rows):
        counts = Counter(voters.mask(t or "", voters.found(t or "")) for t in rows["text"])
        return {"mask": [*counts], "n": [*counts.values()]}

    def labelled_vote(rows):
        found = [voters.found(t or "") for t in rows["text"]]
        return {
            "mask": [voters.mask(t or "", f) for t, f in zip(rows["text"], found)], "found": found,
            "label": [int(known[i] > 0) for i in rows["doc_id"]],
        }

    votes = map_batches(texts.select("text"), "mask int, n long", vote)
    masks = votes.groupBy("mask").agg(F.sum("n").alias("n")).orderBy("mask").collect()
    if not masks:
        return ToxicityModel(voters, np.zeros(len(voters.number)), -3.0, None)
    # different texts under one id meet in equal votes, which come with their count
    chosen = map_batches(learned, "mask int, label int, found array<int>", labelled_vote)
    chosen = sorted(map(tuple, chosen.groupBy("mask", "label", "found").agg(F.count("*")).collect()))
    labelled = Counter()
    for mask, label, _, n in chosen:
        labelled[mask, label] += n
    model = LabelModel(np.array([r.mask for r in masks]), np.array([r.n for r in masks]), labelled)
    target = np.array([model.posterior(mask) for mask, _, _, _ in chosen])
    count = np.array([n for _, _, _, n in chosen], float)
    weights, bias = train_linear([found for _, _, found, _ in chosen], target, count, len(voters.number))
    return ToxicityModel(voters, weights, bias, model)


def score_toxicity(docs: DataFrame, model: ToxicityModel, out: str = "score") -> DataFrame:
    """The input's rows with their score in ``out`` (0 to 1; a clashing column is replaced). NULL texts count as empty."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != out]
    rows = docs.select(*rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return map_batches(rows, f"{schema}, `{out}` double", lambda r: r | {out: [model.score(t) for t in r["text"]]})


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels are read from rows outside the held-out fold only.

    Scores depend on the text alone. Empty, NULL and repeated texts are scored like any other; without labelled rows
    no pattern is found and every score is low; an empty table gives no rows.
    """
    model = learn_toxicity(docs, labels.where(remainder(F.col("doc_id"), folds) != held_out), sample)
    scored = score_toxicity(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
