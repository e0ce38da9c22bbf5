"""Toxicity by maximum-scoring segment search (operator 1).

Learning: the numbers of toxic and of other labelled texts that have a word give each word a log-odds ratio with an
informative Dirichlet prior (in proportion to the word's overall frequency). Words whose ratio is significant score
it. A longer word that has no score of its own takes that of its first ``STEM`` letters, counted likewise; every other
word scores a small negative drift.

Scoring: a linear scan over the words of a text finds all maximal-scoring segments. Under the word frequencies of the
texts labelled 0, the best segment of a text of n words follows an extreme-value law with P(best >= x) about
1 - exp(-K n exp(-lambda x)); lambda solves E[exp(lambda * score)] = 1 and K is fitted to the texts labelled 0. Each
segment's evidence is lambda * score - log(1 + K n), about -log of its expected number by chance; the evidence of all
segments that have any, and of the best one, is turned into a score from 0 to 1 by a logistic fit on the training rows.

Bounded by documented parameters: learning uses about ``sample`` labelled rows (smallest hash of the id), and at most
``most_terms`` scored words. Scoring reads every whole text.

Defined results: null and empty texts have no segments and get the score of no evidence. If the training rows lack a
class, every score is that class's share (0 or 1, 0 without rows). Repeated rows give repeated results; labels given
more than once count as toxic if any of them is; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import fold, map_rows, shipped

WORDS = re.compile(r"[^\W\d_]+")
PREDICT_FROM, STEM = 0.7, 5


def words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def maximal_segments(scores: list[tuple[int, float]], n: int, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end word, score) of ``n`` words.

    ``scores`` has (position, score) of the scored words in order; all others score ``-drift``. Linear in the number
    of scored words: candidates are kept with the running totals left and right of them, and a new one is merged
    with the nearest earlier candidate that starts lower, unless that one ends at least as high.
    """
    out: list[list] = []  # first, end, total before, total after
    total, at = 0.0, 0
    for i, s in scores:
        total -= drift * (i - at)
        at = i + 1
        if s <= 0:
            total += s
            continue
        new = [i, i + 1, total, total + s]
        total += s
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= new[2]:
                j -= 1
            if j < 0 or out[j][3] >= new[3]:
                break
            new = [out[j][0], new[1], out[j][2], new[3]]
            del out[j:]
        out.append(new)
    return [(a, b, hi - lo) for a, b, lo, hi in out]


@dataclass
class ToxicityModel:
    terms: dict  # word -> score
    drift: float
    decay: float  # lambda
    scale: float  # K
    weights: tuple  # logistic: constant, evidence of all segments, of the best

    def _maximal(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        terms = self.terms
        hits = []
        for i, w in enumerate(tokens):
            s = terms.get(w)
            if s is None and len(w) > STEM + 1:
                s = terms.get(w[:STEM] + "*")
            if s is not None:
                hits.append((i, s))
        return maximal_segments(hits, len(tokens), self.drift) if hits else []

    def best(self, tokens: list[str]) -> float:
        return max((s for _, _, s in self._maximal(tokens)), default=0.0)

    def segments(self, tokens: list[str]) -> list[tuple[int, int, float, float]]:
        """Significant segments: first word, end word, score, evidence."""
        base = math.log1p(self.scale * len(tokens))
        found = [(a, b, s, self.decay * s - base) for a, b, s in self._maximal(tokens)]
        return [f for f in found if f[3] > 0]

    def evidence(self, tokens: list[str]) -> tuple[float, float]:
        e = [f[3] for f in self.segments(tokens)]
        return (math.sqrt(sum(e)), math.sqrt(max(e))) if e else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        a, b = self.evidence(words(text))
        c, wa, wb = self.weights
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, c + wa * a + wb * b))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple:
    """Weights of a logistic model with non-negative evidence weights, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _decay(scores: np.ndarray, chance: np.ndarray) -> float:
    """The positive lambda with E[exp(lambda * score)] = 1, for a negative mean score."""
    lo, hi = 0.0, 1.0
    f = lambda x: float(np.dot(chance, np.exp(np.clip(x * scores, -700, 700)))) - 1
    while f(hi) < 0 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _counts(rows: DataFrame) -> DataFrame:
    """word, and in how many toxic and other texts it occurs (a text that repeats a word is one witness)."""
    def run(batches):
        bad, good = Counter(), Counter()
        for pdf in batches:
            for t, y in zip(pdf["text"], pdf["toxic"]):
                own = set(words(t))
                (bad if y else good).update(own | {w[:STEM] + "*" for w in own if len(w) > STEM + 1})
            if len(bad) + len(good) > 300_000:
                yield _frame(bad, good)
                bad, good = Counter(), Counter()
        yield _frame(bad, good)

    return rows.select("text", "toxic").mapInPandas(run, "word string, n1 long, n0 long") \
        .groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _frame(bad: Counter, good: Counter) -> pd.DataFrame:
    every = list(bad.keys() | good.keys())
    return pd.DataFrame({"word": every, "n1": [bad[w] for w in every], "n0": [good[w] for w in every]},
                        columns=["word", "n1", "n0"]).astype({"word": object, "n1": "int64", "n0": "int64"})


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic of about ``sample`` labelled rows; the sampled labels (two numbers a row) are broadcast."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("toxic")) \
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(sample / total * (1 << 30))))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, most_terms: int = 20_000, prior: float = 0.1,
        z_least: float = 3.0, drift: float = 0.5, most_score: float = 8.0) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic 0/1) joined with ``docs``; callers leave held-out rows out of ``labels``.

    ``prior``: the Dirichlet prior weighs this share of the counted words. ``z_least``: a word scores if its log-odds
    ratio is so many standard deviations from zero.
    """
    rows = labelled(shipped(docs), labels, sample)
    counts = _counts(rows).persist()
    try:
        totals = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
        t1, t0 = float(totals["n1"] or 0), float(totals["n0"] or 0)
        if not t1 or not t0:
            share = 30.0 if t1 else -30.0
            return ToxicityModel({}, drift, 1.0, 1.0, (share, 0.0, 0.0))
        a0 = prior * (t1 + t0)
        a = F.lit(prior) * (F.col("n1") + F.col("n0"))
        y1, y0 = F.col("n1") + a, F.col("n0") + a
        odds = F.log(y1 / (t1 + a0 - y1)) - F.log(y0 / (t0 + a0 - y0))
        z = odds / F.sqrt(1 / y1 + 1 / y0)
        terms = (counts.select("word", odds.alias("odds"), z.alias("z"), (y0 / (t0 + a0)).alias("chance"))
                 .filter(F.abs("z") >= z_least).orderBy(F.abs("z").desc(), "word").limit(most_terms).collect())
    finally:
        counts.unpersist()
    scores = np.array([max(-most_score, min(most_score, r["odds"])) for r in terms] + [0.0]) - drift
    chance = np.array([r["chance"] for r in terms] + [0.0])
    chance[-1] = max(0.0, 1 - chance.sum())
    mean = float(np.dot(chance, scores))
    if mean > -0.1:  # the law needs a negative mean
        scores -= mean + 0.1
    model = ToxicityModel({r["word"]: float(s) for r, s in zip(terms, scores)}, float(-scores[-1]),
                          _decay(scores, chance), 1.0, (0.0, 0.0, 0.0))

    best = _training(rows, model, lambda m, tokens: [m.best(tokens), float(len(tokens))])
    null = [(x, n) for y, x, n in best if not y and n]
    model.scale = len(null) / max(1e-9, sum(n * math.exp(-model.decay * x) for x, n in null)) if null else 1.0
    x = _training(rows, model, lambda m, tokens: list(m.evidence(tokens)))
    model.weights = _logistic(np.array([r[1:] for r in x]), np.array([float(r[0]) for r in x]))
    return model


def _training(rows: DataFrame, model: ToxicityModel, measure) -> list[tuple]:
    """(toxic, *numbers) of the sampled rows: at most about ``sample`` short rows reach the driver."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"].astype("int64"), "x": [measure(model, words(t)) for t in pdf["text"]]})

    return [(r["toxic"], *r["x"]) for r in rows.mapInPandas(run, "toxic long, x array<double>").collect()]


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score: one row per row of ``docs``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most ``most_terms`` words

    def per_batch(cols):
        m = shared.value
        return {"doc_id": cols["doc_id"], "score": [m.score(t) for t in cols["text"]]}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_batch, "doc_id long, score double")


def passages(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, start, end (characters of the lower-cased text), passage, segment_score, evidence of every
    significant passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(cols):
        out = {k: [] for k in ("doc_id", "start", "end", "passage", "segment_score", "evidence")}
        for d, t in zip(cols["doc_id"], cols["text"]):
            low = (t or "").lower()
            spans = [m.span() for m in WORDS.finditer(low)]
            for a, b, s, e in shared.value.segments([low[i:j] for i, j in spans]):
                for k, v in zip(out, (d, spans[a][0], spans[b - 1][1], low[spans[a][0]:spans[b - 1][1]], s, e)):
                    out[k].append(v)
        return out

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_batch,
                    "doc_id long, start long, end long, passage string, segment_score double, evidence double")


def op1(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    found = score(docs, fit(docs, labels.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
