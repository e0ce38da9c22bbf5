"""Quality rules and an isolation forest over rule statistics (operator 8).

Each text gets rule statistics (words, symbols, duplicate lines, repeated words, letter case, punctuation). An isolation
forest of random splits is grown on the statistics of the documents labelled good (of all documents where none is);
documents isolated by short paths are anomalous. Half of the rows labelled good (by a hash of the id) grow the
forest; the score above which a document is dropped is set on the other half, and on the rows labelled bad, which no tree
has seen. Documents failing the plain rules (too few words, mostly repeated
words) are dropped whatever the forest says.

Nothing is sampled: a tree's cuts are random parts of the box of all rows and do not depend on single rows, so one pass
of Spark counts, for every tree, the rows in each of its cells; a cell with fewer than two rows is not cut further. All
labelled rows set the threshold: their scores are counted by value. What reaches the driver is bounded by the model
(``trees`` trees of at most ``2 ** DEPTH`` cells) and by the number of different scores (``1 / STEP``). ``sample`` and
``calibration`` bound the rows on request; op8 does not.

Defined results: null and empty texts have no words: all counts are 0 and they fail the base rules. Without
labelled rows of both kinds the threshold is the score that only the ``contamination`` most anomalous rows exceed. With an empty table the
result is empty. A score equal to the threshold is kept. Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WORD, join_apart, map_rows, materialize, shipped

SYMBOLS = set("#*$%&|<>")
_SYMBOL = re.compile(r"[#*$%&|<>]")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SCORED = 8192  # rows scored at a time, and by a task at least
DEPTH, STEP = 14, 2.0 ** -22  # cuts above a cell at most; scores are multiples of STEP
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "mark_share", "line_words", "type_share"]


def repeat_words(words: list[str]) -> int:
    """Words covered by three-word windows that occur at least twice in the text (first occurrences too)."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) > 2_000_000:  # three numbers would not fit 63 bits; unreachable below 2 M distinct words a text
        _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * len(number) + ids[2:]
    else:
        key = (ids[:-2] * len(number) + ids[1:-1]) * len(number) + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k:k + len(hit)] |= hit
    return int(cover.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The contract's counts, and the features of the forest."""
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    full = [x for x in lines if WORD.search(x)]
    n, chars, symbols = len(words), sum(map(len, words)), len(_SYMBOL.findall(text))
    dup, repeated = len(full) - len(set(full)), repeat_words(words)
    upper = sum(1 for w in words if len(w) > 1 and w.isupper())
    marks = text.count("!") + text.count("?")
    per = max(n, 1)
    return ([n, chars, symbols, dup, repeated],
            [math.log1p(n), chars / per, symbols / per, dup / max(len(full), 1), repeated / per, upper / per,
             marks / per, math.log1p(n / max(len(full), 1)), len(set(words)) / per])


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


class IsolationForest:
    """Trees of random splits stored as flat arrays; the score is 2 ** (-mean path / expected path), to the next STEP."""

    def __init__(self, trees: int = 100, per_tree: int = 1024, seed: int = 7):
        self.trees, self.per_tree, self.seed = trees, per_tree, seed

    @staticmethod
    def expected_path(n: int) -> float:
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def fit(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> IsolationForest:
        """Trees over rows of ``x``. Cuts are drawn from the node's part of the box [low, high], which is that of all
        documents: so a feature that is constant among the rows still cuts off what differs from them."""
        rng, self.forest = np.random.default_rng(self.seed), []
        m = min(self.per_tree, len(x))
        deepest = math.ceil(math.log2(max(m, 2))) + 4
        for _ in range(self.trees):
            feature, cut, left, path = [], [], [], []
            todo = [(x[rng.choice(len(x), m, replace=False)], low, high, 0, self._node(feature, cut, left, path))]
            while todo:
                rows, lo, hi, depth, at = todo.pop()
                wide = np.flatnonzero(hi > lo)
                if depth >= deepest or len(rows) < 2 or not len(wide):
                    path[at] = depth + self.expected_path(len(rows))
                    continue
                f = int(rng.choice(wide))
                c = float(lo[f] + (hi[f] - lo[f]) * (1 - rng.random()))  # above the lower end
                feature[at], cut[at], left[at] = f, c, len(feature)
                below = rows[:, f] < c
                a, b = self._node(feature, cut, left, path), self._node(feature, cut, left, path)
                below_hi, above_lo = hi.copy(), lo.copy()
                below_hi[f] = above_lo[f] = c
                todo += [(rows[below], lo, below_hi, depth + 1, a), (rows[~below], above_lo, hi, depth + 1, b)]
            self.forest.append((np.array(feature), np.array(cut), np.array(left), np.array(path)))
        self.norm = max(self.expected_path(m), 1.0)
        return self

    def grow(self, rows: DataFrame, low: np.ndarray, high: np.ndarray) -> IsolationForest:
        """Trees over all of ``rows`` (with a column ``features``): every row is counted in every tree."""
        drawn = self._cuts(low, high)
        shared = rows.sparkSession.sparkContext.broadcast(drawn)
        leaves = 1 << DEPTH

        def count(batches):
            found = np.zeros((len(shared.value), leaves), np.int64)
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                at_row = np.arange(len(x))
                for own, (feature, cut) in zip(found, shared.value):
                    at = np.zeros(len(x), np.int64)
                    for _ in range(DEPTH):
                        at = 2 * at + 1 + (x[at_row, feature[at]] >= cut[at])
                    own += np.bincount(at - (leaves - 1), minlength=leaves)
            tree, leaf = np.nonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), pa.array(found[tree, leaf])], ["tree", "leaf", "n"])

        # at most trees x 2 ** DEPTH rows reach the driver
        cells = shipped(rows.select("features")).mapInArrow(count, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toArrow()
        tree, leaf, n = (cells.column(c).to_numpy() for c in ("tree", "leaf", "n"))
        self.forest = []
        for t, (feature, cut) in enumerate(drawn):
            mass = np.zeros(2 * leaves - 1, np.int64)
            mass[leaves - 1 + leaf[tree == t]] = n[tree == t]
            for d in reversed(range(DEPTH)):
                level = np.arange((1 << d) - 1, (2 << d) - 1)
                mass[level] = mass[2 * level + 1] + mass[2 * level + 2]
            self.forest.append(self._pruned(feature, cut, mass))
        self.norm = max(self.expected_path(int(n[tree == 0].sum())), 1.0)
        return self

    def _cuts(self, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Feature and cut of the nodes of each full tree, the children of node i being 2 i + 1 and 2 i + 2."""
        rng = np.random.default_rng(self.seed)
        wide = np.flatnonzero(high > low)
        if not len(wide):  # all rows are alike: no cut parts them
            return [(np.zeros((1 << DEPTH) - 1, np.int8), np.full((1 << DEPTH) - 1, np.inf))] * self.trees
        drawn = []
        for _ in range(self.trees):
            lo, hi, features, cuts = low[None, :], high[None, :], [], []
            for _ in range(DEPTH):
                node = np.arange(len(lo))
                f = rng.choice(wide, len(lo))
                c = lo[node, f] + (hi[node, f] - lo[node, f]) * (1 - rng.random(len(lo)))  # above the lower end
                features.append(f.astype(np.int8)), cuts.append(c)
                lo, hi = np.repeat(lo, 2, axis=0), np.repeat(hi, 2, axis=0)
                hi[2 * node, f] = lo[2 * node + 1, f] = c
            drawn.append((np.concatenate(features), np.concatenate(cuts)))
        return drawn

    def _pruned(self, feature: np.ndarray, cut: np.ndarray, mass: np.ndarray) -> tuple:
        """The nodes of a full tree down to those with fewer than two rows, as flat arrays."""
        inner = np.concatenate(((mass[:len(feature)] >= 2) & np.isfinite(cut), np.zeros(len(mass) - len(feature), bool)))
        there = np.concatenate(([True], np.repeat(inner[:len(feature)], 2)))  # the root and the children of inner nodes
        number = np.cumsum(there) - 1
        nodes = np.flatnonzero(there)
        is_inner = inner[nodes]
        at = np.where(is_inner, nodes, 0)
        own, depth = mass[nodes], np.floor(np.log2(nodes + 1)).astype(int)
        path = [0.0 if i else d + self.expected_path(int(m)) for i, d, m in zip(is_inner, depth, own)]
        return (np.where(is_inner, feature[at], -1).astype(np.int8), np.where(is_inner, cut[at], 0.0),
                np.where(is_inner, number[2 * at + 1], -1).astype(np.int32), np.array(path))

    @staticmethod
    def _node(feature, cut, left, path) -> int:
        feature.append(-1), cut.append(0.0), left.append(-1), path.append(0.0)
        return len(feature) - 1

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, path in self.forest:
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                go = x[rows, np.maximum(f, 0)] >= cut[at]
                at = np.where(inner, left[at] + go, at)
            total += path[at]
        return np.round(2.0 ** (-total / len(self.forest) / self.norm) / STEP) * STEP


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and a feature vector per row."""
    def per_batch(cols):
        found = [statistics(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "features": [f[1] for f in found]} | {
            c: [f[0][i] for f in found] for i, c in enumerate(COUNTS)}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_batch,
                    "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>")


def _sampled(df: DataFrame, rows: int | None, total: int) -> DataFrame:
    u = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)).cast("double") / float(1 << 30)
    return df if rows is None or total <= rows else df.filter(u < rows / total)


def threshold(scores_good: np.ndarray, scores_bad: np.ndarray, false_share: float) -> float:
    """``best_cut`` of two lists of scores."""
    values = np.unique(np.concatenate((scores_good, scores_bad)))
    count = lambda scores: np.bincount(np.searchsorted(values, scores), minlength=len(values))
    return best_cut(values, count(scores_good), count(scores_bad), false_share)


def best_cut(values: np.ndarray, good: np.ndarray, bad: np.ndarray, false_share: float) -> float:
    """The best balance of bad rows above and good rows above, among the scores that at most ``false_share`` of the good
    rows exceed. ``values``: the different scores, ascending; ``good`` and ``bad``: how many rows have each."""
    upto_good, upto_bad = np.cumsum(good), np.cumsum(bad)
    place = (upto_good[-1] - 1) * (1 - false_share)
    a, b = (values[np.searchsorted(upto_good, at, "right")] for at in (math.floor(place), math.ceil(place)))
    floor = float(a + (b - a) * (place - math.floor(place)))
    cuts = np.concatenate(([floor], values[values > floor]))
    at = np.searchsorted(values, cuts, "right") - 1
    gain = (1 - upto_bad[at] / upto_bad[-1]) - (1 - upto_good[at] / upto_good[-1])
    best = int(np.argmax(gain))
    if best + 1 < len(cuts) and gain[best] > 0:
        return float((cuts[best] + cuts[best + 1]) / 2)
    return float(cuts[best])


def fit(docs: DataFrame, labels: DataFrame, trees: int = 100, per_tree: int = 1024, sample: int | None = None,
        calibration: int | None = None, contamination: float = 0.02, false_share: float = 0.01,
        stats: DataFrame | None = None):
    """(forest, threshold). ``labels`` has doc_id and quality (1 good, 0 bad; null or other values are not used);
    ``stats`` are the stored ``rule_statistics`` of ``docs``, if there are any yet. All rows are used; ``calibration``
    keeps about so many labels, and with ``sample`` trees of ``per_tree`` rows each are grown on about so many rows."""
    stats = materialize(rule_statistics(docs), "statistics") if stats is None else stats
    ends = stats.agg(F.count(F.lit(1)), *(f(F.col("features")[i]) for f in (F.min, F.max) for i in range(len(FEATURES)))).first()
    n_docs = ends[0]
    if not n_docs:
        return None, 1.0
    low, high = np.array(ends[1:], float).reshape(2, len(FEATURES))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality")).filter(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    if calibration is not None:
        known = _sampled(known, calibration, known.count())
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    grows = (F.col("quality") == 1) & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    rated = join_apart(stats, known, "doc_id").filter(~failed).withColumn("grows", grows)
    rated = materialize(rated.repartition(max(1, math.ceil(n_docs / SCORED))), "rated")
    grown, good, bad = rated.agg(F.count_if("grows"), F.count_if((F.col("quality") == 1) & ~F.col("grows")), F.count_if(F.col("quality") == 0)).first()
    rows, n = (rated.filter("grows"), grown) if grown else (stats, n_docs)
    if sample is None:
        forest = IsolationForest(trees, per_tree).grow(rows, low, high)
    else:
        x = _features(_sampled(rows.select("doc_id", "features"), sample, n))
        if not len(x):
            return None, 1.0
        forest = IsolationForest(trees, per_tree).fit(x, low, high)
    if good and bad:
        judged = _verdicts(rated.filter("not grows"), (forest, 1.0), "quality").groupBy("anomaly").agg(
            F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).toArrow().sort_by("anomaly")
        return forest, best_cut(*(judged.column(c).to_numpy() for c in ("anomaly", "good", "bad")), false_share)
    scores = _verdicts(stats, (forest, 1.0)).agg(F.percentile_approx("anomaly", 1 - contamination, 1_000_000)).first()
    return forest, float(scores[0])


def _features(df: DataFrame) -> np.ndarray:
    rows = df.select("features").collect()  # bounded by ``sample``
    return np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES))


def verdicts(docs: DataFrame, model) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly (score 0 to 1) and kept; one row per row of ``docs``, no shuffle."""
    return _verdicts(rule_statistics(docs), model)


def _verdicts(stats: DataFrame, model, *more: str) -> DataFrame:
    """``more``: columns of integers that go along."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # trees x per_tree nodes

    def per_batch(cols):
        forest, cut = shared.value
        n = len(cols["doc_id"])
        score = forest.score(np.array(cols["features"])) if forest and n else np.zeros(n)
        failed = [base_failed(a, b) for a, b in zip(cols["n_words"], cols["n_repeat_words"])]
        return {"doc_id": cols["doc_id"], "base_failed": failed, "anomaly": [float(s) for s in score],
                "kept": [bool(not b and s <= cut) for b, s in zip(failed, score)]} | {c: cols[c] for c in [*COUNTS, *more]}

    return map_rows(stats, per_batch, "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, *more])
                    + ", base_failed boolean, kept boolean, anomaly double", SCORED)


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = materialize(rule_statistics(docs), "statistics")
    model = fit(docs, labels, stats=stats)
    # the stored rows are small: dealt evenly, so that a few tasks do not score what many have computed
    return _verdicts(stats.repartition(max(1, math.ceil(stats.count() / SCORED))), model)
