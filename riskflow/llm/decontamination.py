"""Benchmark decontamination by a BM25 index with block-max WAND (operator 6).

The test items are indexed: items longer than ``PART`` words in overlapping parts, so that a part fits a passage. Every
training passage (``PASSAGE`` words, every ``STEP`` words, of every whole text) is a query, and all items whose BM25
score reaches ``share`` of the score the item gives itself are retrieved. Posting lists carry a largest score for the
list and for each block of ``BLOCK`` parts, and are walked as in block-max WAND: the pivot is the first part whose
lists could reach the threshold together, and a pivot whose blocks cannot is skipped with its whole block range. The
walk starts only in those of up to ``COARSE`` equal ranges of parts whose block maxima, summed over a passage, can
reach the threshold; this first test is taken for all passages of a text and all ranges at once.
A retrieved item is a leak if enough word n-grams of both its question and its answer occur around the passage, or nearly
all n-grams of the whole item, whatever is missing. The answer is the last line of an item, or else its last sentence, or
else its last third.

The index is made and stored by tasks in shards of about ``SHARD`` parts, with document frequencies of all items. The
driver sends ``AT_ONCE`` shards at a time to the tasks, for one pass over the documents, and takes them back before the
next ones go out: its memory and the tasks' are bounded for any number of items. One item is never cut between shards.

Defined results: null and empty texts and items have no leaks; items with equal texts are reported each; repeated
rows give repeated results; an empty table on either side gives an empty result. Other columns are not read by
``leaks`` and are all kept by ``without_leaks``.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, shipped, slices

K1, B = 1.2, 0.75
STEP, PART, PART_STEP, BLOCK, COARSE, SHARD, AT_ONCE = 32, 48, 24, 8, 32, 20_000, 4
PASSAGE = 2 * STEP
SHARE, GRAM, QUESTION_SHARE, ANSWER_SHARE, WHOLE_SHARE = 0.55, 3, 0.6, 0.6, 0.9
WORDS = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    for cut in (text.rstrip().rfind("\n"), max((m.end() for m in re.finditer(r"[.?!]\s+", text.rstrip())), default=-1)):
        q, a = words(text[:max(cut, 0)]), words(text[max(cut, 0):])
        if q and a:
            return q, a
    every = words(text)
    n = len(every) - len(every) // 3
    return every[:n], every[n:]


def _grams(w: list[str]) -> set[tuple]:
    n = min(GRAM, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def starts(n_words: int) -> range:
    """Where the parts of an item begin."""
    return range(0, max(1, n_words - PART + PART_STEP), PART_STEP)


class Index:
    """Posting lists of item parts with list and block maxima; scores are shares of a part's score for itself."""

    def __init__(self, items: list[tuple], frequency: dict[str, int], n_items: int, mean_length: float):
        self.items = [(i, words(t), *question_and_answer(t)) for i, t in items if words(t)]
        self.ngrams = [(_grams(q), _grams(a), _grams(w)) for _, w, q, a in self.items]
        self.part_item: list[int] = []
        lists: dict[str, list[tuple[int, float]]] = {}
        for k, (_, w, _, _) in enumerate(self.items):
            for at in starts(len(w)):
                part = w[at:at + PART]
                tf = Counter(part)
                norm = K1 * (1 - B + B * len(part) / mean_length)
                impact = {t: math.log(1 + (n_items - frequency[t] + 0.5) / (frequency[t] + 0.5)) * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
                own = sum(impact.values())
                for t, x in impact.items():
                    lists.setdefault(t, []).append((len(self.part_item), x / own))
                self.part_item.append(k)
        self.term = {t: i for i, t in enumerate(lists)}
        self.parts = [[p for p, _ in x] for x in lists.values()]
        self.scores = [[s for _, s in x] for x in lists.values()]
        self.most = [max(s) for s in self.scores]
        self.blocks = []
        for parts, scores in zip(self.parts, self.scores):
            top: dict[int, float] = {}
            for p, s in zip(parts, scores):
                top[p // BLOCK] = max(top.get(p // BLOCK, 0.0), s)
            self.blocks.append(top)
        self.range = -(-max(1, len(self.part_item)) // COARSE)  # parts in a range
        self.top = np.zeros((len(lists), -(-len(self.part_item) // self.range)), np.float32)
        for t, (parts, scores) in enumerate(zip(self.parts, self.scores)):
            np.maximum.at(self.top[t], np.array(parts) // self.range, np.array(scores, np.float32))

    def retrieve(self, terms: list[int], least: float, first: int = 0, end: int | None = None) -> list[tuple[int, float]]:
        """All (part, score) with score >= ``least`` for a set of terms, of the parts from ``first`` to before ``end``."""
        least -= 1e-9
        most, parts = self.most, self.parts
        end = len(self.part_item) if end is None else end
        live = []  # current part, position, term
        for t in terms:
            k = bisect_left(parts[t], first)
            if k < len(parts[t]) and parts[t][k] < end:
                live.append([parts[t][k], k, t])
        out = []
        while live:
            live.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(live):
                bound += most[t]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                break
            at = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == at:
                pivot += 1
            block = at // BLOCK
            if sum(self.blocks[t].get(block, 0.0) for _, _, t in live[:pivot + 1]) < least:
                # no part of this block before the next list's can reach the threshold
                to = min((block + 1) * BLOCK, live[pivot + 1][0] if pivot + 1 < len(live) else math.inf)
                to = max(to, at + 1)
            elif live[0][0] == at:
                score = sum(self.scores[t][k] for _, k, t in live[:pivot + 1])
                if score >= least:
                    out.append((at, score))
                to = at + 1
            else:
                to = at
            rest = []
            for part, k, t in live:
                if part < to and ((k := bisect_left(parts[t], to, k)) >= len(parts[t]) or parts[t][k] >= end):
                    continue
                rest.append([parts[t][k], k, t])
            live = rest
        return out

    def leaks(self, text: str | None, share: float = SHARE) -> dict:
        """item number -> (score, question share, answer share) of the verified items."""
        w = words(text)
        if not w or not self.items:
            return {}
        none, term = len(self.most), self.term
        ids = np.fromiter((term.get(x, none) for x in w), np.int64, len(w))
        # the distinct terms of each step, a passage being two steps, and their maxima in each range
        known = np.flatnonzero(ids != none)
        step_term = np.unique(known // STEP * none + ids[known])
        if not len(step_term):
            return {}
        step, terms_of = step_term // none, step_term % none
        begin = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1])))
        bound = np.zeros((len(w) // STEP + 2, self.top.shape[1]), np.float32)
        bound[step[begin]] = np.add.reduceat(self.top[terms_of], begin, axis=0)
        bound = bound[:-1] + bound[1:]
        found: dict[int, tuple] = {}
        for p, c in zip(*np.nonzero(bound[:max(1, -(-(len(w) - STEP) // STEP))] >= share - 1e-4)):
            s = int(p) * STEP
            own = np.unique(terms_of[(step == p) | (step == p + 1)]).tolist()
            for part, score in self.retrieve(own, share, int(c) * self.range, (int(c) + 1) * self.range):
                k = self.part_item[part]
                n = len(self.items[k][1])
                around = w[max(0, s - n):s + PASSAGE + n]
                q, a, whole = (self._share(g, around) for g in self.ngrams[k])
                if (q >= QUESTION_SHARE and a >= ANSWER_SHARE) or whole >= WHOLE_SHARE:
                    found[k] = max(found.get(k, (0.0, 0.0, 0.0)), (float(score), q, a))
        return found

    @staticmethod
    def _share(grams: set[tuple], around: list[str]) -> float:
        if not grams:
            return 1.0  # an item of one word has no answer of its own
        n = len(next(iter(grams)))
        have = {tuple(around[i:i + n]) for i in range(len(around) - n + 1)}
        return len(grams & have) / len(grams)


def shards(benchmark: DataFrame) -> DataFrame | None:
    """shard, index (an ``Index``, pickled): a stored table; None without items. BM25 statistics are those of all items."""
    import pandas as pd

    item_type = benchmark.schema["item_id"].dataType.simpleString()

    def measured(batches):
        for pdf in batches:
            yield pdf.assign(n_words=[len(words(t)) for t in pdf["text"]])

    items = benchmark.select(F.col("item_id").alias("item_id"), F.col("text").alias("text")).filter("text is not null")
    items = shipped(items).mapInPandas(measured, f"item_id {item_type}, text string, n_words long")
    # rows are numbered once, so that equal items spread as well
    items = materialize(items.withColumn("row", F.monotonically_increasing_id()), "leak-items")
    n_parts = F.greatest(F.lit(1), F.ceil((F.col("n_words") - PART + PART_STEP) / PART_STEP))
    stats = items.agg(F.count(F.lit(1)).alias("n"), F.avg("n_words").alias("mean"), F.sum(n_parts).alias("parts")).first()
    if not stats["n"]:
        return None
    n_items, mean = stats["n"], max(1.0, min(PART, stats["mean"]))
    items = items.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(math.ceil(stats["parts"] / SHARD))))

    def terms_of(batches):
        for pdf in batches:
            pairs = [(s, w) for s, t in zip(pdf["shard"], pdf["text"]) for w in set(words(t))]
            yield pd.DataFrame(pairs, columns=["shard", "t"])

    own = items.select("shard", "text").mapInPandas(terms_of, "shard long, t string").groupBy("shard", "t").agg(F.count(F.lit(1)).alias("n"))
    own = materialize(own, "leak-terms")
    frequency = own.join(own.groupBy("t").agg(F.sum("n").alias("df")), "t").select("shard", "t", "df")

    def build(key, own_items, own_terms):
        rows = list(zip(own_items["item_id"].tolist(), own_items["text"]))
        rows.sort(key=lambda r: (len(words(r[1])), r[1], str(r[0])))  # like lengths share a block
        index = Index(rows, dict(zip(own_terms["t"], own_terms["df"].tolist())), n_items, mean)
        return pd.DataFrame({"shard": [key[0]], "index": [pickle.dumps(index, pickle.HIGHEST_PROTOCOL)]})

    made = items.groupBy("shard").cogroup(frequency.groupBy("shard")).applyInPandas(build, "shard long, index binary")
    return materialize(made, "leak-shards")


def _passes(stored: DataFrame | None):
    """Broadcast indexes, ``AT_ONCE`` at a time, and whether they are the last."""
    if stored is None:
        return
    sc = stored.sparkSession.sparkContext
    numbers = sorted(r["shard"] for r in stored.select("shard").collect())  # a number for every SHARD parts
    for at in range(0, len(numbers), AT_ONCE):
        yield ([sc.broadcast(pickle.loads(stored.filter(F.col("shard") == k).first()["index"])) for k in numbers[at:at + AT_ONCE]],
               at + AT_ONCE >= len(numbers))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share: a row for every verified (document row, item)."""
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id long, item_id {item_type}, score double, question_share double, answer_share double"
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for own, last in _passes(shards(benchmark)):
        part = shipped(only).mapInPandas(_pairs(own, share), schema)
        if not last:
            part = materialize(part, "leak-pairs")
            for index in own:
                index.destroy()
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _pairs(own: list, share: float):
    import pandas as pd

    def run(batches):
        for pdf in batches:
            rows = [(d, index.value.items[k][0], *v) for d, t in zip(pdf["doc_id"], pdf["text"])
                    for index in own for k, v in sorted(index.value.leaks(t, share).items())]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_share", "answer_share"])
    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the rows that hold a leak; all columns stay; no shuffle."""
    at = docs.columns.index("text")
    for own, last in _passes(shards(benchmark)):
        def run(batches, own=own):
            for batch in batches:
                for part in slices(batch):
                    clean = [not any(index.value.leaks(t, share) for index in own) for t in part.column(at).to_pylist()]
                    yield part.filter(pa.array(clean, pa.bool_()))
        docs = shipped(docs).mapInArrow(run, docs.schema)
        if not last:
            docs = materialize(docs, "leak-free")
            for index in own:
                index.destroy()
    return docs


def op6(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)
