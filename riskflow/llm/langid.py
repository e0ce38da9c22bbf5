"""Language identification by nearest centroid (operator 7).

Texts become normalised TF-IDF vectors of hashed byte n-grams (2, 3 and 4 bytes of the lower-cased letters). Every
language is represented by several centroids, found by spherical k-means over a bounded sample of its labelled
texts; a text takes the language of the centroid nearest by cosine. A text farther from every centroid than its
language's training texts allow is rejected.

Bounded by documented parameters: the ``most_langs`` languages with most labelled texts are learned (a dirty column may
hold any number of values; ties go to the language that sorts first), ``sample_per_lang`` texts are clustered per
language, and the model has (languages x ``clusters`` x ``BINS``) numbers. Document frequencies are counted over *all* training texts.

Defined results: null text, empty text and text without a letter give ``und`` with score 0 and are rejected; with
no training rows every text is ``und``. Repeated rows give repeated results; other columns are not read.
Ties between centroids go to the language that sorts first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import fold, map_rows, shipped, slices

BINS, MOST_LANGS = 1 << 14, 256
UND = "und"
_LETTER = re.compile("[A-Za-z]")

# Bytes that stay (ASCII letters, and all bytes of non-ASCII characters); everything else becomes a space.
_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def grams(text: str) -> np.ndarray:
    """Counts of the hashed 2-, 3- and 4-byte grams of a text (length ``BINS``)."""
    b = _KEEP[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), np.uint8)]
    space = b == 32
    b = b[~(space & np.concatenate(([False], space[:-1])))].astype(np.uint32)
    total = np.zeros(BINS, np.int64)
    g = b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        g = (g[:-1] << np.uint32(8)) | b[n - 1:]
        total += np.bincount(((g * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(18)).astype(np.int64), minlength=BINS)
    return total


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (np.log1p(counts) * idf).astype(np.float32)
    norm = float(np.sqrt(np.dot(v, v)))
    return v / norm if norm else v


def has_letter(text: str | None) -> bool:
    return bool(text) and (_LETTER.search(text) is not None or any(map(str.isalpha, text)))


@dataclass
class LanguageModel:
    idf: np.ndarray
    langs: list  # language of every centroid, sorted
    centroids: np.ndarray  # (n, BINS), unit length
    least: np.ndarray  # least similarity at which a text is accepted, by centroid

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine similarity to its nearest centroid, rejected."""
        if not has_letter(text) or not len(self.langs):
            return UND, 0.0, True
        sims = self.centroids @ vector(grams(text), self.idf)
        k = int(np.argmax(sims))
        score = float(min(1.0, max(0.0, sims[k])))
        return self.langs[k], score, bool(score < self.least[k])


def vectors(texts, idf: np.ndarray) -> np.ndarray:
    """One row a text, filled in place: the rows are not held twice."""
    x = np.empty((len(texts), BINS), np.float32)
    for i, t in enumerate(texts):
        x[i] = vector(grams(t), idf)
    return x


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches):
        df, n = np.zeros(BINS, np.int64), 0
        for pdf in batches:
            for t in pdf["text"]:
                df += grams(t) > 0
                n += 1
        hit = np.flatnonzero(df)
        yield pd.DataFrame({"bin": np.append(hit, -1), "n": np.append(df[hit], n)})

    # at most BINS + 1 rows reach the driver, whatever the input
    rows = shipped(train).select("text").mapInPandas(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(BINS), 0
    for r in rows:
        if r["bin"] < 0:
            total = r["n"]
        else:
            df[r["bin"]] = r["n"]
    return df, total


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with farthest-point starts: centroids and every row's similarity to its own."""
    mean = x.mean(axis=0)
    start = [int(np.argmax(x @ mean))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        j = int(np.argmin(near))
        if near[j] > 0.9999:
            break
        start.append(j)
        near = np.maximum(near, x @ x[j])
    c = x[start].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                m = x.mean(axis=0, where=(own == j)[:, None])  # without a copy of the rows
                c[j] = m / max(float(np.linalg.norm(m)), 1e-12)
    return c, (x @ c.T).max(axis=1)


def fit(labelled: DataFrame, clusters: int = 3, sample_per_lang: int = 600, slack: float = 0.5,
        most_langs: int = MOST_LANGS) -> LanguageModel:
    """Learn from ``labelled`` (doc_id, text, lang). Rows without a language or a letter are not used.

    ``sample_per_lang``: about so many texts of each language are clustered (those with the smallest hash of
    their id). ``most_langs``: so many languages at most, the commonest. ``slack``: a text is rejected below ``slack`` times the lowest training similarity of its language.
    """
    train = labelled.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, total = _document_frequencies(train)
    if not total:
        return LanguageModel(np.ones(BINS), [], np.zeros((0, BINS), np.float32), np.zeros(0))
    idf = np.log((1 + total) / (1 + df)) + 0.1
    counts = train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect()
    shares = train.sparkSession.createDataFrame([(r["lang"], min(1.0, sample_per_lang / r["count"])) for r in counts],
                                                "_lang string, _share double")  # at most ``most_langs`` rows
    u = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).cast("double") / float(1 << 30))
    sample = train.join(F.broadcast(shares), F.col("lang").cast("string") == F.col("_lang")).filter(u < F.col("_share"))

    def per_lang(pdf):
        x = vectors(pdf["text"], idf)
        c, sims = _cluster(x, clusters)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": list(c.astype(np.float32)), "least": slack * float(sims.min())})

    rows = (sample.select("text", "lang").groupBy("lang")
            .applyInPandas(per_lang, "lang string, centroid array<float>, least double").collect())
    rows.sort(key=lambda r: (r["lang"], [round(x, 6) for x in r["centroid"]]))
    return LanguageModel(idf, [r["lang"] for r in rows],
                         np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), BINS),
                         np.array([r["least"] for r in rows]))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), rejected: one row per row of ``docs``; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters x BINS numbers

    def per_batch(cols):
        found = [shared.value.predict(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                "rejected": [f[2] for f in found]}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_batch,
                    "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` that are not rejected; all columns stay; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                keep = [not shared.value.predict(t)[2] for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return shipped(docs).mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The contract's training rows: crc32(doc_id as text) mod 5 is not 0."""
    return docs.filter(fold(F.col("doc_id"), 5) != 0)


def op7(docs: DataFrame) -> DataFrame:
    found = identify(docs, fit(training_rows(docs)))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")
