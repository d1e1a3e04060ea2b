"""Severity of toxic language by cumulative-link ordinal regression.

P(grade > k) = logistic(w·x - t_k) with one weight vector for all thresholds
t_0 < t_1 < ...; the expected severity is the sum of these probabilities. Features
are the distinct words of the whole text and the beginnings of words, since insults
are inflected. Weights are not negative and fitted with an L1 penalty, so few are
left to look for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.common import free_name, release, table
from revloom.llm.decontamination import words
from revloom.llm.langid import remainder

# Bound of the training sample: labelled documents, and features that are weighed.
SAMPLE_LABELS = 6_000
SAMPLE_WORDS = 4_000
# Bytes of a longer word's beginning that are a feature of their own.
STEM = 6
# Labels that only say whether a text is toxic are graded by markers, features of
# which at least this share of documents is toxic: grade 2 from so many of them on.
MARKER_SHARE, SEVERE_FROM = 0.9, 3
# A feature counts if so many documents of the sample have it.
LEAST_DOCUMENTS = 5
# Penalty that selects features, and the smaller one with which those are fitted again.
PENALTY = 0.001
LIGHT_PENALTY = 0.0001
ROUNDS = 400
# A document is called toxic from this probability of any grade above 0 on.
TOXIC_FROM = 0.5

RESULT = T.StructType([T.StructField(c, T.DoubleType()) for c in ("severity", "p_toxic")] + [T.StructField("grade", T.IntegerType())])


def logistic(x):
    return 0.5 * (1 + np.tanh(x / 2))


def features(text: str | None) -> set[bytes]:
    """Distinct words (``=word``) and beginnings of longer words (``^stem``)."""
    distinct = set(words(text))
    return {b"=" + w for w in distinct} | {b"^" + w for w in {w[:STEM] for w in distinct if len(w) > STEM}}


class Ordinal:
    """Shared weights of the features and thresholds between the grades."""

    def __init__(self, weights: dict[bytes, float], thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def above(self, text: str | None) -> np.ndarray:
        """P(grade > k) for each threshold; null is an empty text."""
        known = self.weights.keys() & features(text)
        return logistic(sum(self.weights[w] for w in sorted(known)) - self.thresholds)


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, columns: int, penalty: float = PENALTY, rounds: int = ROUNDS):
    """(weights, thresholds) from the word numbers of each row, by accelerated proximal gradient.

    The penalty is on the weights only. Thresholds are kept in order by fitting the
    first and the logarithms of the gaps.
    """
    sizes = np.array([len(r) for r in rows])
    flat = np.concatenate([*rows, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    levels = int(grades.max()) if len(grades) else 1
    over = grades[:, None] > np.arange(max(1, levels))[None, :]
    share = np.clip(over.mean(axis=0), 1e-4, 1 - 1e-4)
    t = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(t), 0.05))
    params = np.concatenate((np.zeros(columns), [t[0]], gaps))

    def thresholds(p):
        return np.cumsum(np.concatenate(([p[columns]], np.exp(p[columns + 1 :]))))

    def gradient(p):
        z = np.bincount(row, weights=p[flat], minlength=len(rows))[:, None] - thresholds(p)[None, :]
        # Cumulative probabilities with sentinels: grade k lies between bounds k and k+1.
        c = np.concatenate((np.ones((len(rows), 1)), logistic(z), np.zeros((len(rows), 1))), axis=1)
        at = np.arange(len(rows)), np.minimum(grades, c.shape[1] - 2)
        upper, lower = c[at], c[at[0], at[1] + 1]
        mass = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        pull = -(du - dl) / mass / len(rows)
        g = np.zeros_like(p)
        g[:columns] = np.bincount(flat, weights=pull[row], minlength=columns)
        # Threshold k is the lower bound of grade k+1 and the upper one of grade k.
        gt = np.zeros(c.shape[1] - 2)
        np.add.at(gt, at[1][at[1] > 0] - 1, (du / mass)[at[1] > 0] / len(rows))
        inner = at[1] < len(gt)
        np.subtract.at(gt, at[1][inner], (dl / mass)[inner] / len(rows))
        tail = np.cumsum(gt[::-1])[::-1]
        g[columns] = tail[0]
        g[columns + 1 :] = tail[1:] * np.exp(p[columns + 1 :])
        return g

    # Steps per coordinate: the curvature along one word is at most half the mean of
    # the number of features in the rows that have it (the threshold is one more).
    crowd = np.bincount(flat, weights=(sizes + 1.0)[row], minlength=columns) / max(1, len(rows))
    own = (sizes + 1.0).mean() if len(rows) else 1.0
    step = 2.0 / np.concatenate((np.maximum(crowd, 1e-6), np.full(len(params) - columns, own)))
    look, before, speed = params.copy(), params.copy(), 1.0
    for _ in range(rounds):
        moved = look - step * gradient(look)
        w = moved[:columns]
        # A word can only add to the severity.
        moved[:columns] = np.maximum(w - penalty * step[:columns], 0)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        # Start over when the momentum points back.
        if ((look - moved) * (moved - before) / step).sum() > 0:
            faster, look = 1.0, moved.copy()
        else:
            look = moved + (speed - 1) / faster * (moved - before)
        before, speed = moved, faster
    return before[:columns], thresholds(before)


def graded(rows: list[np.ndarray], toxic: np.ndarray, columns: int) -> np.ndarray:
    """Grades 0 to 2 from labels 0 and 1: toxic texts with ``SEVERE_FROM`` markers are 2."""
    flat = np.concatenate([*rows, np.zeros(0, dtype=np.int64)])
    label = np.repeat(toxic, [len(r) for r in rows])
    seen = np.bincount(flat, minlength=columns)
    marker = np.bincount(flat, weights=label, minlength=columns) >= MARKER_SHARE * np.maximum(seen, 1)
    return np.where(toxic > 0, 1 + (np.array([marker[r].sum() for r in rows]) >= SEVERE_FROM), 0)


def learn(docs: DataFrame, grades: DataFrame) -> Ordinal:
    """Fit on the labelled documents with the smallest hashes of their id.

    ``docs``: (doc_id, text); ``grades``: (doc_id, grade from 0); grades that are
    only 0 and 1 are refined by ``graded``. At most
    ``SAMPLE_LABELS`` ids are chosen and broadcast, so no text is shuffled; the
    words are counted by Spark and only the ``SAMPLE_WORDS`` that tell most about
    the grade are numbered.
    """
    chosen = (
        grades.where("doc_id is not null and grade is not null")
        .groupBy("doc_id")
        .agg(F.max("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_LABELS)
    )
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def distinct_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [[w.decode("latin-1") for w in features(t)] for t in frame["text"]]
            yield pd.DataFrame({"grade": frame["grade"], "words": found})

    rows = labelled.mapInPandas(distinct_words, "grade int, words array<string>")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.avg("grade"), F.lit(0.0)).alias("mean")).head()
    if not total["n"]:
        return Ordinal({}, np.array([np.inf]))
    spread = F.sum(F.col("grade") - F.lit(total["mean"]))
    vocabulary = (
        rows.select("grade", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"), (spread * spread / F.count("*")).alias("told"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
        .orderBy(F.desc("told"), "word")
        .limit(SAMPLE_WORDS)
        .select("word")
        .collect()
    )
    number = {r["word"].encode("latin-1"): i for i, r in enumerate(vocabulary)}

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [sorted(number[w] for w in number.keys() & features(t)) for t in frame["text"]]
            yield pd.DataFrame({"grade": frame["grade"], "found": found})

    sample = labelled.mapInPandas(numbered, "grade int, found array<int>").collect()
    sample.sort(key=lambda r: (r["grade"], r["found"]))  # the order of rows must not matter
    rows_of = [np.array(r["found"], dtype=np.int64) for r in sample]
    seen = np.array([r["grade"] for r in sample])
    if len(seen) and seen.max() == 1:
        seen = graded(rows_of, seen, len(number))
    weights, _ = fit_ordinal(rows_of, seen, len(number))
    # The penalty also shrinks what it selects; a second fit on the selection undoes that.
    place = np.cumsum(weights != 0) - 1
    kept = [place[r[weights[r] != 0]] for r in rows_of]
    again, thresholds = fit_ordinal(kept, seen, int((weights != 0).sum()), LIGHT_PENALTY, 5 * ROUNDS)
    return Ordinal({w: float(again[place[i]]) for w, i in number.items() if weights[i]}, thresholds)


def predict(df: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """Add ``severity`` (expected grade), ``p_toxic`` (P(grade > 0)), ``grade`` (most
    likely, ties to the lower) and ``toxic``. A null text counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            above = [shared.value.above(t) for t in part]
            grade = [int(np.argmax(-np.diff(np.concatenate(([1.0], a, [0.0]))))) for a in above]
            yield pd.DataFrame({"severity": [float(a.sum()) for a in above], "p_toxic": [float(a[0]) for a in above], "grade": grade})
        release()

    run = F.pandas_udf(run, RESULT)
    found = free_name(df, "found")
    names = [free_name(df, c) for c in ("severity", "p_toxic", "grade", "toxic")]
    with_all = df.withColumn(found, run(F.col(text)))
    fields = [F.col(f"{found}.{c}").alias(n) for c, n in zip(("severity", "p_toxic", "grade"), names, strict=False)]
    return with_all.select(*df.columns, *fields, (F.col(f"{found}.p_toxic") >= TOXIC_FROM).alias(names[3]))


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 not toxic, 1 toxic; a document with both labels is toxic."""
    return labels.select("doc_id", F.col("toxic").cast("int").alias("grade"))


def fitted(docs: DataFrame, labels: DataFrame) -> Ordinal:
    """Model from the labelled documents that are not held out."""
    return learn(docs.where(remainder(F.col("doc_id")) != 2), grades_of(labels).where(remainder(F.col("doc_id")) != 2))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return predict(docs, model).drop("text")


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
