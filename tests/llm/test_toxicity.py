"""Ordinal model: gradient and fit, held-out quality, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revloom.llm import toxicity as tx

SF = "/root/testdata/sf0.1"


def test_fit_recovers_an_ordered_rule():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(30) < 0.2) for _ in range(2000)]
    score = np.array([3.0 * (0 in r) + 3.0 * (1 in r) for r in rows])
    grades = (score >= 3).astype(int) + (score >= 6)
    weights, thresholds = tx.fit_ordinal(rows, grades, 30, 0.001, 2000)
    assert set(np.flatnonzero(weights > 0.5)) == {0, 1}
    assert (np.diff(thresholds) > 0).all()
    assert 0 < thresholds[0] < weights[0] < thresholds[1] < weights[0] + weights[1]


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("toxic", "label")
    out = tx.op4_toxicity(spark, SF)
    assert out.columns == ["doc_id", "severity", "p_toxic", "grade", "toxic"] and out.count() == 10_000
    held = out.join(labels, "doc_id").where(tx.remainder(F.col("doc_id")) == 2)
    n = {(r.label, r.toxic): r["count"] for r in held.groupBy("label", "toxic").count().collect()}
    assert n[1, True] >= 0.75 * (n[1, True] + n[1, False])
    assert n.get((0, True), 0) <= 0.02 * n[0, False]
    mean = {r.label: r.s for r in held.groupBy("label").agg(F.avg("severity").alias("s")).collect()}
    assert mean[1] > 10 * mean[0]


@pytest.fixture(scope="module")
def model():
    return tx.Ordinal({b"=scum": 5.0, b"^disgus": 4.0}, np.array([3.0, 6.0]))


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 1), (3, "You SCUM!!", 1), (3, "You SCUM!!", 1), (None, "disgusting scum", 1), (5, "fine " * 90_000 + "scum", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    out = tx.predict(df, model)
    assert out.columns == ["doc_id", "text", "grade", "severity", "p_toxic", "grade_", "toxic"]
    got = sorted([(str(r.doc_id), r.grade_, r.toxic) for r in out.collect()])
    assert got == [("1", 0, False), ("2", 0, False), ("3", 1, True), ("3", 1, True), ("5", 1, True), ("None", 2, True)]
    assert tx.predict(df.limit(0), model).count() == 0


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, grade int")
    out = tx.predict(docs, tx.learn(docs, none)).collect()
    assert [(r.severity, r.toxic) for r in out] == [(0.0, False)] * 2
