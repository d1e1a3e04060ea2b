"""The shard-by-shard classifier against plain loops, and its skill."""

import random

import pytest
from pyspark.sql import functions as F

from revloom.operators import evaluate, features, linear, split

ROWS = "doc_id long, label int, shard int, text string"


def texts(n, seed=0):
    """Two classes that differ in how often they use some of the common words."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    out = []
    for d in range(n):
        label = int(rng.random() < 0.3)
        own = ["bad", "worse"] if label else ["good", "fine"]
        text = [rng.choice(words) for _ in range(rng.randrange(5, 30))]
        text += [w for w in own if rng.random() < 0.7] + [w for w in ("bad", "good") if rng.random() < 0.1]
        out.append((d, label, d % 3, " ".join(text)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(400), ROWS).cache()


@pytest.fixture(scope="module")
def tf(docs):
    return features.term_counts(docs, "doc_id", "text").cache()


def weights(model):
    return {r["term"]: pytest.approx(r["weight"], abs=1e-12) for r in model.weights.collect()}


def test_steps_like_plain_loops(spark):
    rows = texts(60, 1)
    df = spark.createDataFrame(rows, ROWS)
    found = linear.fit_shards(features.term_counts(df, "doc_id", "text"), df, "doc_id", batches=2, passes=2)
    number = {r[0]: r[1] for r in df.select("doc_id", linear.batch_number("doc_id", 2)).collect()}
    counts = {d: {w: t.split().count(w) for w in set(t.split())} for d, _, _, t in rows}
    w, bias, k, norm = {}, 0.0, 0, None
    for _ in range(2):
        for shard in range(3):
            for batch in range(2):
                mine = [(d, 2 * y - 1) for d, y, s, _ in rows if s == shard and number[d] == batch]
                if not mine:
                    continue
                if norm is None:
                    norm = 1 + sum(n * n for d, _ in mine for n in counts[d].values()) / len(mine)
                k += 1
                rate = linear.RATE / (norm * k**0.5)
                short = [(d, y) for d, y in mine if y * (bias + sum(w.get(t, 0) * n for t, n in counts[d].items())) < 1]
                w = {t: x * (1 - rate * linear.L2) for t, x in w.items()}
                for d, y in short:
                    for t, n in counts[d].items():
                        w[t] = w.get(t, 0) + rate * y * n / len(mine)
                bias += rate * sum(y for _, y in short) / len(mine)
    assert weights(found) == w and found.bias == pytest.approx(bias) and found.steps == k


def test_going_on_from_a_stored_model_is_training_on_all(spark, docs, tf, tmp_path):
    whole = linear.fit_shards(tf, docs, "doc_id", batches=1)
    model = None
    for shard in range(3):
        model = linear.fit_shards(tf, docs.where(F.col("shard") == shard), "doc_id", batches=1, start=model)
        linear.save(model, str(tmp_path / f"m{shard}"))
        model = linear.load(spark, str(tmp_path / f"m{shard}"))
    assert weights(model) == weights(whole) and model.bias == pytest.approx(whole.bias) and model.steps == 3


def test_skill_beyond_the_larger_class(docs, tf):
    parts = split.holdout_split(docs, "doc_id", one_in=3)
    train, test = (parts.where(F.col("split") == p) for p in ("train", "test"))
    model = linear.fit_shards(tf, train, "doc_id", batches=4, passes=3)
    judged = linear.predict(model, tf, test.select("doc_id", "label"), "doc_id")
    row = evaluate.report([evaluate.predictions(judged, "m", "label", "prediction")]).first()
    negatives = test.where("label = 0").count() / test.count()
    assert row["accuracy"] > 100 * negatives + 8 and row["f1"] > 75


def test_odd_rows(spark):
    """Documents without terms, a shard without a number, an empty table."""
    rows = [(1, 1, None, "bad bad"), (2, 0, 0, "good"), (3, 0, 0, ""), (4, 1, 1, "bad good")]
    df = spark.createDataFrame(rows, ROWS)
    tf = features.term_counts(df, "doc_id", "text")
    model = linear.fit_shards(tf, df, "doc_id", batches=1)
    assert model.steps == 3 and set(weights(model)) == {"bad", "good"}
    judged = {r["doc_id"]: r["score"] for r in linear.predict(model, tf, df, "doc_id").collect()}
    assert judged[3] == pytest.approx(model.bias) and judged[1] > judged[2]
    none = linear.fit_shards(tf, df.where("doc_id > 9"), "doc_id")
    assert none.steps == 0 and none.weights.count() == 0
