import math
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from revloom.operators import bayes, cleaning, evaluate, features, models, split, tokens
from revloom.session import scratch_path, written

DOCS = [
    (1, 0, "red red blue"),
    (2, 0, "blue sky blue"),
    (3, 1, "green sky"),
    (4, 1, "red green green"),
    (5, 1, "a ! ?"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, label int, text string").cache()


@pytest.fixture(scope="module")
def tf(docs):
    return features.term_counts(docs, "doc_id", "text", keep=["label"]).cache()


def test_term_counts_shuffle_nothing(docs):
    plan = features.term_counts(docs, "doc_id", "text", 1, 2)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_terms_are_sorted_without_a_comparator(docs):
    plan = features.term_counts(docs, "doc_id", "text", 1, 2)._jdf.queryExecution().analyzed().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_narrow_rows_are_ranked_without_a_join(tf):
    plan = features.indexed_vocabulary(tf, block_rows=1)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join") == 1  # with the totals of the partitions


@pytest.mark.parametrize("hot_share", [1, 4, 10_000])
def test_look_up_of_stored_rows(spark, tf, monkeypatch, hot_share):
    monkeypatch.setattr(features, "HOT_SHARE", hot_share)
    table = spark.createDataFrame([("blue", 90, "b"), ("red", 9, "r"), ("sea", 1, "s")], "term string, w long, v string")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    args = (tf, table, ["term"], "w", ["v"], "doc_id")
    assert key(features.look_up(*args, stored=True)) == key(features.look_up(*args))
    # Rows that the frequent terms answer reach no shuffle.
    plan = features.look_up(*args, stored=True)._jdf.queryExecution().analyzed().toString()
    assert plan.count("LeftAnti") == 1


def test_vocabulary_index_and_hot_ranking(tf):
    plain = {r["term"]: tuple(r) for r in features.indexed_vocabulary(tf).collect()}
    assert [t for t in sorted(plain)] == ["blue", "green", "red", "sky"]
    assert plain["blue"] == ("blue", 3, 2, 0) and plain["sky"] == ("sky", 2, 2, 3)
    blocks = features.indexed_vocabulary(tf, block_rows=1)
    assert {r["term"]: tuple(r) for r in blocks.select("term", "tf", "df", "term_index").collect()} == plain


def test_fixed_vocabulary_keeps_documents_without_hits(spark, docs, tf):
    vocab = spark.createDataFrame([("sky", 1), ("sea", 1)], "term string, df long")
    known = features.with_all_documents(features.restrict(tf, vocab, "doc_id"), docs, "doc_id")
    assert {(r["doc_id"], r["term"], r["tf"]) for r in known.collect()} == {
        (1, None, 0),
        (2, "sky", 1),
        (3, "sky", 1),
        (4, None, 0),
        (5, None, 0),
    }


@pytest.mark.parametrize("hot_share", [1, 4, 10_000])
def test_look_up_of_hot_and_other_terms(spark, tf, monkeypatch, hot_share):
    monkeypatch.setattr(features, "HOT_SHARE", hot_share)
    table = spark.createDataFrame(
        [("blue", 90, "b"), ("red", 9, "r"), ("sea", 1, "s")], "term string, w long, v string"
    )
    got = features.look_up(tf, table, ["term"], "w", ["v"], "doc_id")
    rows = {(r["doc_id"], r["term"]): (r["tf"], r["v"], r["_found"]) for r in got.collect()}
    assert rows[1, "blue"] == (1, "b", True) and rows[1, "red"] == (2, "r", True)
    assert rows[2, "sky"] == (1, None, False)
    assert len(rows) == tf.count() == got.count()


def test_scaling(spark):
    docs = spark.createDataFrame([(1, "x x c"), (2, "c"), (3, "c y")], "doc_id long, text string")
    tf = features.term_counts(
        docs.withColumn("text", F.regexp_replace("text", r"(\w)", "$1$1")), "doc_id", "text"
    )
    got = {(r["doc_id"], r["term"]): r["tf_scaled"]
           for r in features.scale(tf, features.fit_scale(tf, docs), "doc_id").collect()}
    std = math.sqrt(4 / 3 - (2 / 3) ** 2)
    assert got[1, "xx"] == pytest.approx(2 / std)
    assert got[1, "cc"] == got[2, "cc"] == 1.0  # constant column stays
    assert got[3, "yy"] == pytest.approx(1 / math.sqrt(1 / 3 - 1 / 9))


def test_bayes_against_counting_by_hand(docs, tf):
    counts = bayes.count(tf, docs, "label")
    got = {(r["label"], r["term"]): (r["log_prob"], r["log_prior"])
           for r in bayes.model(counts).collect()}
    words = {c: Counter(w for _, label, t in DOCS if label == c for w in t.split() if len(w) > 1)
             for c in (0, 1)}
    vocab = set(words[0]) | set(words[1])
    prior = {0: math.log(2 / 5), 1: math.log(3 / 5)}
    logp = {
        (c, w): math.log((words[c][w] + 1) / (sum(words[c].values()) + len(vocab)))
        for c in (0, 1)
        for w in vocab
    }
    assert got.keys() == logp.keys()
    for key, value in logp.items():
        assert got[key] == pytest.approx((value, prior[key[0]]))
    answers = bayes.predict(counts, tf.drop("label"), docs.select("doc_id"), "doc_id")
    answers = {r["doc_id"]: (r["prediction"], r["margin"]) for r in answers.collect()}
    for doc_id, _, text in DOCS:
        score = [
            prior[c] + sum(logp[c, w] for w in text.split() if len(w) > 1) for c in (0, 1)
        ]
        assert answers[doc_id][0] == int(score[1] > score[0])
        assert answers[doc_id][1] == pytest.approx(abs(score[1] - score[0]))


def test_bayes_by_shards_is_the_same(docs, tf):
    whole = bayes.count(tf, docs, "label")
    odd = F.col("doc_id") % 2 == 1
    parts = [bayes.count(tf.where(c), docs.where(c), "label") for c in (odd, ~odd)]
    rows = lambda counts: sorted(tuple(r) for r in bayes.model(counts).collect())
    assert rows(bayes.add(parts)) == rows(whole)


def test_bayes_over_a_fixed_vocabulary(spark, docs, tf):
    vocab = spark.createDataFrame([("red",), ("sea",)], "term string")
    counts = bayes.over_vocabulary(bayes.count(tf, docs, "label"), vocab)
    got = {(r["label"], r["term"]): r["log_prob"] for r in bayes.model(counts).collect()}
    assert got[0, "red"] == pytest.approx(math.log(3 / 4))
    assert got[1, "sea"] == pytest.approx(math.log(1 / 3))


def test_bayes_refuses_negative_values(docs, tf):
    with pytest.raises(Exception, match="negative feature value"):
        bayes.count(tf.withColumn("tf", -F.col("tf")), docs, "label").terms.collect()


def test_metrics_with_undefined_ones(spark):
    rows = [("m", 1, 1), ("m", 0, 1), ("m", 0, 0), ("m", 1, 0), ("m", 0, 0),
            ("none said", 1, 0), ("none said", 0, 0), ("none true", 0, 0)]
    df = spark.createDataFrame(rows, "model string, truth int, prediction int")
    report = {r["model"]: r for r in evaluate.report([df]).collect()}
    m = report["m"]
    assert (m["tp"], m["fp"], m["tn"], m["fn"], m["mistakes"]) == (1, 1, 2, 1, 2)
    assert m["accuracy"] == pytest.approx(60) and m["f1"] == pytest.approx(50)
    assert report["none said"]["precision"] is None and report["none said"]["f1"] is None
    assert report["none said"]["recall"] == 0
    assert report["none true"]["recall"] is None and report["none true"]["accuracy"] == 100


def test_threshold(spark):
    df = spark.createDataFrame([(0.5,), (0.51,)], "s double")
    assert [r[1] for r in evaluate.threshold(df, "s").collect()] == [0, 1]


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for cut in (split.holdout_split, split.seeded_split):
        a = {tuple(r) for r in cut(df, "k").collect()}
        assert a == {tuple(r) for r in cut(df.repartition(7), "k").collect()}
    share = split.holdout_split(df, "k").where("split = 'test'").count()
    assert 60 < share < 140


def test_complete_cases_drop_whole_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "c", None)], "k int, t string, l int")
    assert [r["k"] for r in cleaning.complete_cases(df, ["t", "l"]).collect()] == [1]
    assert tuple(cleaning.case_counts(df, ["t", "l"]).first()) == (1, 2)


@pytest.fixture(scope="module")
def separable(spark):
    """Two classes with words of their own among common ones."""
    rows = [
        (i, i % 2, " ".join(["common", "word", ("left" if i % 2 else "right"), f"noise{i % 5}"]))
        for i in range(80)
    ]
    df = spark.createDataFrame(rows, "doc_id long, label int, text string")
    return models.with_terms(df, "text", 1, 2).cache()


@pytest.mark.parametrize("fit, width", [
    (models.fit_bayes, 512), (models.fit_linear, 512), (models.fit_net, 64),
])
def test_models_learn_separable_classes(separable, fit, width):
    model = fit(separable, width)
    right = model.transform(separable).where(F.col("prediction") == F.col("label")).count()
    assert right >= 76


def test_embedding(spark):
    texts = [(i, "king queen crown" if i % 2 else "tree leaf root") for i in range(40)]
    df = spark.createDataFrame([*texts, (99, "!")], "doc_id long, text string")
    tagged = tokens.tagged(df, "doc_id", "text", "word")
    model = models.fit_embedding(tagged, dimensions=8, passes=2, partitions=2)
    vectors = {r["tag"]: r["vector"] for r in models.embed(model, tagged).collect()}
    assert len(vectors) == 41 and vectors[99].norm(2) == 0
    assert vectors[1] == vectors[3] and vectors[1].size == 8


def test_embedding_has_one_size_for_any_vocabulary(spark):
    df = spark.createDataFrame([(i, f"w{i} w{i} w{i % 5}") for i in range(200)], "doc_id int, text string")
    tagged = tokens.tagged(df, "doc_id", "text", "word")
    model = models.fit_embedding(tagged, dimensions=8, passes=1, least_count=1, partitions=2, buckets=16)
    assert model.getVectors().count() <= 16
    rows = models.embed(model, tagged, buckets=16)
    assert rows.count() == 200 and rows.columns == [*tagged.columns, "vector"]


def test_linear_keeps_a_column_that_does_not_vary(spark):
    train = spark.createDataFrame([(1, "good same"), (0, "bad same")] * 10, "label int, text string")
    fitted = models.fit_linear(models.with_terms(train, "text"), width=64)
    constant = fitted.transform(models.with_terms(spark.createDataFrame([(1, "same")], train.schema), "text"))
    assert sorted(constant.head()["features"].values) == [1.0]


def test_counts_of_repeated_and_odd_documents(spark):
    """One id in two rows, null ids, no terms, null texts: counts of an id add up."""
    rows = [(1, "bb aa bb"), (1, "aa cc"), (None, "aa aa"), (None, "aa"), (2, ""), (3, None), (4, "! ?")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["term"]): r["tf"] for r in features.term_counts(df, "doc_id", "text", 1, 2).collect()}
    assert got == {
        (1, "bb"): 2, (1, "aa"): 2, (1, "cc"): 1, (1, "bb aa"): 1, (1, "aa bb"): 1, (1, "aa cc"): 1,
        (None, "aa"): 3, (None, "aa aa"): 1,
    }


def test_scale_fitted_on_a_part(spark):
    rows = [(1, "a1", "train"), (2, "a1 a1 b1", "train"), (3, "a1 a1 a1 c1", "test"), (4, "", "train")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, split string")
    tf = features.term_counts(docs, "doc_id", "text", keep=["split"])
    stds = features.fit_scale(tf, docs, fit_on=F.col("split") == "train")
    got = {(r["doc_id"], r["term"]): r["tf_scaled"] for r in features.scale(tf, stds, "doc_id").collect()}
    std = math.sqrt((0 + 1 + 4) / 3 - 1)
    assert got[3, "a1"] == pytest.approx(3 / std) and got[3, "c1"] == 1.0
    assert got[2, "b1"] == pytest.approx(1 / math.sqrt(1 / 3 - 1 / 9))


def test_scale_keeps_digits_of_large_counts(spark):
    """Counts near a hundred million that differ by one."""
    n = 100_000_000
    tf = spark.createDataFrame([(i, "t", n + i % 2) for i in range(4)], "doc_id long, term string, tf long")
    stds = features.fit_scale(tf, spark.range(4).withColumnRenamed("id", "doc_id"))
    assert stds.first()["std"] == pytest.approx(0.5, rel=1e-6)


def test_document_vectors_of_seen_and_unseen_texts(spark):
    """Two topics; a document lies nearer to its topic, also one that was never seen."""
    topics = ["king queen crown throne court", "tree leaf root branch bark"]
    rng = random.Random(1)
    text = lambda t: " ".join(rng.choices(topics[t].split(), k=8))
    seen = [(i, text(i % 2)) for i in range(60)]
    new = [(100 + i, text(i % 2)) for i in range(10)] + [(200, seen[0][1]), (201, "zzz !"), (202, "")]
    words = lambda rows: tokens.tagged(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", "word")
    model = models.fit_embedding(words(seen), dimensions=16, passes=5, partitions=2)
    infer = lambda rows, n: {r[0]: np.array(r[1]) for r in models.infer_vectors(model, words(rows).repartition(n), "doc_id").collect()}
    old, fresh = infer(seen, 1), infer(new, 3)
    again = infer(new, 2)
    assert all((fresh[k] == again[k]).all() for k in fresh) and len(fresh) == 13
    assert (fresh[200] == old[0]).all() and not fresh[201].any() and not fresh[202].any()
    centre = [np.mean([v for k, v in old.items() if k % 2 == t], axis=0) for t in (0, 1)]
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    for k in range(100, 110):
        assert cosine(fresh[k], centre[k % 2]) > cosine(fresh[k], centre[1 - k % 2]) + 0.01


def test_document_vector_is_the_maximum(spark):
    """More passes come nearer to where the pulls cancel out."""
    rng = np.random.default_rng(0)
    words, noise = rng.normal(size=(6, 4)), rng.normal(size=(30, 4))
    counts = np.array([1, 2, 1, 3, 1, 1])
    last = models.document_vector(counts, words, noise, 5000)
    far = [np.linalg.norm(models.document_vector(counts, words, noise, n) - last) for n in (1, 10, 30, 300)]
    assert far == sorted(far, reverse=True) and far[2] < 0.2 * np.linalg.norm(last)


def test_document_vector_follows_the_pulls_of_words_and_noise():
    """As the steps are written down; rows may come as single-precision numbers."""
    rng = np.random.default_rng(4)
    words, noise = rng.normal(size=(7, 5)).astype(np.float32), rng.normal(size=(35, 5)).astype(np.float32)
    counts, vector = np.arange(1, 8), np.zeros(5)
    weight, w, n = counts / counts.sum(), words.astype(float), noise.astype(float)
    bound = models.VECTOR_L2 + 0.25 * (weight @ (w**2).sum(axis=1) + models.NOISE * (n**2).sum(axis=1).mean())
    for _ in range(12):
        real, false = weight / (1 + np.exp(w @ vector)), models.NOISE / len(n) / (1 + np.exp(-(n @ vector)))
        vector = vector + (real @ w - false @ n - models.VECTOR_L2 * vector) / bound
    found = models.document_vector(counts, words, noise, 12)
    assert found.dtype == np.float64 and np.abs(found - vector).max() < 1e-12


def test_uneven_rows_can_be_read_apart(spark):
    rows = spark.range(0, 40_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    groups = []
    for size in (None, 1 << 18):
        for file in written(rows, "uneven", row_group=size).inputFiles():
            groups.append(pq.ParquetFile(file.removeprefix("file://")).num_row_groups)
    assert groups[0] == 1 and groups[1] > 4


def net_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        label = int(rng.random() < 0.35)
        noise = " ".join(rng.choices([f"w{i}" for i in range(20)], k=12))
        rows.append((d, label, f"{noise} {'bad worse' if label else 'good fine'}" if rng.random() < 0.9 else noise))
    return rows


def test_net_after_each_pass(spark):
    """The loss on held-out rows falls; the last pass is what the plain fit gives."""
    df = models.with_terms(spark.createDataFrame(net_rows(500, 2), "doc_id long, label int, text string"), "text")
    parts = split.seeded_split(df, "doc_id")
    train, test = (parts.where(F.col("split") == p).cache() for p in ("train", "test"))
    rows, judged = [], None
    for number, model in enumerate(models.net_passes(train, 128, 10), start=1):
        judged = evaluate.threshold(models.positive_score(model.transform(test).drop("prediction")), "score")
        rows.append(evaluate.curve_row(judged, number, "label", "score", "prediction").first())
    assert [r["pass"] for r in rows] == [*range(1, 11)] and rows[-1]["loss"] < rows[0]["loss"]
    plain = models.positive_score(models.fit_net(train, 128, 10).transform(test).drop("prediction"))
    plain = evaluate.threshold(plain, "score")
    report = evaluate.report([evaluate.predictions(plain, "net", "label", "prediction")]).first()
    assert [report[c] for c in ("tp", "fp", "tn", "fn")] == [rows[-1][c] for c in ("tp", "fp", "tn", "fn")]
    larger = max(test.where("label = 0").count(), test.where("label = 1").count()) / test.count()
    assert rows[-1]["accuracy"] > 100 * larger + 5


def test_embedding_reads_every_text_once(spark):
    """Few jobs however many passes, a fixed number of columns, vectors that tell topics
    apart, and the same after saving and loading."""
    topics = ["king queen crown throne court", "tree leaf root branch bark"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(topics[i % 2].split(), k=12)) + f" the rare{i % 300}") for i in range(1500)]
    tagged = tokens.tagged(spark.createDataFrame([*rows, (-1, None)], "doc_id long, text string"), "doc_id", "text", "word")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("embedding", "fit")
    model = models.fit_embedding(tagged, dimensions=16, passes=200)
    assert len(jobs("embedding")) < 20
    spark.sparkContext.setJobGroup("rest", "rest")
    path = scratch_path(spark, "embedding")
    models.save_embedding(model, path)
    vectors = {r["doc_id"]: r["vector"] for r in models.embed(models.load_embedding(spark, path), tagged).collect()}
    cosine = lambda a, b: vectors[a].dot(vectors[b]) / vectors[a].norm(2) / vectors[b].norm(2)
    assert not vectors[-1].norm(2) and min(cosine(0, k) for k in range(2, 90, 2)) > max(cosine(0, k) for k in range(1, 90, 2))
    words = {r["word"]: np.array(r["vector"]) for r in model.getVectors().collect()}
    assert 308 <= len(words) <= 311 and all(abs(np.linalg.norm(v) - 1) < 0.01 for v in words.values())


def test_net_loss_has_the_gradient_of_its_sparse_rows():
    """Against differences, with an empty row and a repeated column, and in two slices."""
    rng = np.random.default_rng(5)
    layers = [6, 4, 3, 2]
    columns = np.array([0, 3, 5, 3, 1, 0], dtype=np.int32)
    pack = {
        "labels": np.array([1, 0, 1, 0], dtype=np.int8), "ends": np.array([0, 3, 3, 5, 6], dtype=np.int32), "columns": columns,
        "counts": np.array([1, 2, 1, 4, 1, 3], dtype=np.float32),
    }
    weights = rng.normal(size=sum((a + 1) * b for a, b in zip(layers, layers[1:], strict=False)))
    value, gradient = models.net_loss(weights, layers, pack)
    assert np.allclose(models.net_loss(weights, layers, pack, cells=18)[1], gradient)
    steps = np.eye(len(weights)) * 1e-6
    slopes = [(models.net_loss(weights + s, layers, pack)[0] - models.net_loss(weights - s, layers, pack)[0]) / 2e-6 for s in steps]
    assert value > 0 and np.allclose(slopes, gradient, atol=1e-6)


def test_net_works_on_entries_and_agrees_with_spark(spark):
    """The same weights as Spark ML's fit, which holds all rows as dense ones."""
    train = models.with_terms(spark.createDataFrame(net_rows(200, 4), "doc_id long, label int, text string"), "text").cache()
    ours = next(models.net_passes(train, 64, 1)).stages[1].weights.toArray()
    hashed = models._hashing(64, "features").transform(train)
    step = models.MultilayerPerceptronClassifier(layers=[64, *models.HIDDEN, 2], maxIter=models.ITERATIONS, seed=models.SEED)
    assert np.allclose(ours, step.fit(hashed).weights.toArray(), atol=1e-6)
