"""Queries over classifiers, embeddings and their evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.functions.labels import label
from revloom.operators import bayes, cleaning, diff, evaluate, features, linear, models, split, tokens
from revloom.plans import views
from revloom.plans.changes import diff_text_cte
from revloom.plans.features import HASH_SQL, HOLDOUT_SQL, LABELLED_SQL, SEEDED_SQL, tf_sql
from revloom.session import ROW_GROUP, scratch_path, written
from revloom.sources import store

LONG_TEXT = 1_000
# Passes over the words where the vectors of documents are trained afterwards.
WORD_PASSES = 5


def _labelled(spark, sf):
    """(doc_id, text, label, split) of the labelled documents."""
    docs = views.table(spark, sf, "documents").select("doc_id", "text")
    labels = views.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return split.holdout_split(docs.join(labels, "doc_id"), "doc_id")


def _part(docs, name):
    return docs.where(F.col("split") == name)


def _count(train):
    tf = features.term_counts(train, "doc_id", "text", 1, 2, keep=["label"])
    return bayes.count(tf, train, "label")


def _fitted(spark, sf):
    return _count(_part(_labelled(spark, sf), "train"))


def _rounded_model(counts):
    return bayes.model(counts).select(
        "label",
        "term",
        F.round("log_prob", 6).alias("log_prob"),
        F.round("log_prior", 6).alias("log_prior"),
    )


def nb_model(spark, sf):
    return _rounded_model(_fitted(spark, sf))


def nb_incremental(spark, sf):
    """Two shards counted apart and added up."""
    train = _part(_labelled(spark, sf), "train")
    parts = [_count(train.where(F.col("doc_id") % 2 == shard)) for shard in (0, 1)]
    return _rounded_model(bayes.add(parts))


def _bayes(docs):
    """Fit on the training part of (doc_id, text, label, split), predict the rest."""
    test = _part(docs, "test")
    tf = features.term_counts(test, "doc_id", "text", 1, 2)
    truth = test.select("doc_id", "label")
    return bayes.predict(bayes.fitted(_count(_part(docs, "train"))), tf, truth, "doc_id")


def _predicted(spark, sf):
    return _bayes(_labelled(spark, sf))


def nb_predict(spark, sf):
    return _predicted(spark, sf).withColumn("margin", F.round("margin", 4))


def _evaluated(spark, sf):
    """Two models: naive Bayes on toxic, and a length rule on quality."""
    docs = views.table(spark, sf, "documents").select("doc_id", "n_chars")
    quality = docs.join(views.table(spark, sf, "labels"), "doc_id")
    rule = evaluate.threshold(quality, "n_chars", LONG_TEXT)
    return evaluate.predictions(
        _predicted(spark, sf), "naive bayes", "label", "prediction"
    ).unionByName(evaluate.predictions(rule, "length rule", "quality", "prediction"))


def confusion(spark, sf):
    return evaluate.confusion(_evaluated(spark, sf))


def metrics(spark, sf):
    return evaluate.metrics(evaluate.confusion(_evaluated(spark, sf)))


def reverted_from_diff(spark, sf):
    """From histories to a judged classifier: was an edit reverted, by its diff?

    The diffs are written, as a prepared corpus would be, and read for training
    and for prediction.
    """
    edits = diff.diff_text(
        views.rev_tagged(spark, sf), ["page"], ["rev"], {"content_diff": "content"}, carry=("tags",)
    )
    prepared = written(edits.select("rev", "content_diff", "tags"), "edits", row_group=ROW_GROUP)
    docs = cleaning.feature_text(prepared, "content_diff").select(
        F.col("rev").alias("doc_id"), "text", label(F.col("tags"), "medium").alias("label")
    )
    judged = _bayes(split.holdout_split(docs, "doc_id"))
    return evaluate.confusion(evaluate.predictions(judged, "diff", "label", "prediction"))


def nb_scaled(spark, sf):
    """The whole chain on diffs: vocabulary of another corpus, counts, scaling per
    shard, features stored by shard with their label, a classifier over both shards.
    """
    edits = diff.diff_text(
        views.rev_tagged(spark, sf), ["page"], ["rev"], {"content_diff": "content"}, carry=("tags",)
    )
    docs = edits.select(
        F.col("rev").alias("doc_id"),
        F.col("content_diff").alias("text"),
        label(F.col("tags"), "medium").alias("label"),
        (F.col("rev") % 2).alias("shard"),
    )
    docs = written(split.holdout_split(docs, "doc_id"), "edits", row_group=ROW_GROUP)
    items = views.table(spark, sf, "benchmark")
    vocab = features.fit_vocabulary(features.term_counts(items, "item_id", "text", 1, 2))
    keep = ["label", "split", "shard"]
    tf = features.term_counts(docs, "doc_id", "text", 1, 2, keep=keep)
    tf = written(features.restrict(tf, vocab, "doc_id"), "counts")
    scaled = features.scale(tf, features.fit_scale(tf, docs, ["shard"]), "doc_id", ["shard"], stored=True)
    path = scratch_path(spark, "scaled")
    store.write_features(scaled.drop("tf").withColumnRenamed("tf_scaled", "tf"), path)
    stored = store.read_features(spark, path)
    train = _part(docs, "train")
    parts = [
        bayes.count(_part(stored, "train").where(F.col("shard") == s), train.where(F.col("shard") == s), "label")
        for s in (0, 1)
    ]
    model = bayes.fitted(bayes.over_vocabulary(bayes.add(parts), vocab))
    truth = _part(docs, "test").select("doc_id", "label")
    seen = _part(stored, "test").select("doc_id", "term", "tf")
    judged = bayes.predict(model, seen, truth, "doc_id")
    return evaluate.confusion(evaluate.predictions(judged, "scaled diff", "label", "prediction"))


# Batches per shard of the classifier that is trained shard by shard.
STEPS = 2


def _by_shards(spark, sf):
    """One pass over two shards, the second going on where the first ended."""
    docs = _labelled(spark, sf).withColumn("shard", F.col("doc_id") % 2)
    tf = written(features.term_counts(docs, "doc_id", "text", keep=["split", "shard"]), "counts")
    model = None
    for one in (0, 1):
        train = _part(docs, "train").where(F.col("shard") == one)
        mine = _part(tf, "train").where(F.col("shard") == one)
        model = linear.fit_shards(mine, train, "doc_id", batches=STEPS, start=model)
    return model, tf, docs


def linear_by_shards(spark, sf):
    """The weights after one pass, and the bias as the weight of no term."""
    model, _, _ = _by_shards(spark, sf)
    bias = spark.range(1).select(F.lit(None).cast("string").alias("term"), F.lit(model.bias).alias("weight"))
    rows = model.weights.select("term", "weight").unionByName(bias)
    return rows.withColumn("weight", F.round("weight", 9))


def linear_predict(spark, sf):
    """Scores and classes of the documents held out, by the model after one pass."""
    model, tf, docs = _by_shards(spark, sf)
    test = _part(docs, "test").select("doc_id", "label")
    judged = linear.predict(model, _part(tf, "test"), test, "doc_id")
    return judged.withColumn("score", F.round("score", 6))


def _vectors(spark, sf, high):
    docs = _labelled(spark, sf)
    return models.with_terms(docs, "text", 1, high)


def _transformed(model, docs):
    return model.transform(_part(docs, "test")).select(
        "doc_id", "label", F.col("prediction").cast("int").alias("prediction")
    )


def _linear(spark, sf):
    docs = _vectors(spark, sf, 2)
    return _transformed(models.fit_linear(_part(docs, "train")), docs)


def _net_documents(spark, sf):
    """The wide label of documents that have tags and a text, with their terms."""
    tagged = views.rev_tagged(spark, sf).where("tags is not null and content is not null")
    docs = tagged.select(
        F.col("rev").alias("doc_id"),
        F.col("content").alias("text"),
        label(F.col("tags"), "wide").alias("label"),
    )
    return models.with_terms(split.seeded_split(docs, "doc_id"), "text")


def _net(spark, sf):
    """The net after its last pass, on the documents held out."""
    docs = _net_documents(spark, sf)
    model = models.fit_net(_part(docs, "train"))
    scored = models.positive_score(model.transform(_part(docs, "test")).drop("prediction"))
    return evaluate.threshold(scored, "score").select("doc_id", "label", "score", "prediction")


def _judged(predicted):
    """Key and label of each row, and whether it got one of the two classes. The
    classes depend on the solver; the tests look at the skill of the models."""
    is_class = F.col("prediction").isin(0, 1).cast("int")
    return predicted.select("doc_id", "label", is_class.alias("judged"))


def nb_ml(spark, sf):
    docs = _vectors(spark, sf, 2)
    return _judged(_transformed(models.fit_bayes(_part(docs, "train")), docs))


def linear_svm(spark, sf):
    return _judged(_linear(spark, sf))


def linear_svm_scores(spark, sf):
    """What the linear classifier says of each document held out."""
    return _linear(spark, sf)


def mlp_scores(spark, sf):
    """Score and class that the net gives each document held out."""
    return _net(spark, sf)


def mlp_classifier(spark, sf):
    return _judged(_net(spark, sf).where("score between 0 and 1"))


def embedding_features(spark, sf):
    """Vectors as features: fitted on documents without a label, inferred for the
    labelled ones, stored with the label by shard, a linear classifier on top."""
    docs = views.table(spark, sf, "documents").select("doc_id", "text")
    labels = views.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    words = lambda df: tokens.tagged(df, "doc_id", "text", "word").select("doc_id", "tag", "words")
    model = models.fit_embedding(words(docs.join(labels, "doc_id", "left_anti")))
    vectors = models.embed(model, words(docs.join(labels, "doc_id", "left_semi")))
    path = scratch_path(spark, "vectors")
    stored = vectors.join(labels, "doc_id").select(
        "doc_id", "label", vector_to_array("vector").alias("numbers"), (F.col("doc_id") % 2).alias("shard")
    )
    store.write_features(stored, path)
    rows = split.holdout_split(store.read_features(spark, path), "doc_id")
    rows = rows.withColumn("features", array_to_vector("numbers"))
    predicted = models.fit_linear_on(_part(rows, "train")).transform(_part(rows, "test"))
    return _judged(predicted).join(rows.select("doc_id", F.size("numbers").alias("dimensions")), "doc_id")


def doc_embedding(spark, sf):
    """Fit on all documents, save, load and apply."""
    docs = views.table(spark, sf, "documents")
    tagged = tokens.tagged(docs, "doc_id", "text", "word").select("doc_id", "tag", "words")
    path = scratch_path(spark, "embedding")
    models.save_embedding(models.fit_embedding(tagged), path)
    embedded = models.embed(models.load_embedding(spark, path), tagged)
    numbers = vector_to_array("vector")
    finite = F.forall(numbers, lambda x: F.abs(x) < float("inf"))
    return embedded.select(
        "doc_id", F.size(numbers).alias("dimensions"), finite.cast("int").alias("finite")
    )


def document_vectors(spark, sf):
    """A trained vector per document: words fitted on those without a label, vectors
    inferred for all, seen and unseen alike."""
    docs = views.table(spark, sf, "documents").select("doc_id", "text")
    labels = views.table(spark, sf, "labels").select("doc_id")
    words = lambda df: tokens.tagged(df, "doc_id", "text", "word").select("doc_id", "tag", "words")
    model = models.fit_embedding(words(docs.join(labels, "doc_id", "left_anti")), passes=WORD_PASSES)
    vectors = models.infer_vectors(model, words(docs), "doc_id")
    return vectors.select("doc_id", F.transform("vector", lambda x: F.round(x, 4)).alias("vector"))


def full_report(spark, sf):
    """Counts and metrics of all models on the rows held out from each."""
    models_of = {"naive bayes": _predicted, "linear": _linear, "net": _net}
    parts = [evaluate.predictions(f(spark, sf), name, "label", "prediction") for name, f in models_of.items()]
    return evaluate.report(parts)


def model_metrics(spark, sf):
    """The whole report: counts and metrics of every model."""
    return full_report(spark, sf)


def validation_curve(spark, sf):
    """Loss and counts of the net on the rows held out, after each pass."""
    docs = _net_documents(spark, sf)
    train, test = _part(docs, "train"), _part(docs, "test")
    parts = []
    for number, model in enumerate(models.net_passes(train), start=1):
        judged = models.positive_score(model.transform(test).drop("prediction"))
        parts.append(evaluate.curve_row(evaluate.threshold(judged, "score"), number, "label", "score", "prediction"))
    return reduce(DataFrame.unionByName, parts)


def model_report(spark, sf):
    """The part of the report that does not depend on a solver."""
    rows = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    in_range = F.col("accuracy").between(0, 100).cast("int")
    return full_report(spark, sf).select(
        "model", rows.alias("rows"), (F.col("tp") + F.col("fn")).alias("positives"), in_range.alias("in_range")
    )


QUERIES = {
    "nb_model": nb_model,
    "nb_incremental": nb_incremental,
    "nb_predict": nb_predict,
    "nb_ml": nb_ml,
    "linear_by_shards": linear_by_shards,
    "linear_predict": linear_predict,
    "linear_svm": linear_svm,
    "doc_embedding": doc_embedding,
    "mlp_classifier": mlp_classifier,
    "embedding_features": embedding_features,
    "document_vectors": document_vectors,
    "linear_svm_scores": linear_svm_scores,
    "mlp_scores": mlp_scores,
    "model_metrics": model_metrics,
    "validation_curve": validation_curve,
    "confusion": confusion,
    "metrics": metrics,
    "model_report": model_report,
    "reverted_from_diff": reverted_from_diff,
    "nb_scaled": nb_scaled,
}

# --- SQL -------------------------------------------------------------------------

_MODEL_SQL = [
    tf_sql("tf", "docs", "doc_id, label, split", 2),
    "classes AS (SELECT label, ln(count(*) / (SELECT count(*) FROM docs WHERE split = 'train'))"
    " AS log_prior FROM docs WHERE split = 'train' GROUP BY label)",
    "vocab AS (SELECT DISTINCT term FROM tf WHERE split = 'train')",
    "n AS (SELECT label, term, sum(tf) AS n FROM tf WHERE split = 'train' GROUP BY ALL)",
    """model AS (
  SELECT c.label, v.term, c.log_prior, ln((coalesce(n.n, 0) + 1)
      / (t.tokens + (SELECT count(*) FROM vocab))) AS log_prob
  FROM classes c CROSS JOIN vocab v
  JOIN (SELECT label, sum(n) AS tokens FROM n GROUP BY label) t ON t.label = c.label
  LEFT JOIN n ON n.label = c.label AND n.term = v.term)""",
]
_PREDICT_SQL = [
    """scores AS (
  SELECT d.doc_id, d.label AS truth, c.label, c.log_prior + coalesce(s.s, 0) AS score
  FROM docs d CROSS JOIN classes c
  LEFT JOIN (SELECT tf.doc_id, m.label, sum(tf.tf * m.log_prob) AS s
             FROM tf JOIN model m USING (term) WHERE split = 'test' GROUP BY ALL) s
    ON s.doc_id = d.doc_id AND s.label = c.label
  WHERE d.split = 'test')""",
    """predicted AS (
  SELECT doc_id, any_value(truth) AS label,
    CASE WHEN max(score) FILTER (label = 1) > max(score) FILTER (label = 0)
      THEN 1 ELSE 0 END AS prediction,
    max(score) - min(score) AS margin
  FROM scores GROUP BY doc_id)""",
]
_COUNTS_SQL = """counts AS (
  SELECT model, count(*) FILTER (truth = 1 AND prediction = 1) AS tp,
    count(*) FILTER (truth = 0 AND prediction = 1) AS fp,
    count(*) FILTER (truth = 0 AND prediction = 0) AS tn,
    count(*) FILTER (truth = 1 AND prediction = 0) AS fn
  FROM judged GROUP BY model)"""
_EVALUATED_SQL = [
    LABELLED_SQL,
    *_MODEL_SQL,
    *_PREDICT_SQL,
    f"""judged AS (
  SELECT 'naive bayes' AS model, label AS truth, prediction FROM predicted
  UNION ALL
  SELECT 'length rule', quality, CAST(n_chars > {LONG_TEXT} AS INTEGER)
  FROM documents JOIN labels USING (doc_id))""",
    _COUNTS_SQL,
]
_DIFF_DOCS_SQL = f"""docs AS (
  SELECT doc_id, diff_text AS text, {HOLDOUT_SQL}, coalesce(CAST(list_has_any(
    (SELECT tags FROM tags t WHERE t.doc_id = d.doc_id), ['mw-reverted', 'Reverted'])
    AS INTEGER), 0) AS label
  FROM (SELECT rev AS doc_id, diff_text FROM rev_diff) d)"""
_SCALED_SQL = [
    tf_sql("bench", "benchmark", "item_id", 2),
    "vocab AS (SELECT DISTINCT term FROM bench)",
    tf_sql("counted", "sharded", "doc_id, label, split, shard", 2),
    "known AS (SELECT * FROM counted WHERE term IN (SELECT term FROM vocab))",
    """stds AS (
  SELECT shard, term, sqrt(greatest(sum(tf * tf) / any_value(n)
    - (sum(tf) / any_value(n)) * (sum(tf) / any_value(n)), 0)) AS std
  FROM known JOIN (SELECT shard, count(*) AS n FROM sharded GROUP BY shard) USING (shard)
  GROUP BY shard, term)""",
    """tf AS MATERIALIZED (
  SELECT doc_id, label, split, term, tf / CASE WHEN std > 0 THEN std ELSE 1 END AS tf
  FROM known JOIN stds USING (shard, term))""",
    *[sql for sql in _MODEL_SQL[1:] if not sql.startswith("vocab")],
]
_ROUNDED_MODEL_SQL = views.with_sql(LABELLED_SQL, *_MODEL_SQL) + (
    "SELECT label, term, round(log_prob, 6) AS log_prob, round(log_prior, 6) AS log_prior FROM model"
)



def _linear_sql() -> list[str]:
    """A CTE per figure and step of one pass over two shards."""
    parts = [
        LABELLED_SQL,
        tf_sql("tf", "docs", "doc_id, split"),
        f"""train AS (SELECT doc_id, label, doc_id % 2 AS shard,
  {HASH_SQL.format("CAST(doc_id AS VARCHAR)")} % {STEPS} AS batch FROM docs WHERE split = 'train')""",
        """first AS (SELECT 1 + sum(tf * tf)
    / (SELECT count(*) FROM train WHERE shard = 0 AND batch = 0) AS norm
  FROM tf JOIN train USING (doc_id) WHERE shard = 0 AND batch = 0)""",
        "w0 AS (SELECT CAST(NULL AS VARCHAR) AS term, CAST(0 AS DOUBLE) AS weight WHERE false)",
        "b0 AS (SELECT CAST(0 AS DOUBLE) AS bias)",
    ]
    for k in range(1, 2 * STEPS + 1):
        shard, batch = divmod(k - 1, STEPS)
        rate = f"(SELECT {linear.RATE} / (norm * sqrt({k})) FROM first)"
        parts += [
            f"""f{k} AS MATERIALIZED (
  SELECT t.doc_id, 2 * t.label - 1 AS y, (SELECT bias FROM b{k - 1}) + coalesce(sum(tf.tf * w.weight), 0) AS f
  FROM train t LEFT JOIN tf USING (doc_id) LEFT JOIN w{k - 1} w ON w.term = tf.term
  WHERE t.shard = {shard} AND t.batch = {batch} GROUP BY t.doc_id, t.label)""",
            f"""b{k} AS MATERIALIZED (SELECT (SELECT bias FROM b{k - 1})
  + {rate} * sum(CASE WHEN y * f < 1 THEN y ELSE 0 END) / count(*) AS bias FROM f{k})""",
            f"""g{k} AS (SELECT term, sum(y * tf) / (SELECT count(*) FROM f{k}) AS pull
  FROM f{k} JOIN tf USING (doc_id) WHERE y * f < 1 GROUP BY term)""",
            f"""w{k} AS MATERIALIZED (SELECT term,
  coalesce(weight, 0) * (1 - {rate} * {linear.L2}) + coalesce(pull, 0) * {rate} AS weight
  FROM w{k - 1} FULL JOIN g{k} USING (term))""",
        ]
    return parts


_LAST = 2 * STEPS
_TEST_SQL = "SELECT doc_id, label, 1 AS judged FROM docs WHERE split = 'test'"
_NET_SQL = f"""net AS (
  SELECT doc_id, CAST(list_has_any(tags, ['mw-reverted', 'Reverted', 'mw-manual-revert'])
    AS INTEGER) AS label, {SEEDED_SQL} FROM documents JOIN tags USING (doc_id)
  WHERE text IS NOT NULL)"""

ORACLE = {
    "linear_by_shards": views.with_sql(*_linear_sql())
    + f"SELECT term, round(weight, 9) AS weight FROM w{_LAST} UNION ALL SELECT NULL, round(bias, 9) FROM b{_LAST}",
    "linear_predict": views.with_sql(*_linear_sql())
    + f"""SELECT doc_id, label, round(score, 6) AS score, CAST(score > 0 AS INTEGER) AS prediction
FROM (SELECT d.doc_id, d.label, (SELECT bias FROM b{_LAST}) + coalesce(sum(tf.tf * w.weight), 0) AS score
  FROM docs d LEFT JOIN tf USING (doc_id) LEFT JOIN w{_LAST} w ON w.term = tf.term
  WHERE d.split = 'test' GROUP BY d.doc_id, d.label)""",
    "nb_ml": views.with_sql(LABELLED_SQL) + _TEST_SQL,
    "linear_svm": views.with_sql(LABELLED_SQL) + _TEST_SQL,
    "embedding_features": views.with_sql(LABELLED_SQL)
    + "SELECT doc_id, label, 1 AS judged, 250 AS dimensions FROM docs WHERE split = 'test'",
    "doc_embedding": "SELECT doc_id, 250 AS dimensions, 1 AS finite FROM documents",
    "mlp_classifier": views.with_sql(views.TAGS_SQL, _NET_SQL)
    + "SELECT doc_id, label, 1 AS judged FROM net WHERE split = 'test'",
    "model_report": views.with_sql(LABELLED_SQL, views.TAGS_SQL, _NET_SQL)
    + """SELECT m AS model, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, 1 AS in_range
FROM docs, (SELECT unnest(['naive bayes', 'linear']) AS m) WHERE split = 'test' GROUP BY m
UNION ALL
SELECT 'net', count(*), CAST(sum(label) AS BIGINT), 1 FROM net WHERE split = 'test'""",
    "nb_model": _ROUNDED_MODEL_SQL,
    "nb_incremental": _ROUNDED_MODEL_SQL,
    "nb_predict": views.with_sql(LABELLED_SQL, *_MODEL_SQL, *_PREDICT_SQL)
    + "SELECT doc_id, label, prediction, round(margin, 4) AS margin FROM predicted",
    "reverted_from_diff": views.with_sql(
        views.TAGS_SQL,
        views.REV_SQL,
        diff_text_cte("rev"),
        _DIFF_DOCS_SQL,
        *_MODEL_SQL,
        *_PREDICT_SQL,
        "judged AS (SELECT 'diff' AS model, label AS truth, prediction FROM predicted)",
        _COUNTS_SQL,
    )
    + "SELECT *, fp + fn AS mistakes FROM counts",
    "nb_scaled": views.with_sql(
        views.TAGS_SQL,
        views.REV_SQL,
        diff_text_cte("rev"),
        _DIFF_DOCS_SQL,
        "sharded AS (SELECT *, doc_id % 2 AS shard FROM docs)",
        *_SCALED_SQL,
        *_PREDICT_SQL,
        "judged AS (SELECT 'scaled diff' AS model, label AS truth, prediction FROM predicted)",
        _COUNTS_SQL,
    )
    + "SELECT *, fp + fn AS mistakes FROM counts",
    "confusion": views.with_sql(*_EVALUATED_SQL) + "SELECT *, fp + fn AS mistakes FROM counts",
    "metrics": views.with_sql(*_EVALUATED_SQL)
    + """SELECT model, (tp + tn) / (tp + fp + tn + fn) * 100 AS accuracy,
  tp / nullif(tp + fp, 0) * 100 AS precision, tp / nullif(tp + fn, 0) * 100 AS recall,
  tn / nullif(tn + fp, 0) * 100 AS specificity,
  2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
    / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) * 100 AS f1
FROM counts""",
}
