"""Queries over term features."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.operators import features, split
from revloom.plans import views
from revloom.session import scratch_path, written
from revloom.sources import store


def _documents(spark, sf):
    return views.table(spark, sf, "documents").select("doc_id", "text")


def _unigrams(spark, sf):
    return features.term_counts(_documents(spark, sf), "doc_id", "text")


def _labelled(spark, sf):
    labels = views.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    return _documents(spark, sf).join(labels, "doc_id")


def vocabulary(spark, sf):
    tf = features.term_counts(_documents(spark, sf), "doc_id", "text", 1, 2)
    return features.indexed_vocabulary(tf)


def tf_fixed_vocab(spark, sf):
    items = views.table(spark, sf, "benchmark")
    vocab = features.fit_vocabulary(features.term_counts(items, "item_id", "text", 1, 2))
    docs = _documents(spark, sf)
    tf = features.term_counts(docs, "doc_id", "text", 1, 2)
    tf = features.restrict(tf, vocab, "doc_id")
    return features.with_all_documents(tf, docs, "doc_id")


def tf_train_vocab(spark, sf):
    docs = split.holdout_split(_documents(spark, sf), "doc_id")
    tf = written(features.term_counts(docs, "doc_id", "text", keep=["split"]), "counts")
    train, test = tf.where(F.col("split") == "train"), tf.where(F.col("split") == "test")
    # The terms of the training part are the vocabulary, so only the others are looked up.
    return train.unionByName(features.restrict(test, features.fit_vocabulary(train), "doc_id"))


def scaled_tf(spark, sf):
    tf = written(_unigrams(spark, sf), "counts")
    scaled = features.scale(tf, features.fit_scale(tf, _documents(spark, sf)), "doc_id", stored=True)
    return scaled.withColumn("tf_scaled", F.round("tf_scaled", 6))


def scaled_tf_on_train(spark, sf):
    """Deviations from the training part, applied to all documents."""
    docs = split.holdout_split(_documents(spark, sf), "doc_id")
    tf = written(features.term_counts(docs, "doc_id", "text", keep=["split"]), "counts")
    stds = features.fit_scale(tf, docs, fit_on=F.col("split") == "train")
    scaled = features.scale(tf, stds, "doc_id", stored=True)
    return scaled.withColumn("tf_scaled", F.round("tf_scaled", 6))


def scaled_tf_by_shard(spark, sf):
    docs = _documents(spark, sf).withColumn("shard", F.col("doc_id") % 2)
    tf = written(features.term_counts(docs, "doc_id", "text", keep=["shard"]), "counts")
    scaled = features.scale(tf, features.fit_scale(tf, docs, ["shard"]), "doc_id", ["shard"], stored=True)
    return scaled.withColumn("tf_scaled", F.round("tf_scaled", 6))


def dataset_profile(spark, sf):
    docs = split.holdout_split(_labelled(spark, sf), "doc_id")
    tf = features.term_counts(docs, "doc_id", "text")
    return features.profile(docs, tf, "label", "split")


def features_labels_join(spark, sf):
    """Features written by shard, read back and matched with their labels."""
    docs = _documents(spark, sf).withColumn("shard", F.col("doc_id") % 2)
    path = scratch_path(spark, "features")
    store.write_features(
        features.term_counts(docs, "doc_id", "text", keep=["shard"]), path
    )
    labels = views.table(spark, sf, "labels").select("doc_id", "toxic")
    return store.align(store.read_features(spark, path), labels).select(
        "doc_id", F.col("shard").cast("long").alias("shard"), "term", "tf", "toxic"
    )


def shard_union(spark, sf):
    docs = views.table(spark, sf, "documents").withColumn("shard", F.col("doc_id") % 2)
    parts = [
        split.holdout_split(docs.where(F.col("shard") == s), "doc_id") for s in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).select("doc_id", "shard", "split", "n_chars")


def split_hash(spark, sf):
    return split.holdout_split(_documents(spark, sf), "doc_id").select("doc_id", "split")


def split_seeded(spark, sf):
    return split.seeded_split(_documents(spark, sf), "doc_id").select("doc_id", "split")


QUERIES = {
    "vocabulary": vocabulary,
    "tf_fixed_vocab": tf_fixed_vocab,
    "tf_train_vocab": tf_train_vocab,
    "scaled_tf": scaled_tf,
    "scaled_tf_on_train": scaled_tf_on_train,
    "scaled_tf_by_shard": scaled_tf_by_shard,
    "dataset_profile": dataset_profile,
    "features_labels_join": features_labels_join,
    "shard_union": shard_union,
    "split_hash": split_hash,
    "split_seeded": split_seeded,
}

# --- SQL -------------------------------------------------------------------------


def tf_sql(name: str, relation: str, keys: str, high: int = 1) -> str:
    grams = views.ngrams_sql("w") if high == 2 else "w"
    return f"""{name} AS MATERIALIZED (
  SELECT {keys}, term, count(*) AS tf FROM (
    SELECT {keys}, unnest({grams}) AS term FROM (
      SELECT {keys}, {views.words_sql('text')} AS w FROM {relation}))
  GROUP BY ALL)"""


HASH_SQL = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"
HOLDOUT_SQL = (
    "CASE WHEN " + HASH_SQL.format("CAST(doc_id AS VARCHAR)") + " % 10 = 0"
    " THEN 'test' ELSE 'train' END AS split"
)
SEEDED_SQL = (
    "CASE WHEN " + HASH_SQL.format("'1112:' || doc_id") + " % 100 < 25"
    " THEN 'test' ELSE 'train' END AS split"
)
SPLIT_SQL = f"docs AS (SELECT doc_id, text, {HOLDOUT_SQL} FROM documents)"
LABELLED_SQL = f"""docs AS (
  SELECT doc_id, text, toxic AS label, {HOLDOUT_SQL} FROM documents JOIN labels USING (doc_id))"""

_STD_SQL = """SELECT {by}term, sqrt(sum(tf * tf) / any_value(n)
    - (sum(tf) / any_value(n)) * (sum(tf) / any_value(n))) AS std FROM tf {join}
  GROUP BY {by}term"""

ORACLE = {
    "vocabulary": views.with_sql(tf_sql("tf", "documents", "doc_id", 2))
    + """SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df,
  row_number() OVER (ORDER BY term) - 1 AS term_index FROM tf GROUP BY term""",
    "tf_fixed_vocab": views.with_sql(
        tf_sql("vocab", "benchmark", "item_id", 2), tf_sql("tf", "documents", "doc_id", 2)
    )
    + """SELECT doc_id, term, coalesce(tf, 0) AS tf FROM documents LEFT JOIN
  (SELECT * FROM tf WHERE term IN (SELECT term FROM vocab)) USING (doc_id)""",
    "tf_train_vocab": views.with_sql(SPLIT_SQL, tf_sql("tf", "docs", "doc_id, split"))
    + """SELECT * FROM tf WHERE term IN (SELECT term FROM tf WHERE split = 'train')""",
    "scaled_tf": views.with_sql(tf_sql("tf", "documents", "doc_id"))
    + f"""SELECT doc_id, term, tf,
  round(tf / CASE WHEN std > 0 THEN std ELSE 1 END, 6) AS tf_scaled
FROM tf JOIN ({_STD_SQL.format(by='', join=', (SELECT count(*) AS n FROM documents)')})
USING (term)""",
    "scaled_tf_on_train": views.with_sql(SPLIT_SQL, tf_sql("tf", "docs", "doc_id, split"))
    + """, n AS (SELECT count(*)::HUGEINT AS n FROM docs WHERE split = 'train'),
stds AS (
  SELECT term, CASE WHEN any_value(n) * sum(tf * tf) > sum(tf) * sum(tf)
    THEN sqrt((any_value(n) * sum(tf * tf) - sum(tf) * sum(tf))::DOUBLE) / any_value(n) END AS std
  FROM tf, n WHERE split = 'train' GROUP BY term)
SELECT doc_id, split, term, tf, round(tf / coalesce(std, 1), 6) AS tf_scaled
FROM tf LEFT JOIN stds USING (term)""",
    "scaled_tf_by_shard": views.with_sql(
        "docs AS (SELECT doc_id, text, doc_id % 2 AS shard FROM documents)",
        tf_sql("tf", "docs", "doc_id, shard"),
    )
    + f"""SELECT doc_id, shard, term, tf,
  round(tf / CASE WHEN std > 0 THEN std ELSE 1 END, 6) AS tf_scaled
FROM tf JOIN ({_STD_SQL.format(
        by='shard, ',
        join='JOIN (SELECT shard, count(*) AS n FROM docs GROUP BY shard) USING (shard)',
    )}) USING (shard, term)""",
    "dataset_profile": views.with_sql(LABELLED_SQL, tf_sql("tf", "docs", "doc_id"))
    + """SELECT * FROM (SELECT count(*) AS docs, CAST(sum(label) AS BIGINT) AS positives,
    count(*) FILTER (split = 'train') AS train_docs,
    count(*) FILTER (split = 'test') AS test_docs FROM docs),
  (SELECT count(DISTINCT term) AS terms, count(*) AS nonzero,
    CAST(sum(tf) AS BIGINT) AS tokens FROM tf)""",
    "features_labels_join": views.with_sql(tf_sql("tf", "documents", "doc_id"))
    + """SELECT doc_id, doc_id % 2 AS shard, term, tf, toxic FROM tf JOIN labels USING (doc_id)""",
    "shard_union": f"SELECT doc_id, doc_id % 2 AS shard, {HOLDOUT_SQL}, n_chars FROM documents",
    "split_hash": f"SELECT doc_id, {HOLDOUT_SQL} FROM documents",
    "split_seeded": f"SELECT doc_id, {SEEDED_SQL} FROM documents",
}
