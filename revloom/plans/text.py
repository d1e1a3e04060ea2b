"""Queries over tokenisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions import text as tx
from revloom.operators import tokens
from revloom.plans import views
from revloom.sources.pages import with_doc_index


def segments(spark, sf):
    docs = views.texts(spark, sf, "documents", "doc_id", "text")
    return tokens.exploded(docs, ["doc_id"], tx.segments(F.col("text")), "segment")


def words(spark, sf):
    docs = views.texts(spark, sf, "documents", "doc_id", "text")
    return tokens.exploded(docs, ["doc_id"], tx.words(F.col("text")), "token")


def ngrams(spark, sf):
    docs = views.texts(spark, sf, "documents", "doc_id", "text").withColumn("words", tx.words(F.col("text")))
    return tokens.exploded(docs, ["doc_id"], tx.ngrams(F.col("words"), 1, 2), "ngram")


def punct_tokens(spark, sf):
    docs = views.texts(spark, sf, "documents", "doc_id", "text")
    return tokens.exploded(docs, ["doc_id"], tx.words_and_marks(F.col("text")), "token")


def char_tokens(spark, sf):
    items = views.texts(spark, sf, "benchmark", "item_id", "text")
    return tokens.exploded(items, ["item_id"], tx.characters(F.col("text")), "character")


def tagged_docs(spark, sf):
    indexed = with_doc_index(views.rev(spark, sf), "page")
    return tokens.tagged(indexed, "doc_index", "content").select(
        "tag",
        "rev",
        F.size("words").cast("long").alias("n_words"),
        F.concat_ws(" ", "words").alias("words"),
    )


def _exploded_sql(key: str, table: str, tokens_sql: str, name: str) -> str:
    return f"""SELECT {key}, unnest(range(len(t))) AS pos, unnest(t) AS {name}
FROM (SELECT {key}, {tokens_sql} AS t FROM {table})"""


QUERIES = {
    "segments": segments,
    "tokens": words,
    "ngrams": ngrams,
    "punct_tokens": punct_tokens,
    "char_tokens": char_tokens,
    "tagged_docs": tagged_docs,
}

ORACLE = {
    "segments": _exploded_sql("doc_id", "documents", views.segments_sql("text"), "segment"),
    "tokens": _exploded_sql("doc_id", "documents", views.words_sql("text"), "token"),
    "ngrams": f"""SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS ngram
FROM (SELECT doc_id, {views.ngrams_sql('w')} AS t
      FROM (SELECT doc_id, {views.words_sql('text')} AS w FROM documents))""",
    "punct_tokens": _exploded_sql("doc_id", "documents", views.marks_sql("text"), "token"),
    "char_tokens": _exploded_sql(
        "item_id", "benchmark", "regexp_extract_all(text, '(?s)(.)', 1)", "character"
    ),
    "tagged_docs": f"""SELECT dense_rank() OVER (ORDER BY source) - 1 AS tag, doc_id AS rev,
  CAST(len(w) AS BIGINT) AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT source, doc_id, {views.marks_sql('text')} AS w FROM documents)""",
}
