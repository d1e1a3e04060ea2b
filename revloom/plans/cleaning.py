"""Queries over cleaning steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions.markup import plain_text
from revloom.operators import cleaning
from revloom.plans import views
from revloom.plans.markup_sql import plain_text_sql


def _labelled(spark, sf):
    """Documents with their labels, if any; every tenth has no content."""
    docs = views.table(spark, sf, "documents").select("doc_id", "text")
    joined = docs.join(views.table(spark, sf, "labels"), "doc_id", "left")
    return joined.withColumn("content", F.when(F.col("doc_id") % 10 != 0, F.col("text")))


def missing_defaults(spark, sf):
    rows = cleaning.default_missing(_labelled(spark, sf), "content")
    return rows.select(
        "doc_id",
        F.col("content_missing").cast("int").alias("content_missing"),
        F.length("content").cast("long").alias("chars"),
    )


def complete_cases(spark, sf):
    rows = cleaning.complete_cases(_labelled(spark, sf), ["content", "quality", "toxic"])
    return rows.select("doc_id", "content", "quality", "toxic")


def case_counts(spark, sf):
    return cleaning.case_counts(_labelled(spark, sf), ["content", "quality", "toxic"])


def markup_to_text(spark, sf):
    pages = views.texts(spark, sf, "pages", "page_id", "html")
    return pages.select("page_id", plain_text(F.col("html")).alias("plain"))


def comment_to_text(spark, sf):
    talk = views.table(spark, sf, "conversations")
    comment = F.when(F.col("conv_id") % 10 != 0, F.col("text"))
    return talk.select("conv_id", "turn", plain_text(comment).alias("comment_plaintext"))


_LABELLED_SQL = """labelled AS (
  SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN text END AS content, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id))"""

QUERIES = {
    "missing_defaults": missing_defaults,
    "complete_cases": complete_cases,
    "case_counts": case_counts,
    "markup_to_text": markup_to_text,
    "comment_to_text": comment_to_text,
}

ORACLE = {
    "missing_defaults": views.with_sql(_LABELLED_SQL)
    + """SELECT doc_id, CAST(content IS NULL AS INTEGER) AS content_missing,
  length(coalesce(content, '')) AS chars FROM labelled""",
    "complete_cases": views.with_sql(_LABELLED_SQL)
    + """SELECT doc_id, content, quality, toxic FROM labelled
WHERE content IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""",
    "case_counts": views.with_sql(_LABELLED_SQL)
    + """SELECT count(*) FILTER (content IS NOT NULL AND quality IS NOT NULL
    AND toxic IS NOT NULL) AS complete,
  count(*) FILTER (content IS NULL OR quality IS NULL OR toxic IS NULL) AS incomplete
FROM labelled""",
    "markup_to_text": f"SELECT page_id, {plain_text_sql('html')} AS plain FROM pages",
    "comment_to_text": f"""SELECT conv_id, turn,
  {plain_text_sql("CASE WHEN conv_id % 10 <> 0 THEN text END")} AS comment_plaintext
FROM conversations""",
}
