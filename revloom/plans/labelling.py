"""Queries over edit tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.functions import labels
from revloom.plans import views


def label_policies(spark, sf):
    tagged = views.tags(spark, sf)
    return tagged.select(
        "doc_id", *[labels.label(F.col("tags"), p).alias(p) for p in labels.POLICIES]
    )


def revert_tag_count(spark, sf):
    return (
        views.rev_tagged(spark, sf)
        .groupBy("page")
        .agg(F.sum(labels.revert_marks(F.col("tags"))).alias("revert_tags"))
    )


def _has(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"CAST(list_has_any(tags, [{listed}]) AS INTEGER)"


QUERIES = {"label_policies": label_policies, "revert_tag_count": revert_tag_count}

ORACLE = {
    "label_policies": views.with_sql(views.TAGS_SQL)
    + f"""SELECT doc_id, {_has('mw-reverted')} AS strict,
  {_has('mw-reverted', 'Reverted')} AS medium,
  {_has('mw-reverted', 'Reverted', 'mw-manual-revert')} AS wide FROM tags""",
    "revert_tag_count": views.with_sql(views.TAGS_SQL)
    + """SELECT source AS page, CAST(coalesce(sum(len(tags)), 0) AS BIGINT) AS revert_tags
FROM documents LEFT JOIN tags USING (doc_id) GROUP BY source""",
}
