"""Queries along histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from revloom.operators import history
from revloom.plans import views


# Small, so that the query cuts its large group at every scale.
NULL_BLOCK_ROWS = 300


def prev_revision(spark, sf):
    rows = history.previous(
        views.rev(spark, sf), ["page"], ["rev"], {"prev_rev": "rev", "prev_content": "content"}
    )
    return rows.select(
        "page",
        "rev",
        "prev_rev",
        F.length("content").cast("long").alias("chars"),
        F.length("prev_content").cast("long").alias("prev_chars"),
        F.md5("prev_content").alias("prev_md5"),
    )


def prev_with_null_keys(spark, sf):
    """Half of the pages without a name, every third revision without a number:
    one large group of ties, cut into blocks."""
    number = F.substring("source", 4, 9).cast("int")
    rows = views.table(spark, sf, "documents").select(
        F.when(number % 2 == 1, F.col("source")).alias("page"),
        F.when(F.col("doc_id") % 3 != 0, F.floor(F.col("doc_id") / 100)).alias("rev"),
        "doc_id",
    )
    return history.previous(rows, ["page"], ["rev", "doc_id"], {"prev": "doc_id"}, NULL_BLOCK_ROWS)


def time_gaps(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return history.time_gaps(events, ["user_id"], "ts", "event_id").select(
        "event_id", "user_id", "gap_seconds"
    )


def moving_avg_gap(spark, sf):
    events = views.table(spark, sf, "events").select("event_id", "user_id", "ts")
    sizes = {"avg_20": 20, "avg_100": 100}
    return history.moving_average_gap(events, ["user_id"], "ts", "event_id", sizes).select(
        "event_id", "user_id", *sizes
    )


QUERIES = {
    "prev_revision": prev_revision,
    "prev_with_null_keys": prev_with_null_keys,
    "time_gaps": time_gaps,
    "moving_avg_gap": moving_avg_gap,
}

ORACLE = {
    "prev_revision": """SELECT source AS page, doc_id AS rev, lag(doc_id) OVER w AS prev_rev,
  length(text) AS chars, length(lag(text) OVER w) AS prev_chars, md5(lag(text) OVER w) AS prev_md5
FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)""",
    "prev_with_null_keys": """SELECT page, rev, doc_id,
  lag(doc_id) OVER (PARTITION BY page ORDER BY rev NULLS FIRST, doc_id) AS prev
FROM (SELECT doc_id, CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 1 THEN source END AS page,
        CASE WHEN doc_id % 3 <> 0 THEN doc_id // 100 END AS rev FROM documents)""",
    "time_gaps": """SELECT event_id, user_id, (us - before) / 1e6 AS gap_seconds
FROM (SELECT event_id, user_id, epoch_us(ts) AS us,
        lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS before
      FROM events)
WHERE before IS NOT NULL""",
    "moving_avg_gap": """WITH k AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k
  FROM events)
SELECT a.event_id, a.user_id,
  (a.us - b.us) / least(a.k, 20) / 1e6 AS avg_20,
  (a.us - c.us) / least(a.k, 100) / 1e6 AS avg_100
FROM k a
JOIN k b ON b.user_id = a.user_id AND b.k = greatest(a.k - 20, 0)
JOIN k c ON c.user_id = a.user_id AND c.k = greatest(a.k - 100, 0)
WHERE a.k > 0""",
}
