"""Stored response batches of the revision interface."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.operators import ordered
from revloom.schemas import RESPONSE
from revloom.session import written

# The newest and oldest revision time of the corpus.
NEWEST, OLDEST = "2021-12-10T23:59:59Z", "2020-07-20T21:06:21Z"


def classify(batches: DataFrame) -> DataFrame:
    """Add ``status``, ``revisions`` and ``more`` to (title, batch_no, body).

    An error is looked for first, then a missing structure, then a warning; only
    error and malformed batches are invalid. ``more`` tells whether the batch
    announces a following one.
    """
    parsed = batches.withColumns(
        {
            "_keys": F.coalesce(F.json_object_keys("body"), F.array().cast("array<string>")),
            "_json": F.from_json("body", RESPONSE),
        }
    )
    revisions = F.get(F.col("_json.query.pages"), F.lit(0))["revisions"]
    status = (
        F.when(F.array_contains("_keys", "error"), "error")
        .when(revisions.isNull(), "malformed")
        .when(F.array_contains("_keys", "warning"), "warning")
        .otherwise("ok")
    )
    return parsed.withColumns(
        {
            "status": status,
            "revisions": revisions,
            "more": F.array_contains("_keys", "continue"),
        }
    ).drop("_keys", "_json")


def assemble(batches: DataFrame) -> DataFrame:
    """(title, pos, revision) of every title whose batches are all valid.

    Batches after the first one that announces no further batch are ignored. A
    title without such a last batch is incomplete and, like one with an invalid
    batch or a gap between the numbers of its batches, yields nothing. A batch that
    is stored more than once counts once (the body that sorts first). What decides
    this is one small row per batch, which is written; revisions are never gathered
    per title.
    """
    once = batches.groupBy("title", "batch_no").agg(F.min("body").alias("body"))
    judged = classify(once)
    heads = written(
        judged.select(
            "title",
            "batch_no",
            "more",
            F.col("status").isin("ok", "warning").alias("valid"),
            F.coalesce(F.array_size("revisions"), F.lit(0)).alias("size"),
        ),
        "batches",
    )
    ends = heads.groupBy("title").agg(
        F.min("batch_no").alias("_start"),
        F.min(F.when(~F.col("more"), F.col("batch_no"))).alias("_last"),
        F.min(F.when(~F.col("valid"), F.col("batch_no"))).alias("_broken"),
    )
    whole = ends.where(
        F.col("_last").isNotNull()
        & (F.col("_broken").isNull() | (F.col("_broken") > F.col("_last")))
    ).select("title", "_start", "_last")
    used = heads.join(whole, "title").where(F.col("batch_no") <= F.col("_last"))
    # Numbers are distinct, so as many as from start to last leave no gap.
    gapless = (
        used.groupBy("title")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_last").alias("_l"), F.first("_start").alias("_s"))
        .where(F.col("_n") == F.col("_l") - F.col("_s") + 1)
        .select("title")
    )
    used = used.join(gapless, "title", "left_semi")
    placed = ordered.running_total(
        used.select("title", "batch_no", "size"), ["title"], ["batch_no"], F.col("size"), "_upto"
    ).select("title", "batch_no", (F.col("_upto") - F.col("size")).alias("_first"))
    return (
        judged.join(placed, ["title", "batch_no"])
        .select("title", "_first", F.posexplode("revisions").alias("_at", "revision"))
        .select("title", (F.col("_first") + F.col("_at")).alias("pos"), "revision")
    )


def in_time_range(df: DataFrame, ts: str, oldest=OLDEST, newest=NEWEST) -> DataFrame:
    """Rows between two times, both included; reaches a Parquet scan as a filter."""
    kind = df.schema[ts].dataType
    return df.where(F.col(ts).between(F.lit(oldest).cast(kind), F.lit(newest).cast(kind)))
