"""The given tables seen as page histories, in Spark and as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.functions import text as tx
from revloom.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, key: str, text: str) -> DataFrame:
    """Key and text of a table whose texts are worked on before any shuffle."""
    return spread(table(spark, sf, name).select(key, text), key)


def tags(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, tags): edit tags made from the labels table."""
    odd = F.col("doc_id") % 2 == 1
    toxic = F.col("toxic") == 1
    marks = F.array(
        F.when(F.col("quality") == 0, "mw-reverted"),
        F.when(toxic & ~odd, "Reverted"),
        F.when(toxic & odd, "mw-manual-revert"),
        F.when(F.col("doc_id") % 7 == 0, "mw-undo"),
    )
    return table(spark, sf, "labels").select("doc_id", F.array_compact(marks).alias("tags"))


def rev(spark: SparkSession, sf: str) -> DataFrame:
    """(page, rev, content): the documents of a source as one history."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("page"), F.col("doc_id").alias("rev"), F.col("text").alias("content")
    )


def rev_tagged(spark: SparkSession, sf: str) -> DataFrame:
    """``rev`` with tags; unlabelled documents have none (null)."""
    return rev(spark, sf).join(
        tags(spark, sf).withColumnRenamed("doc_id", "rev"), "rev", "left"
    )


def growing(df: DataFrame, page: str, text: str) -> DataFrame:
    """Four growing revisions of every text; a null text counts as empty."""
    size = F.size("_segments")
    k = F.col("rev")
    upto = F.floor((k * size + 3) / 4)
    start = F.slice("_segments", F.lit(1), (k - 1).cast("int"))
    rest = F.slice("_segments", (k + 1).cast("int"), F.greatest(upto - k, F.lit(0)).cast("int"))
    edit = F.array(F.concat(F.lit("edit "), k.cast("string"), F.lit(". ")))
    return (
        df.select(F.col(page).alias("page"), tx.segments(F.coalesce(text, F.lit(""))).alias("_segments"))
        .withColumn("rev", F.explode(F.expr("sequence(1L, 4L)")))
        .select("page", "rev", F.concat_ws("\n", start, edit, rest).alias("content"))
    )


def shuffled(df: DataFrame, page: str, text: str) -> DataFrame:
    """Four revisions of every text that move its segments: as they are, the halves
    exchanged, the second quarter at the end after an edit, the first four reversed."""
    s, n = F.col("_segments"), F.size("_segments")
    half, quarter = F.floor(n / 2).cast("int"), F.floor(n / 4).cast("int")
    part = lambda start, end: F.slice(s, start + 1, F.greatest(end - start, F.lit(0)))
    moved = [
        s,
        F.concat(part(half, n), part(F.lit(0), half)),
        F.concat(part(F.lit(0), quarter), F.array(F.lit("edit 3. ")), part(half, n), part(quarter, half)),
        F.concat(F.reverse(part(F.lit(0), F.lit(4))), part(F.lit(4), n)),
    ]
    return (
        df.select(F.col(page).alias("page"), tx.segments(F.coalesce(text, F.lit(""))).alias("_segments"))
        .select("page", F.posexplode(F.array(*moved)).alias("_at", "_s"))
        .select("page", (F.col("_at") + 1).cast("long").alias("rev"), F.array_join("_s", "\n").alias("content"))
    )


def moves(spark: SparkSession, sf: str) -> DataFrame:
    return shuffled(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def chain(spark: SparkSession, sf: str) -> DataFrame:
    return growing(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")


def html_chain(spark: SparkSession, sf: str) -> DataFrame:
    return growing(texts(spark, sf, "pages", "page_id", "html"), "page_id", "html")


def conv(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("page"), F.col("turn").alias("rev"), F.col("text").alias("content")
    )


# --- the same views for the SQL side -------------------------------------------


def segments_sql(column: str) -> str:
    return f"regexp_extract_all({column}, '([^\\n]*?\\. |[^\\n]+)', 1)"


def words_sql(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '([\\p{{L}}\\p{{N}}_]{{2,}})', 1)"


def marks_sql(column: str) -> str:
    return f"regexp_extract_all({column}, '([\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s])', 1)"


def ngrams_sql(tokens: str) -> str:
    """Unigrams and bigrams of a token list."""
    return (
        f"list_concat({tokens}, list_transform(range(1, greatest(len({tokens}), 1)),"
        f" lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )


def growing_sql(name: str, relation: str, page: str, text: str) -> str:
    return f"""{name}_base AS (
  SELECT {page} AS page, {segments_sql(f"coalesce({text}, '')")} AS s FROM {relation}),
{name} AS (
  SELECT page, k AS rev, array_to_string(
           list_concat(s[1:k - 1], ['edit ' || k || '. '], s[k + 1:(k * len(s) + 3) // 4]),
           chr(10)) AS content
  FROM {name}_base, (SELECT unnest(range(1, 5)) AS k))"""


MOVES_SQL = f"""moves_base AS (
  SELECT doc_id AS page, {segments_sql("coalesce(text, '')")} AS s FROM documents),
moves AS (
  SELECT page, unnest([1, 2, 3, 4])::BIGINT AS rev, unnest([
    array_to_string(s, chr(10)),
    array_to_string(s[len(s) // 2 + 1:] || s[1:len(s) // 2], chr(10)),
    array_to_string(s[1:len(s) // 4] || ['edit 3. '] || s[len(s) // 2 + 1:] || s[len(s) // 4 + 1:len(s) // 2], chr(10)),
    array_to_string(list_reverse(s[1:4]) || s[5:], chr(10))]) AS content
  FROM moves_base)"""
TAGS_SQL = """tags AS (
  SELECT doc_id, list_filter([
    CASE WHEN quality = 0 THEN 'mw-reverted' END,
    CASE WHEN toxic = 1 AND doc_id % 2 = 0 THEN 'Reverted' END,
    CASE WHEN toxic = 1 AND doc_id % 2 = 1 THEN 'mw-manual-revert' END,
    CASE WHEN doc_id % 7 = 0 THEN 'mw-undo' END], lambda t: t IS NOT NULL) AS tags
  FROM labels)"""
REV_SQL = "rev AS (SELECT source AS page, doc_id AS rev, text AS content FROM documents)"
CHAIN_SQL = growing_sql("chain", "documents", "doc_id", "text")
HTML_CHAIN_SQL = growing_sql("html_chain", "pages", "page_id", "html")
CONV_SQL = "conv AS (SELECT conv_id AS page, turn AS rev, text AS content FROM conversations)"


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
