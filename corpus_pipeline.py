"""From raw documents to token ids: five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result to the shared folder as Parquet and reads it again for the next stage. All
but the last keep the columns of ``documents``; a stage that changes ``text`` sets
``n_chars`` anew. A document without a key passes through like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm import bpe, decontamination, jaccard, langid, linededup
from revloom.llm.common import small_batches, table
from revloom.session import written

# Near duplicates: words per shingle and percent of similarity.
SHINGLE_WORDS, SIMILARITY = 5, 80


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told."""
    small_batches(spark)
    judged = langid.predict(docs, langid.fitted(docs))
    return judged.where(judged.columns[-1]).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that stand on many sites; drop documents of which nothing is left."""
    small_batches(spark)
    cut = linededup.remove(docs)
    n_lines, n_removed = cut.columns[-2:]
    return _sized(cut.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines))), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of similar ones."""
    small_batches(spark)
    return jaccard.keep_one(docs, width=SHINGLE_WORDS, percent=SIMILARITY).select(*docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of the benchmark; drop documents that are mostly such passages."""
    small_batches(spark)
    return _sized(decontamination.clean(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to the text again."""
    small_batches(spark)
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("intact"),
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("tokens", tokens),
]

# SQL has no zstandard dictionaries and no BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
