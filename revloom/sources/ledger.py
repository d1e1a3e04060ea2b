"""Which titles and files are done already."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.schemas import LEDGER


def unseen(df: DataFrame, done: DataFrame, key: str, rewrite: bool = False) -> DataFrame:
    """Rows whose key is not in ``done``; all rows with ``rewrite``."""
    return df if rewrite else df.join(done.select(key), key, "left_anti")


def new_entries(titles: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows for the titles it lacks; ``titles`` has (position, title).

    The first position of a title names its file. A minimum is combined before
    the shuffle, so a title that recurs very often costs nothing.
    """
    first = titles.groupBy("title").agg(F.min("position").alias("position"))
    return unseen(first, ledger, "title").select(
        "title", F.concat(F.col("position").cast("string"), F.lit(".json")).alias("file_name")
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path)


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)
