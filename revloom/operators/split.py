"""Train and test sets by hash: stable under any partitioning and any rerun."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_number(key: Column) -> Column:
    """The first 32 bits of the key's MD5 as a number."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def holdout_split(df: DataFrame, key: str, one_in: int = 10) -> DataFrame:
    """Add ``split``: one in ``one_in`` rows is 'test', the rest 'train'."""
    test = hash_number(F.col(key)) % one_in == 0
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def seeded_split(df: DataFrame, key: str, seed: int = 1112, percent: int = 25) -> DataFrame:
    """Add ``split`` with ``percent`` of the rows in 'test'; the seed picks which."""
    salted = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    test = hash_number(salted) % 100 < percent
    return df.withColumn("split", F.when(test, "test").otherwise("train"))
