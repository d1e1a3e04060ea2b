"""Language of a text by compression.

Each language has a zstandard dictionary of raw text in that language. The words of
a text, in lower case, are compressed with every dictionary; the language whose
dictionary gives the smallest result is chosen, and the choice is rejected when the
runner-up is nearly as small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.common import free_name, release, table

# Bound of the training sample: texts per language, and characters of each.
SAMPLE_TEXTS = 192
SAMPLE_CHARS = 1024
LEVEL = 6
# Texts of at most this many bytes, where a few bytes decide, are parsed optimally.
SHORT = 1000
# Longer texts are compressed in blocks of so many bytes: past that, a text is its own dictionary.
BLOCK = 8000
# A choice is kept if the runner-up is at least this share larger.
MIN_MARGIN = 0.005
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")

RESULT = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType())]
)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Raw dictionary of each language from a bounded sample of labelled texts.

    The sample has the ``SAMPLE_TEXTS`` different texts per language with the smallest
    hashes, and ``SAMPLE_CHARS`` characters of each, from a place that the hash gives.
    Copies are merged in every task before rows are shuffled.
    """
    usable = labelled.where(F.col(lang).isNotNull() & (F.trim(F.coalesce(F.col(text), F.lit(""))) != ""))
    order = F.xxhash64(F.col(text))
    # Places from 1 to the last from which the characters are all there.
    places = F.greatest(F.char_length(F.col(text)) - SAMPLE_CHARS, F.lit(0)) + 1
    at = (F.pmod(F.xxhash64(F.lit("place"), F.col(text)), places.cast("long")) + 1).cast("int")
    start = F.col(text).substr(at, F.lit(SAMPLE_CHARS))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("order"))
    sample = (
        usable.select(F.col(lang).alias("lang"), order.alias("order"), start.alias("start"))
        .groupBy("lang", "order")
        .agg(F.min("start").alias("start"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= SAMPLE_TEXTS)
        .select("lang", "rank", "start")
    )
    found: dict[str, list] = {}
    for row in sample.collect():
        found.setdefault(row["lang"], []).append((row["rank"], row["start"]))
    # The end of a dictionary is the part nearest to the text.
    return {name: "\n".join(t for _, t in sorted(rows, reverse=True)).encode() for name, rows in sorted(found.items())}


def normal(text: str) -> bytes:
    """All words of a text, letters only, in lower case."""
    return " ".join(WORD.findall(text.lower())).encode()


def _compressor(raw: bytes, **options) -> zstandard.ZstdCompressor:
    plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(raw), **plain, **options)
    known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=known)


class Judge:
    """Compressors of all languages, for short and for other texts."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = list(dictionaries)
        raw = [normal(d.decode()) for d in dictionaries.values()]
        self.short = [_compressor(r, min_match=3, strategy=zstandard.STRATEGY_BTOPT) for r in raw]
        self.other = [_compressor(r) for r in raw]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score from 0 to 1, margin); ties go to the name that sorts first."""
        if text is None or not any(map(str.isalpha, text)) or not self.names:
            return UNDETERMINED, 0.0, 0.0
        raw = normal(text)
        codecs = self.short if len(raw) <= SHORT else self.other
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted(
            (sum(len(codec.compress(block)) for block in blocks), name)
            for name, codec in zip(self.names, codecs, strict=True)
        )
        if len(sizes) == 1:
            return sizes[0][1], 1.0, 1.0
        best, second = sizes[0][0], sizes[1][0]
        margin = (second - best) / second
        return sizes[0][1], min(1.0, 0.5 + margin * 5), margin


def predict(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``accepted``.

    The whole text is compressed. A text that is null or has no letter is ``und``
    with score 0 and is not accepted. Without any dictionary every text is.
    The dictionaries are bounded by the sample: some 200 kB per language.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = Judge(shared.value)
        for part in parts:
            yield pd.DataFrame([judge(t) for t in part], columns=["lang", "score", "margin"])
        release()

    run = F.pandas_udf(run, RESULT)
    found = free_name(df, "found")
    named = df.withColumn(found, run(F.col(text)))
    return named.select(
        *df.columns,
        F.col(f"{found}.lang").alias(free_name(df, "lang_pred")),
        F.col(f"{found}.score").alias(free_name(df, "score")),
        ((F.col(f"{found}.lang") != UNDETERMINED) & (F.col(f"{found}.margin") >= MIN_MARGIN)).alias(free_name(df, "accepted")),
    )


def fitted(docs: DataFrame, key: str = "doc_id") -> dict[str, bytes]:
    """Dictionaries from the documents that are not held out."""
    return learn(docs.where(remainder(F.col(key)) != 2).select("text", "lang"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    named = docs.select("doc_id", "text", (remainder(F.col("doc_id")) == 2).alias("held_out"))
    return predict(named, fitted(docs)).select("doc_id", "held_out", "lang_pred", "score", "accepted")


QUERIES = {"op6_langid": op6_langid}
ORACLE: dict[str, str] = {}
