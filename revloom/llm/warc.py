"""Content-addressed WARC archive: payloads stored once, headers apart.

An archive is a folder of two tables. ``payloads`` has each distinct payload once,
under its SHA-256; ``records`` has the exact header bytes of every record, the
address of its payload and its length. A record is its headers and its payload,
joined again on the address. The address is checked against the bytes that are
read, so a payload that is not what its address says raises an error.
"""

from __future__ import annotations

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revloom.llm.common import table
from revloom.session import scratch_path

# Payloads of fewer bytes are stored as responses even if they repeat.
LEAST_REVISIT = 1000
CRLF = "\r\n"


def _pack(payloads: pd.Series) -> pd.Series:
    codec = zstandard.ZstdCompressor(level=3, write_content_size=True)
    return pd.Series([codec.compress(p) for p in payloads], dtype=object)


def _unpack(packed: pd.Series) -> pd.Series:
    codec = zstandard.ZstdDecompressor()
    return pd.Series([codec.decompress(p) for p in packed], dtype=object)


def _header(name: str, value: Column) -> Column:
    """One header line, nothing if the value is null; line breaks cannot end it early."""
    safe = F.regexp_replace(value.cast("string"), "[\r\n]", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def describe(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, payload, payload_bytes, sha1, address) of each page; null html is empty."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    return pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha1"),
        F.sha2(payload, 256).alias("address"),
    )


def headers(described: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(header, address, payload_bytes): one WARC record per page.

    Of the pages with one payload of at least ``least`` bytes, that with the largest
    key is the response and the others revisit it; rows that repeat that key are
    responses too. Only keys and digests are grouped and joined, no payload. A very
    common payload is one group that is combined before the shuffle, and the join
    back has one row for it on one side.
    """
    light = described.select("key", "url", "payload_bytes", "sha1", "address")
    holders = light.groupBy("address").agg(F.max("key").alias("holder"))
    known = light.join(holders, "address")
    revisit = (F.col("payload_bytes") >= least) & ~F.col("key").eqNullSafe(F.col("holder"))
    known = known.withColumn("revisit", revisit)
    inner = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF),
        _header("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    body = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("payload_bytes"))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("key"), F.lit(">"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z" + CRLF),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _header("WARC-Profile", F.when(F.col("revisit"), F.lit(profile))),
        _header("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("holder"), F.lit(">")))),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        _header("Content-Length", body + F.octet_length(inner)),
        F.lit(CRLF),
        inner,
    )
    return known.select(header.cast("binary").alias("header"), "address", "payload_bytes")


def write_archive(described: DataFrame, folder: str, least: int = LEAST_REVISIT) -> None:
    """Write ``records`` and ``payloads`` under ``folder``, a path every executor reaches.

    Payloads are compressed before they are shuffled, and equal ones meet already
    within each task.
    """
    pack = F.pandas_udf(_pack, T.BinaryType())
    headers(described, least).write.parquet(f"{folder}/records")
    packed = described.select("address", pack("payload").alias("packed"))
    packed.groupBy("address").agg(F.first("packed").alias("packed")).write.option("compression", "uncompressed").parquet(
        f"{folder}/payloads"
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(header, payload, record): every record put together again.

    ``payload`` is the full payload, also of a revisit; ``record`` is the record as
    a WARC file has it, without a payload in a revisit.
    """
    unpack = F.pandas_udf(_unpack, T.BinaryType())
    records, payloads = (spark.read.parquet(f"{folder}/{name}") for name in ("records", "payloads"))
    joined = records.join(payloads, "address", "left").withColumn("payload", unpack("packed"))
    sound = (F.sha2("payload", 256) == F.col("address")) & (F.octet_length("payload") == F.col("payload_bytes"))
    wrong = F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("address"))).cast("binary")
    checked = joined.withColumn("payload", F.when(F.coalesce(sound, F.lit(False)), F.col("payload")).otherwise(wrong))
    is_revisit = field("WARC-Type") == "revisit"
    body = F.when(is_revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat("header", body, F.lit(2 * CRLF).cast("binary"))
    return checked.select("header", "payload", record.alias("record"))


def field(name: str) -> Column:
    """Value of a WARC header in ``header``, null if it is not there."""
    text = F.regexp_extract(F.decode("header", "utf-8"), rf"(?s)\n{name}: (.*?)\r\n", 1)
    return F.when(text != "", text)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive, and what the archive gives back."""
    folder = scratch_path(spark, "warc")
    write_archive(describe(table(spark, sf_dir, "pages")), folder)
    return read_archive(spark, folder).select(
        _key(field("WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        _key(field("WARC-Refers-To")).alias("refers_to"),
    )


def _key(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"<urn:page:(-?\d+)>", 1), F.lit("")).cast("long")


OP1_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS holder FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM m
"""

QUERIES = {"op1_warc": op1_warc}
ORACLE = {"op1_warc": OP1_SQL}
