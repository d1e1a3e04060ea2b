"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are sorted by range over the whole table, so a partition holds consecutive
rows. Each partition only reports its total; a running sum over those totals (one
row per partition) gives every partition its offset, and an offset plus the sum
inside the partition is the global prefix sum. Shards are cut where the prefix sum
passes equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revloom.llm.common import table
from revloom.session import written

SHARDS = 40
ROW_BYTES = 16


def text_size(text: Column) -> Column:
    """Bytes of the text in UTF-8 (none if null) and a fixed amount per row."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + F.lit(ROW_BYTES)


def prefix_sums(sized: DataFrame, order: list[str], name: str = "sharding") -> DataFrame:
    """Add ``_before`` (bytes in all earlier rows) and ``_place`` (number of earlier rows).

    ``sized`` has a ``size`` column, not null. Rows that tie in ``order`` follow
    one another in some order; equal rows can be spread over partitions because a
    number of the row is the last key.
    """
    keys = [*order, "_tie"]
    placed = written(
        sized.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .withColumn("_part", F.spark_partition_id()),
        name,
    )
    # One row per partition.
    totals = placed.groupBy("_part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_rows_before"),
    )
    inside = W.partitionBy("_part").orderBy(*keys)
    above = inside.rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_before", F.coalesce(F.sum("size").over(above), F.lit(0)))
        .withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_part")
        .select(
            *sized.columns,
            (F.col("_before") + F.col("_bytes_before")).alias("_before"),
            (F.col("_place") + F.col("_rows_before")).alias("_place"),
        )
    )


def assign(sized: DataFrame, order: list[str], shards: int = SHARDS, name: str = "sharding") -> DataFrame:
    """Add ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 within the shard).

    A row belongs to the shard in whose stretch of bytes its middle lies, so shards
    are contiguous in ``order`` and differ from the target by at most one row at
    either end. Extra columns are kept. An empty table gives no rows. A row larger
    than a target can leave the shards next to it without rows.
    """
    summed = prefix_sums(sized, order, name)
    total = sized.agg(F.sum("size").alias("_total"))
    middle = F.col("_before").cast("decimal(38,0)") * 2 + F.col("size")
    shard = F.floor(middle * shards / (2 * F.col("_total"))).cast("int")
    cut = summed.join(F.broadcast(total)).withColumn("shard", F.least(shard, F.lit(shards - 1)))
    first = cut.groupBy("shard").agg(F.min("_place").alias("_first"))
    return (
        cut.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_place") - F.col("_first"))
        .select(*sized.columns, "shard", "slot")
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards by doc_id; law: nearly equal bytes."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
    )
    return assign(docs, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# The checksum is taken byte by byte through a table made by its rule; ``hex`` gives two
# digits for each byte of UTF-8.
OP10_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i::UBIGINT AS c, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM bits WHERE step = 8),
d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + {ROW_BYTES} AS size,
    xor(4294967295::UBIGINT, list_reduce(
      [('0x' || x)::UBIGINT FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT)) AS text_crc32
  FROM documents, crc
),
p AS (
  SELECT *, sum(size) OVER w - size AS before, row_number() OVER w AS place, sum(size) OVER () AS total
  FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
),
s AS (SELECT *, least({SHARDS - 1}, ((2 * before + size) * {SHARDS}) // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM s
"""

QUERIES = {"op10_sharding": op10_sharding}
ORACLE = {"op10_sharding": OP10_SQL}
