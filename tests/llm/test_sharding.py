"""Shards against sums taken in one place."""

import zlib

import duckdb
from pyspark.sql import functions as F

from revloom.llm import sharding
from tests import oracle
from tests.conftest import SF


def expected(sizes, shards):
    total, before, out = sum(sizes), 0, []
    for size in sizes:
        out.append(min(shards - 1, (2 * before + size) * shards // (2 * total)))
        before += size
    return out


def test_query(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    sizes = [len(t.encode()) + 16 for _, t in docs]
    rows = sorted(sharding.op10_sharding(spark, SF).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [d for d, _ in docs]
    assert [r.size for r in rows] == sizes
    assert [r.text_crc32 for r in rows] == [zlib.crc32(t.encode()) for _, t in docs]
    assert [r["shard"] for r in rows] == expected(sizes, 40)
    for shard in {r["shard"] for r in rows}:
        assert [r.slot for r in rows if r["shard"] == shard] == list(range(sum(r["shard"] == shard for r in rows)))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_repeated_and_null_keys_stay_whole(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).alias("k"), F.lit(10).cast("long").alias("size"), F.lit("x").alias("part")
    )
    out = sharding.assign(df.repartition(5), ["k"], 10).cache()
    assert out.count() == 3000 and out.columns == ["k", "size", "part", "shard", "slot"]
    assert {r["count"] for r in out.groupBy("shard").count().collect()} == {300}
    assert out.select("shard", "slot").distinct().count() == 3000
    assert out.where("k is null").agg(F.max("shard")).head()[0] == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, size long")
    assert sharding.assign(df, ["k"]).count() == 0


def test_query_matches_sql(spark):
    con = oracle.connect(SF)
    assert oracle.compare(sharding.op10_sharding(spark, SF), con, sharding.OP10_SQL) is None


def test_sql_of_null_empty_and_large_rows(spark, tmp_path):
    """A null text, an empty one, and a row larger than a shard."""
    rows = [(3, None), (1, ""), (2, "é" * 5000)] + [(10 + i, "text " * (i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert oracle.compare(sharding.op10_sharding(spark, str(tmp_path)), con, sharding.OP10_SQL) is None
